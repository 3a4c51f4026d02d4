"""What several operators share: lines and words of a text as columns, and hashes of words in numpy."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WHITE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def whole(text: str | Column) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, everything else as it is. Texts of ASCII alone take the faster way to the same result."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text that is not null."""
    return F.array_remove(F.split(text, "[\\x20\\x09-\\x0D]+"), "")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def quoted(names: Sequence[str]) -> list[Column]:
    """Columns by name, which may hold dots."""
    return [F.col(f"`{name}`") for name in names]


def with_columns(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns; a column of the input that has one of these names (in any case) gives way."""
    new = {name.lower() for name in columns}
    old = quoted([c for c in df.columns if c.lower() not in new])
    return df.select(*old, *[column.alias(name) for name, column in columns.items()])


def slices(column: pa.Array, size: int = 1 << 20) -> Iterator[list[str | None]]:
    """The texts of an Arrow column in order, in lists of about ``size`` bytes; a longer text stands alone."""
    lengths = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    cuts = np.flatnonzero(np.diff(np.cumsum(lengths) // size, prepend=0))
    bounds = [0, *cuts[cuts > 0].tolist(), len(column)]
    for start, end in zip(bounds, bounds[1:]):
        if start < end:
            yield column.slice(start, end - start).to_pylist()


# Numpy side. Texts are UTF-8 bytes; none of the bytes of a multi-byte character is white space or a letter A-Z.

_SEED = np.random.default_rng(20231107)
_IS_WHITE = np.zeros(256, dtype=bool)
_IS_WHITE[[32, 9, 10, 11, 12, 13]] = True
_VALUE = _SEED.integers(1, 2**63, size=256, dtype=np.uint64)  # of each byte: as its lower case, 0 for white space
_VALUE[65:91] = _VALUE[97:123]
_VALUE[_IS_WHITE] = 0
_BASE = 0x9E3779B97F4A7C15
_POWERS = {True: np.ones(1, dtype=np.uint64), False: np.ones(1, dtype=np.uint64)}


def _powers(n: int, up: bool) -> np.ndarray:
    """The powers of the base, or of its inverse, modulo 2 ** 64."""
    if len(_POWERS[up]) < n:
        grown = np.full(max(2 * n, 1 << 16), _BASE if up else pow(_BASE, -1, 2**64), dtype=np.uint64)
        grown[0] = 1
        _POWERS[up] = np.cumprod(grown)
    return _POWERS[up][:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each word in these bytes, and where it starts."""
    value = _VALUE[data]
    blank = value == 0
    edge = np.empty(len(data) + 1, dtype=bool)  # where a word starts, and behind it
    edge[0], edge[-1] = not blank[0], not blank[-1]
    np.not_equal(blank[1:], blank[:-1], out=edge[1:-1])
    edges = np.flatnonzero(edge)
    starts, ends = edges[0::2], edges[1::2]
    if not len(starts):
        return np.empty(0, dtype=np.uint64), starts
    value *= _powers(len(data), True)
    summed = np.add.reduceat(value, starts) * _powers(len(data), False)[starts]
    return mixed(summed + (ends - starts).astype(np.uint64)), starts


_PIECE = 1 << 17
_BLANK = re.compile(rb"[ \t-\r]")


def word_hashes(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word of all texts, in order, with A-Z lower-cased, and the number of words of each text.

    Equal words have equal hashes. Texts are worked on in pieces of about 128 KB that end between words, so the
    working memory does not grow with a text, only with its longest word.
    """
    found: list[np.ndarray] = []
    counts = np.zeros(len(texts), dtype=np.int64)
    parts: list[bytes] = []
    begins: list[int] = []
    owners: list[int] = []
    filled = 0

    def work() -> None:
        nonlocal filled
        if filled:
            hashes, starts = _hashes(np.frombuffer(b" ".join(parts), dtype=np.uint8))
            found.append(hashes)
            np.add.at(counts, owners, np.diff(np.append(np.searchsorted(starts, begins), len(starts))))
        parts.clear(), begins.clear(), owners.clear()
        filled = 0

    for k, text in enumerate(texts):
        data, at = (text or "").encode("utf-8", "surrogatepass"), 0
        while at < len(data):
            end = len(data)
            if end - at > _PIECE and (blank := _BLANK.search(data, at + _PIECE)):
                end = blank.start() + 1
            parts.append(data[at:end]), begins.append(filled), owners.append(k)
            filled += end - at + 1
            at = end
            if filled > _PIECE:
                work()
    work()
    return np.concatenate(found) if found else np.empty(0, dtype=np.uint64), counts


_PLACE = _SEED.integers(1, 2**63, size=16, dtype=np.uint64) | np.uint64(1)


def runs_of(hashes: np.ndarray, n: int) -> np.ndarray:
    """The hash of each run of ``n`` consecutive words, in order."""
    if len(hashes) < n:
        return np.empty(0, dtype=np.uint64)
    last = len(hashes) - n + 1
    total = hashes[:last] * _PLACE[0]
    for k in range(1, n):
        total += hashes[k : last + k] * _PLACE[k]
    return mixed(total)


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    values = np.sort(values)
    return values[np.append(True, values[1:] != values[:-1])] if len(values) else values


def shingle_sets(texts: Sequence[str | None], n: int = 5) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its ``n``-word shingles.

    A text of fewer words has its whole sequence as one shingle; a text without words, or null, has none.
    """
    hashes, counts = word_hashes(texts)
    runs = runs_of(hashes, n)
    sets, at = [], 0
    for count in counts.tolist():
        if 0 < count < n:
            sets.append(runs_of(np.append(hashes[at : at + count], np.zeros(n - count, dtype=np.uint64)), n))
        else:
            sets.append(distinct(runs[at : at + max(0, count - n + 1)]))
        at += count
    return sets
