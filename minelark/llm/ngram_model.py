"""An interpolated modified Kneser-Ney bigram model: counted in Spark, kept as sorted hash arrays, memory-mapped.

The model is a folder of ``.npy`` files that all executors mount:

* ``w<shard>``: sorted hashes of words, ``c<shard>``: how often each occurs. The place in this order is a word's id.
* ``g<shard>``: sorted hashes of pairs of ids, ``n<shard>``: how often each pair occurs. A pair is scrambled by a
  bijection, so no two pairs share a hash.
* ``s<block>``: per id how many words precede it, and how many follow it once, twice, and three or more times.

A shard holds a range of hashes, so its size does not depend on what words are frequent.
"""

from __future__ import annotations

import os
import struct
from collections.abc import Iterator
from urllib.parse import urlparse
from uuid import uuid4

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from minelark.llm.texts import mixed, quoted, slices, whole, with_columns, word_hashes
from minelark.plans.lineage import shared_folder

END = np.uint64(0x5851F42D4C957F2D)
CHUNK_TOKENS = 1_000_000
SHARD_TOKENS = 1_000_000
BLOCK_BITS = 16
FALLBACK = (0.5, 1.0, 1.5)  # discounts where the counts of counts give none
_LOW = np.uint64(0xFFFFFFFF)
_INVERSE = tuple(np.uint64(pow(m, -1, 2**64)) for m in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def unmixed(x: np.ndarray) -> np.ndarray:
    """The inverse of :func:`minelark.llm.texts.mixed`."""

    def undo(x: np.ndarray, by: int) -> np.ndarray:
        y = x
        for _ in range(63 // by):
            y = x ^ (y >> np.uint64(by))
        return y

    return undo(undo(undo(x, 31) * _INVERSE[1], 27) * _INVERSE[0], 30)


def pack(*columns: np.ndarray) -> bytes:
    """Integer columns of one length as a compressed blob; the first is sorted and goes as differences."""
    first, *rest = (np.asarray(c).astype(np.uint64) for c in columns)
    parts = [np.diff(first, prepend=np.uint64(0)), *rest]
    planes = b"".join(part.view(np.uint8).reshape(-1, 8).T.tobytes() for part in parts)
    return struct.pack("<qq", len(first), len(parts)) + zstandard.ZstdCompressor(level=1).compress(planes)


def unpack(blob: bytes) -> list[np.ndarray]:
    n, k = struct.unpack_from("<qq", blob)
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob[16:], max_output_size=8 * n * k), np.uint8)
    parts = [np.ascontiguousarray(planes[8 * n * i : 8 * n * (i + 1)].reshape(8, n).T).view(np.uint64).ravel() for i in range(k)]
    return [np.cumsum(parts[0], dtype=np.uint64), *parts[1:]]


def summed(keys: np.ndarray, *counts: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct keys and the sums of their counts."""
    if not len(keys):
        return [keys, *counts]
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return [keys[first], *[np.add.reduceat(c[order], first) for c in counts]]


def counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and how often each occurs."""
    keys = np.sort(keys)
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.empty(0, dtype=np.int64)
    return keys[first], np.diff(np.append(first, len(keys))).astype(np.uint64)


def save(folder: str, name: str, values: np.ndarray) -> None:
    """Write an array whole or not at all; a task that runs again writes the same."""
    path = os.path.join(folder, f"{name}.npy")
    part = f"{path}.{uuid4().hex}"
    with open(part, "wb") as file:
        np.save(file, values)
    os.replace(part, path)


def narrow(values: np.ndarray) -> np.ndarray:
    return values.astype(np.min_scalar_type(int(values.max()))) if values.size else values


def token_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of the tokens of all texts, each text closed by ``END``, and the number of tokens of each."""
    hashes, counts = word_hashes(texts)
    return np.insert(hashes, np.cumsum(counts), END), counts + 1


def shards_of(keys: np.ndarray, bits: int) -> Iterator[tuple[int, slice]]:
    """The shards of sorted keys, by their ``bits`` leading bits, that are not empty."""
    heads = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), dtype=np.int64)
    first = np.flatnonzero(np.append(True, heads[1:] != heads[:-1])) if len(heads) else []
    for start, end in zip(first, [*first[1:], len(keys)]):
        yield int(heads[start]), slice(start, end)


class Sorted:
    """Memory-mapped shards of sorted keys."""

    def __init__(self, folder: str, name: str, sizes: dict[int, int], bits: int):
        self.bits = bits
        self.shards = {k: np.load(os.path.join(folder, f"{name}{k}.npy"), mmap_mode="r") for k in sizes}
        self.before = dict(zip(sorted(sizes), np.cumsum([0, *[sizes[k] for k in sorted(sizes)]]).tolist()))

    def places(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key among all, -1 where it is absent. Keys are searched in order, so pages are read once."""
        order = np.argsort(keys)
        wanted, out = keys[order], np.full(len(keys), -1, dtype=np.int64)
        for k, part in shards_of(wanted, self.bits):
            if k in self.shards:
                here, some = self.shards[k], wanted[part]
                at = np.minimum(np.searchsorted(here, some), len(here) - 1)
                out[order[part]] = np.where(here[at] == some, at + self.before[k], -1)
        return out


class Values:
    """Memory-mapped values by place, in parts that begin at ``starts``."""

    def __init__(self, folder: str, name: str, starts: dict[int, int]):
        self.starts = np.array(sorted(starts.values()), dtype=np.int64)
        self.parts = [np.load(os.path.join(folder, f"{name}{k}.npy"), mmap_mode="r") for k in sorted(starts, key=starts.get)]

    def at(self, places: np.ndarray) -> np.ndarray:
        """The values at places; 0 at -1."""
        shape = self.parts[0].shape[1:] if self.parts else ()
        out = np.zeros((len(places), *shape), dtype=np.int64)
        part = np.searchsorted(self.starts, places, side="right") - 1
        for k in np.unique(part[places >= 0]).tolist():
            here = np.flatnonzero((part == k) & (places >= 0))
            out[here] = self.parts[k][places[here] - self.starts[k]]
        return out


def chunks(column_batches: Iterator[pa.RecordBatch], tokens_of) -> Iterator[np.ndarray]:
    """The keys that ``tokens_of`` makes of texts, in arrays of about ``CHUNK_TOKENS``."""
    held, n = [], 0
    for batch in column_batches:
        for texts in slices(batch.column(0)):
            keys = tokens_of(texts)
            held.append(keys)
            n += len(keys)
            if n >= CHUNK_TOKENS:
                yield np.concatenate(held)
                held, n = [], 0
    if held:
        yield np.concatenate(held)


def count_keys(texts: DataFrame, keys_of, bits: int) -> DataFrame:
    """``shard, blob``: keys counted in chunks where the texts are, cut at the bounds of shards."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, keys_of()):
            keys, counts = counted(chunk)
            for shard, part in shards_of(keys, bits):
                yield pa.record_batch({
                    "shard": pa.array([shard], pa.int32()), "blob": pa.array([pack(keys[part], counts[part])], pa.binary()),
                })

    return texts.mapInArrow(count, "shard int, blob binary")


def merged(blobs: pa.Table) -> list[np.ndarray]:
    parts = [unpack(blob) for column in blobs["blob"].chunks for blob in column.to_pylist()]
    return summed(*[np.concatenate(columns) for columns in zip(*parts)])


def shard_bits(tokens: int) -> int:
    return max(0, (tokens // SHARD_TOKENS).bit_length())


def count_of_counts(counts: np.ndarray) -> list[int]:
    """How many counts are 1, 2, 3 and 4."""
    return [int((counts == k).sum()) for k in (1, 2, 3, 4)]


def discounts(n: list[int]) -> tuple[float, float, float]:
    """What is taken off counts of one, of two, and of three or more, from the counts of counts 1 to 4."""
    if not all(n):
        return FALLBACK
    y = n[0] / (n[0] + 2 * n[1])
    found = tuple(k - (k + 1) * y * n[k] / n[k - 1] for k in (1, 2, 3))
    return found if all(0 < d <= k for k, d in zip((1, 2, 3), found)) else FALLBACK


def mounted_folder(spark) -> str:
    """A folder of its own below ``spark.checkpoint.dir``, as a path that files can be mapped from."""
    shared = urlparse(shared_folder(spark))
    if shared.scheme not in ("", "file"):
        raise ValueError("memory mapping needs a spark.checkpoint.dir that all executors mount as a file system")
    folder = os.path.join(shared.path, "minelark", spark.sparkContext.applicationId, f"lm-{uuid4().hex}")
    os.makedirs(folder)
    return folder


class Model:
    """Where a model is and its totals; small, so it travels with the tasks, which open the files by themselves."""

    def __init__(self, folder: str):
        self.folder = folder
        self.word_bits = self.pair_bits = 0
        self.words: dict[int, int] = {}  # sizes by shard
        self.pairs: dict[int, int] = {}
        self.starts: dict[int, int] = {}  # of the blocks of ids
        self.tokens = self.vocabulary = self.distinct_pairs = 0
        self.word_discounts = self.pair_discounts = FALLBACK
        self.word_rest = 0.0  # the share of the unigram model that goes to the uniform one

    def sorted_words(self) -> Sorted:
        return Sorted(self.folder, "w", self.words, self.word_bits)

    def counts(self, name: str, sizes: dict[int, int]) -> Values:
        order = sorted(sizes)
        return Values(self.folder, name, dict(zip(order, np.cumsum([0, *[sizes[k] for k in order]]).tolist())))


def pair_hashes(tokens: np.ndarray, counts: np.ndarray, vocabulary: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each token's id with that of the token before it, and the latter; the id ``vocabulary`` begins texts."""
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[np.cumsum(counts) - counts] = vocabulary
    return mixed((before.astype(np.uint64) << np.uint64(32)) | (tokens.astype(np.uint64) & _LOW)), before


def train(texts: DataFrame) -> Model:
    """Count a model over the whole column ``text``.

    Two passes: words, then pairs of ids. Each task counts chunks of a million tokens and sends sorted, packed shards;
    a shard is merged by one task, which writes it. Only sizes and totals reach the driver.
    """
    spark = texts.sparkSession
    texts = texts.select(whole(F.col("text")).alias("text"))
    model = Model(mounted_folder(spark))
    folder, size = model.folder, texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = model.word_bits = shard_bits(size // 8)

    def write_words(blobs: pa.Table) -> pa.Table:
        shard = blobs["shard"][0].as_py()
        keys, counts = merged(blobs)
        save(folder, f"w{shard}", keys)
        save(folder, f"c{shard}", narrow(counts))
        return pa.table({"shard": pa.array([shard], pa.int32()), "n": [len(keys)], "tokens": [int(counts.sum())]})

    counted_words = count_keys(texts, lambda: lambda some: token_hashes(some)[0], bits)
    rows = counted_words.groupBy("shard").applyInArrow(write_words, "shard int, n bigint, tokens bigint").collect()
    model.words = {r.shard: r.n for r in rows}
    model.tokens, model.vocabulary = sum(r.tokens for r in rows), sum(model.words.values())
    if model.vocabulary >= 2**32 - 1:
        raise ValueError("the model takes fewer than 2**32 - 1 distinct words")
    vocabulary, pair_bits = model.vocabulary, shard_bits(model.tokens)
    model.pair_bits = pair_bits

    def pairs_of():
        ids = model.sorted_words()

        def pairs(some: list[str]) -> np.ndarray:
            tokens, counts = token_hashes(some)
            return pair_hashes(ids.places(tokens), counts, vocabulary)[0]

        return pairs

    def write_pairs(blobs: pa.Table) -> pa.Table:
        shard = blobs["shard"][0].as_py()
        keys, counts = merged(blobs)
        save(folder, f"g{shard}", keys)
        save(folder, f"n{shard}", narrow(counts))
        pairs = unmixed(keys)
        after, before = pairs & _LOW, pairs >> np.uint64(32)
        one = np.ones(len(keys), dtype=np.uint64)
        zero = np.zeros(2 * len(keys), dtype=np.uint64)
        columns = [zero.copy() for _ in range(4)]
        columns[0][: len(keys)] = one
        for k, mask in ((1, counts == 1), (2, counts == 2), (3, counts > 2)):
            columns[k][len(keys) :] = mask
        ids, *sums = summed(np.concatenate([after, before]), *columns)
        blocks, parts = ids >> np.uint64(BLOCK_BITS), []
        first = np.flatnonzero(np.append(True, blocks[1:] != blocks[:-1]))
        for start, end in zip(first, [*first[1:], len(ids)]):
            parts.append((int(blocks[start]), pack(*[c[start:end] for c in (ids, *sums)])))
        totals = [shard, len(keys), *count_of_counts(counts)]
        return pa.table({
            "block": pa.array([-1, *[b for b, _ in parts]], pa.int64()),
            "blob": pa.array([np.array(totals, dtype=np.int64).tobytes(), *[blob for _, blob in parts]], pa.binary()),
        })

    def write_block(blobs: pa.Table) -> pa.Table:
        block = blobs["block"][0].as_py()
        if block < 0:
            totals = [np.frombuffer(b, dtype=np.int64).tolist() for c in blobs["blob"].chunks for b in c.to_pylist()]
            return pa.table({"block": pa.array([block] * len(totals), pa.int64()), "totals": pa.array(totals, pa.list_(pa.int64()))})
        ids, *sums = merged(blobs)
        start = block << BLOCK_BITS
        dense = np.zeros((min(1 << BLOCK_BITS, vocabulary + 1 - start), 4), dtype=np.uint64)
        dense[(ids - np.uint64(start)).astype(np.int64)] = np.stack(sums, 1)
        save(folder, f"s{block}", narrow(dense))
        preceded = dense[:, 0]
        totals = [*count_of_counts(preceded), int((preceded > 2).sum())]
        return pa.table({"block": pa.array([block], pa.int64()), "totals": pa.array([totals], pa.list_(pa.int64()))})

    written = count_keys(texts, pairs_of, pair_bits).groupBy("shard").applyInArrow(write_pairs, "block bigint, blob binary")
    rows = written.groupBy("block").applyInArrow(write_block, "block bigint, totals array<bigint>").collect()
    shards, blocks = [r.totals for r in rows if r.block < 0], [r for r in rows if r.block >= 0]
    model.pairs = {t[0]: t[1] for t in shards}
    model.distinct_pairs = sum(model.pairs.values())
    model.starts = {r.block: r.block << BLOCK_BITS for r in blocks}
    model.pair_discounts = discounts([sum(t[k] for t in shards) for k in range(2, 6)])
    counts = [sum(r.totals[k] for r in blocks) for k in range(5)]
    model.word_discounts = discounts(counts[:4])
    once, twice, more = model.word_discounts
    if model.distinct_pairs:
        model.word_rest = (once * counts[0] + twice * counts[1] + more * counts[4]) / model.distinct_pairs
    return model


def discounted(counts: np.ndarray, by: tuple[float, float, float]) -> np.ndarray:
    return counts - np.array([0.0, *by])[np.minimum(counts, 3)]


_SCORES = [("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())]


def scores(text: Column, model: Model) -> Column:
    """Per text its tokens, how many of them the model knows, the base score and the model's log10 probability."""

    @arrow_udf("struct<n_tokens:bigint,n_known:bigint,base_score:double,score:double>")
    def score(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        trained = model.vocabulary > 0
        words, counts = model.sorted_words(), model.counts("c", model.words)
        pairs, pair_counts = Sorted(model.folder, "g", model.pairs, model.pair_bits), model.counts("n", model.pairs)
        stats = Values(model.folder, "s", model.starts)
        size = model.vocabulary + 1
        documents = int(counts.at(words.places(np.array([END])))[0])

        def probabilities(ids: np.ndarray, before: np.ndarray, grams: np.ndarray, known: np.ndarray) -> np.ndarray:
            if not trained:
                return np.ones(len(ids))
            alone = discounted(stats.at(ids)[:, 0], model.word_discounts) / model.distinct_pairs + model.word_rest / size
            total = np.where(before == model.vocabulary, documents, np.append(0, known[:-1]))  # of the token before
            rest = stats.at(before)[:, 1:] @ np.array(model.pair_discounts)
            seen = pair_counts.at(pairs.places(grams))
            seen[(ids < 0) | (before < 0)] = 0
            total = np.maximum(total, 1)
            return np.where(before < 0, alone, discounted(seen, model.pair_discounts) / total + rest / total * alone)

        for column in columns:
            out = [[] for _ in _SCORES]
            for texts in slices(column):
                tokens, lengths = token_hashes(texts)
                ids = words.places(tokens)
                known = counts.at(ids)
                grams, before = pair_hashes(ids, lengths, model.vocabulary)
                starts = np.cumsum(lengths) - lengths
                base = np.log10((known + 1) / (model.tokens + model.vocabulary + 1))
                full = np.log10(probabilities(ids, before, grams, known))
                out[0].append(lengths)
                for place, values in enumerate((known > 0, base, full), start=1):
                    out[place].append(np.add.reduceat(values, starts, dtype=np.int64 if place == 1 else np.float64))
            arrays = [pa.array(np.concatenate(o) if o else [], kind) for o, (_, kind) in zip(out, _SCORES)]
            yield pa.StructArray.from_arrays(arrays, names=[name for name, _ in _SCORES])

    return score(text)


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 2 when divided by 7; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 7 == 2


def score_documents(docs: DataFrame) -> DataFrame:
    """Train on the documents that are not held out, and score all.

    Adds ``held_out, n_tokens, n_known, train_tokens, base_score, score`` to the columns of ``docs`` but for ``text``;
    columns of these names give way. Null text counts as empty: one token, the end. Repeated rows each count. Without
    any document to train on, every probability is 1. Perplexity is ``10 ** (-score / n_tokens)``.
    """
    out = held_out(F.col("doc_id"))
    model = train(docs.where(~out).select("text"))
    others = [c for c in docs.columns if c.lower() != "text"]
    scored = docs.select(*quoted(others), out.alias("_lm_out"), scores(whole(F.col("text")), model).alias("_lm"))
    return with_columns(scored, {
        "held_out": F.col("_lm_out"), "n_tokens": F.col("_lm.n_tokens"), "n_known": F.col("_lm.n_known"),
        "train_tokens": F.lit(model.tokens).cast("long"), "base_score": F.col("_lm.base_score"), "score": F.col("_lm.score"),
    }).drop("_lm", "_lm_out")
