"""How many tokens a public tokenizer makes of each text."""

from __future__ import annotations

import os
import string
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from minelark.llm.texts import slices, whole, with_columns

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 512
BATCH_BYTES = 1 << 18
CACHE_PIECES = 200_000
_MARKS = frozenset(string.punctuation)


def _joins(left: str, right: str) -> bool:
    """Whether a text must not be cut between ``left`` and a white-space character before ``right``."""
    a, b = left[-1:], right[:1]
    return not ((a.isalnum() or a in _MARKS) and (b.isalnum() or b in _MARKS)) or not a or not b


def pieces(text: str) -> list[str]:
    """Cut a text before each single space or line feed that stands between two letters, digits or marks.

    A byte-level BPE vocabulary of this kind splits a text by a pattern first, in which a single space opens the next
    part, a single line feed is a part, and no part reaches across either. So these cuts are safe: the tokens of the
    pieces are the tokens of the text. Other white space is never a place to cut.
    """
    out: list[str] = []
    for line_number, line in enumerate(text.split("\n")):
        for place, part in enumerate(line.split(" ")):
            lead = " " if place else "\n" if line_number else ""
            if out and _joins(out[-1], part):
                out[-1] += lead + part
            else:
                out.append(lead + part)
    return out


def batches(texts: list[str], size: int) -> Iterator[list[str]]:
    """Lists of about ``size`` characters."""
    batch, filled = [], 0
    for text in texts:
        batch.append(text)
        filled += len(text)
        if filled >= size:
            yield batch
            batch, filled = [], 0
    if batch:
        yield batch


def token_count(text: Column, path: str) -> Column:
    """The number of tokens of a text that is not null, by the ``tokenizers`` file at ``path``.

    Special strings in a text count as the library counts them by default, and none is added. Each Arrow batch is
    worked on in slices of about a megabyte. Texts are cut at safe places, each distinct piece is encoded once, in
    batches of equal bytes, and only lengths are kept, for at most ``CACHE_PIECES`` pieces at a time.
    """

    @arrow_udf("bigint")
    def count(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
        from tokenizers import Tokenizer

        encoder = Tokenizer.from_file(path)
        known: dict[str, int] = {}
        for column in columns:
            counts: list[int] = []
            for texts in slices(column):
                if len(known) > CACHE_PIECES:
                    known.clear()
                cut = [pieces(text) for text in texts]
                fresh = list(set().union(*cut).difference(known))
                for batch in batches(fresh, BATCH_BYTES):
                    done = encoder.encode_batch_fast(batch, add_special_tokens=False)
                    known.update(zip(batch, map(len, done)))
                counts.extend(sum(map(known.__getitem__, parts)) for parts in cut)
            yield pa.array(counts, pa.int64())

    return count(text)


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """Add ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens).

    The columns replace columns of these names. Null text counts as empty: 0 bytes, 0 tokens. Repeated rows are each
    counted. ``path`` is the place of a byte-level BPE file that every executor can read, such as a file of an
    installed package. Nothing is shuffled.
    """
    text = whole(F.col("text"))
    docs = with_columns(docs, {"n_bytes": F.octet_length(text).cast("long"), "n_tokens": token_count(text, path)})
    return with_columns(docs, {"over_limit": F.col("n_tokens") > limit})
