"""Finding short test items inside long documents."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from minelark.llm.texts import distinct, shingle_sets, slices, whole
from minelark.plans.lineage import settle

WORDS = 5
PERCENT = 75
BLOCK_SHINGLES = 1_000_000


def sketch_length(size: int, percent: int) -> int:
    """How many of its least hashes an item of ``size`` shingles is searched by.

    Items are partitioned by size into powers of two, and a partition has one length, set by its largest size: a
    document that holds ``percent`` of an item misses fewer shingles than that, so it holds one of those searched for.
    """
    largest = (1 << size.bit_length()) - 1
    return largest - -(-percent * largest // 100) + 1


class Block:
    """Some items: their sorted sets, and an index from the hashes of their sketches to the items."""

    def __init__(self, ids: list, sets: list[np.ndarray], percent: int):
        self.ids, self.sets, self.percent = ids, sets, percent
        sketches = [s[: sketch_length(len(s), percent)] for s in sets]
        hashes = np.concatenate(sketches) if sketches else np.empty(0, dtype=np.uint64)
        owners = np.repeat(np.arange(len(sketches)), [len(s) for s in sketches])
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.owners = hashes[order], owners[order]
        self.shift = np.uint64(64 - max(16, (16 * len(hashes)).bit_length()))
        self.known = np.zeros(1 << (64 - int(self.shift)), dtype=bool)  # whether a hash can be searched for, by its head
        self.known[(self.hashes >> self.shift).astype(np.int64)] = True

    def found_in(self, shingles: np.ndarray) -> list[tuple[int, int]]:
        """The items of which these sorted shingles hold enough, and how many each."""
        probes = shingles[self.known[(shingles >> self.shift).astype(np.int64)]]
        first, last = (np.searchsorted(self.hashes, probes, side) for side in ("left", "right"))
        met = np.flatnonzero(last > first)
        candidates = distinct(np.concatenate([self.owners[first[k] : last[k]] for k in met])) if len(met) else []
        found = []
        for item in candidates:
            own = self.sets[item]
            at = np.minimum(np.searchsorted(shingles, own), len(shingles) - 1)
            shared = int((shingles[at] == own).sum())
            if 100 * shared >= self.percent * len(own):
                found.append((int(item), shared))
        return found


def item_blocks(items: DataFrame, percent: int = PERCENT, block_shingles: int = BLOCK_SHINGLES) -> Iterator[Block]:
    """The items with words, in blocks of about ``block_shingles`` shingles: the bound of what a task holds of them."""
    set_of = pa.list_(pa.int64())

    @arrow_udf("array<bigint>")
    def shingles(column: pa.Array) -> pa.Array:
        sets = [s.view(np.int64) for texts in slices(column) for s in shingle_sets(texts, WORDS)]
        return pa.array(sets, set_of)

    sets = settle(items.select("item_id", shingles(whole(F.col("text"))).alias("set")).where("size(set) > 0"))
    total = sets.agg(F.sum(F.size("set"))).first()[0] or 0
    blocks = -(-total // block_shingles)
    for block in range(blocks):
        rows = sets.where(F.pmod(F.xxhash64("set"), F.lit(blocks)) == block).collect()
        yield Block([r.item_id for r in rows], [np.array(r.set, dtype=np.int64).view(np.uint64) for r in rows], percent)


def items_in(text: Column, block: Block, item_type: str) -> Column:
    """The items of a block that a text holds: ``item_id``, shingles ``shared`` and ``of`` how many."""

    @arrow_udf(f"array<struct<item_id:{item_type},shared:bigint,of:bigint>>")
    def search(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            rows = []
            for texts in slices(column):
                for shingles in shingle_sets(texts, WORDS):
                    rows.append([
                        {"item_id": block.ids[item], "shared": shared, "of": len(block.sets[item])}
                        for item, shared in block.found_in(shingles)
                    ])
            yield pa.array(rows, pa.list_(pa.struct([("item_id", id_type), ("shared", pa.int64()), ("of", pa.int64())])))

    id_type = pa.string() if item_type == "string" else pa.int64()
    return search(text)


def contained_items(docs: DataFrame, items: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``doc_id, item_id, n_shared, n_item, containment`` of each test item that a document holds.

    It holds an item if it has at least ``percent`` of its distinct five-word shingles (A-Z lower-cased). A text of
    fewer than five words has its whole sequence as one shingle; a null text, or one without words, holds nothing and is
    nowhere held. Repeated rows give their pairs once; null ids are kept as they are.

    Items are searched by bottom-k min-hash sketches, partitioned by size, which miss nothing, and then compared on
    their full sets. Documents stay where they are: they are read once per block of items, and only blocks travel.
    """
    id_type = dict(items.dtypes)["item_id"]
    id_type = id_type if id_type == "string" else "bigint"
    columns = "doc_id", F.explode(F.col("_bd_found")).alias("_bd_f")
    parts = [
        docs.select("doc_id", items_in(whole(F.col("text")), block, id_type).alias("_bd_found")).select(*columns)
        for block in item_blocks(items, percent)
    ]
    pairs = parts[0] if parts else docs.select("doc_id", F.lit(None).cast(
        f"struct<item_id:{id_type},shared:bigint,of:bigint>").alias("_bd_f")).where("false")
    for part in parts[1:]:
        pairs = pairs.unionByName(part)
    shared, of = F.col("_bd_f.shared"), F.col("_bd_f.of")
    return pairs.select(
        "doc_id", "_bd_f.item_id", shared.alias("n_shared"), of.alias("n_item"), (shared / of).alias("containment")
    ).distinct()


def without_items(docs: DataFrame, items: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The documents that hold no test item, as they are (see :func:`contained_items`); nothing is shuffled."""
    id_type = dict(items.dtypes)["item_id"]
    for block in item_blocks(items, percent):
        docs = docs.where(F.size(items_in(whole(F.col("text")), block, id_type if id_type == "string" else "bigint")) == 0)
    return docs
