"""Mixing sources to target weights by dependent rounding of copy numbers."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from minelark.llm.texts import quoted, whole, with_columns, words
from minelark.plans.lineage import settle

WEIGHTS = (5, 2, 1)
MOST = 3
CELL = 2_000
FAN = 64


def n_words(text: Column) -> Column:
    return F.size(words(whole(text))).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Add ``target`` to the rows ``source, source_size``.

    Weights repeat along the sources by code point, null last. The size of all is shared by weight; no target is above
    ``most`` times its source, and what is cut off is shared by weight again until none is above: every target is the
    least of its bound and a common level times its weight. In order of bound by weight the level is the one at
    which the sources behind it are not bounded. One row per source: these windows order sources, not documents.
    """
    place = (F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1) % len(weights)
    weighted = sizes.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), place + 1).cast("double"))
    weighted = weighted.withColumn("bound", most * F.col("source_size").cast("double"))
    order = Window.orderBy(F.col("bound") / F.col("w"), F.col("source").isNull(), "source")
    before, every = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    free = F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0.0))
    left = F.sum(F.col("source_size").cast("double")).over(every) - F.coalesce(F.sum("bound").over(before), F.lit(0.0))
    levels = weighted.withColumn("level", left / free)
    level = F.max(F.when(F.col("level") * F.col("w") <= F.col("bound"), F.col("level"))).over(every)
    target = F.least(F.col("bound"), F.coalesce(level, F.lit(0.0)) * F.col("w"))
    return levels.withColumn("target", target).select("source", "source_size", "target")


_STATE = "source string, doc_id {}, size bigint, base int, x double, cell bigint, take int"


def rounded_cell(rows: pa.Table, level: int, last: bool, seed: int) -> pa.Table:
    """Round the fractions ``x`` of one cell of a source: all but one get ``take`` 0 or 1, the last one too if ``last``.

    Documents go pairwise, the largest first, equal ones in the order of a hash of their id: mass (size times fraction)
    moves from one to the other, in a direction drawn so that the expected fractions stay, until one of them is 0 or 1;
    the other goes on. So the mass of a cell stays as it is, but for the last document of all, which this order
    leaves to be a small one.
    """
    source, cell = rows["source"][0].as_py(), rows["cell"][0].as_py()
    random = np.random.default_rng([seed, level, cell, zlib.crc32(repr(source).encode())])
    size, x = rows["size"].to_pylist(), rows["x"].to_pylist()
    take: list[int | None] = [None] * len(x)
    held = None
    for k, draw in enumerate(random.random(len(x)).tolist()):
        if size[k] == 0:
            take[k] = 0
            continue
        if held is None:
            held = k
            continue
        i, a, b = held, size[held], size[k]
        up, down = min(a * (1 - x[i]), b * x[k]), min(a * x[i], b * (1 - x[k]))
        if draw * (up + down) < down:  # mass moves from k to the held one
            if a * (1 - x[i]) <= b * x[k]:
                x[k], take[i], held = x[k] - up / b, 1, k
            else:
                x[i], take[k] = x[i] + up / a, 0
        elif a * x[i] <= b * (1 - x[k]):
            x[k], take[i], held = x[k] + down / b, 0, k
        else:
            x[i], take[k] = x[i] - down / a, 1
        if not 0 < x[held] < 1:  # both became whole
            take[held] = int(x[held] >= 1)
            held = None
    if last and held is not None:
        take[held] = int(random.random() < x[held])
    done = rows.set_column(rows.schema.get_field_index("x"), "x", pa.array(x, pa.float64()))
    return done.set_column(done.schema.get_field_index("take"), "take", pa.array(take, pa.int32()))


def rounding(level: int, last: bool, seed: int) -> Callable[[pa.Table], pa.Table]:
    def round_cell(rows: pa.Table) -> pa.Table:
        ordered = rows.sort_by([("size", "descending"), ("_order", "ascending"), ("doc_id", "ascending")])
        return rounded_cell(ordered.drop_columns("_order"), level, last, seed)

    return round_cell


def copies(units: DataFrame, seed: int = 0, cell: int = CELL, fan: int = FAN) -> DataFrame:
    """``source, doc_id, copies`` for rows ``source, doc_id, size`` of which each names another document.

    Each source takes ``target / source_size`` copies of each document: the whole part of all, the rest rounded. Cells
    of about ``cell`` documents are rounded first; what is left of ``fan`` cells, one document each, is rounded
    together, and so on until one is left of a source. The result depends on the ids and sizes alone.
    """
    of = units.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    of = settle(of)
    shares = targets(of.select("source", "source_size")).withColumnsRenamed({"source": "s2"}).drop("source_size")
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    shares = of.join(shares, F.col("source").eqNullSafe(F.col("s2"))).select(
        F.col("source").alias("s2"), share.alias("share"), F.ceil(F.col("n") / cell).alias("cells")
    )
    shares = settle(shares)
    state = units.join(shares, F.col("source").eqNullSafe(F.col("s2"))).select(
        "source", "doc_id", "size", F.floor("share").cast("int").alias("base"), (F.col("share") - F.floor("share")).alias("x"),
        F.pmod(F.xxhash64("doc_id"), "cells").alias("cell"), F.lit(None).cast("int").alias("take"),
    )
    schema = _STATE.format(dict(units.dtypes)["doc_id"])
    state = settle(state.withColumn("take", F.when(F.col("x") == 0, 0)))
    most = shares.agg(F.max("cells")).first()[0] or 0
    done, level = state.where("take is not null"), 0
    rest = state.where("take is null")
    while most:
        last, placed = most == 1, rest.withColumn("_order", F.xxhash64("doc_id"))
        out = settle(placed.groupBy("source", "cell").applyInArrow(rounding(level, last, seed), schema))
        done = done.unionByName(out.where("take is not null"))
        rest = out.where("take is null").withColumn("cell", F.floor(F.col("cell") / fan))
        most, level = (0 if last else -(-most // fan)), level + 1
    return done.select("source", "doc_id", (F.col("base") + F.col("take")).alias("copies"))


def mix(docs: DataFrame, seed: int = 0) -> DataFrame:
    """Add ``size`` (words), ``source_size``, ``target``, ``copies`` and ``taken`` (words) to documents.

    The sum of ``taken`` of a source differs from its target by less than one document. Null text: size 0, never taken
    but for the whole copies of its source. Null ``source``: a source of its own, last in order. Rows that repeat a
    ``doc_id`` in a source are taken together, as one document of all their words; a null ``doc_id`` is such an id.
    Columns of the added names give way; names starting with ``_mx_`` are reserved.

    Only ids, sources and sizes are shuffled to decide; the join that brings the copies back moves the columns of
    ``docs``, so drop a text that is not needed.
    """
    others = [c for c in docs.columns if c.lower() not in ("size", "source_size", "target", "copies", "taken")]
    docs = docs.select(*quoted(others), n_words(F.col("text")).alias("size"))
    units = settle(docs.groupBy("source", "doc_id").agg(F.sum("size").alias("size")))
    decided = copies(units, seed).withColumnsRenamed({"source": "_mx_a", "doc_id": "_mx_b"})
    of = settle(targets(units.groupBy("source").agg(F.sum("size").alias("source_size")))).withColumnRenamed("source", "_mx_c")
    same = F.col("source").eqNullSafe(F.col("_mx_a")) & F.col("doc_id").eqNullSafe(F.col("_mx_b"))
    met = docs.join(decided, same).join(of, F.col("source").eqNullSafe(F.col("_mx_c")))
    met = with_columns(met, {"copies": F.col("copies").cast("long"), "taken": F.col("copies") * F.col("size")})
    return met.drop("_mx_a", "_mx_b", "_mx_c")
