"""Pairing the members of a group without letting one group fill one task.

A group of more than ``hot_rows`` rows is cut into blocks of about ``block_rows``, by a hash of the member; two blocks
meet in one cell. So a row goes to as many cells as its own group has blocks, one for all but the large groups, and the
work of a cell is bounded whatever the size of the group. The sizes come from a combined count in the same plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from minelark.plans import pair_cells

HOT_ROWS = 2000
BLOCK_ROWS = 1024


def block_of(member: str | Column, blocks: Column) -> Column:
    """Block number of a member among ``blocks`` blocks, from a hash of its value."""
    return F.pmod(F.xxhash64(member), blocks).cast("int")


def spread_over_cells(df: DataFrame, blocks: Column) -> DataFrame:
    """Copy each row to every cell (lo, hi) its ``block`` takes part in, lo <= hi."""
    other = F.explode(F.sequence(F.lit(0), blocks.cast("int") - 1)).alias("_other")
    return df.select("*", other).select(
        *df.columns,
        F.least("block", "_other").alias("lo"),
        F.greatest("block", "_other").alias("hi"),
    )


def cells(rows: DataFrame, key: Sequence[str], hot_rows: int, block_rows: int) -> DataFrame:
    """Rows with their ``block``, once for each cell ``lo, hi`` of their group; ``_m`` is the member.

    Groups of one row pair nothing and are left out.
    """
    counts = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1")
    blocks = F.when(F.col("_rows") > hot_rows, F.ceil(F.col("_rows") / block_rows)).otherwise(1).cast("int")
    placed = rows.join(counts, list(key)).withColumn("_blocks", blocks)
    placed = placed.withColumn("block", block_of("_m", F.col("_blocks")))
    return spread_over_cells(placed, F.col("_blocks")).drop("_rows", "_blocks")


def _paired(rows: DataFrame, key: list[str], hot_rows: int, block_rows: int, carried: Sequence[str] = ()) -> DataFrame:
    """``key..., _x, _y`` once for any two members of a group, and both weights ``_wx, _wy`` if there are any.

    ``carried`` columns of both members come along as ``x_<name>`` and ``y_<name>``.

    The pairs are far more than the rows, so the join is a sort-merge one even where a side is small: its partitions can
    be split, and it spills.
    """
    spread, cell = cells(rows, key, hot_rows, block_rows), [*key, "lo", "hi"]
    names = (
        ("lo", {"_m": "_x", "_w": "_wx", **{c: f"x_{c}" for c in carried}}),
        ("hi", {"_m": "_y", "_w": "_wy", **{c: f"y_{c}" for c in carried}}),
    )
    left, right = (
        spread.where(F.col("block") == F.col(at)).select(
            *cell, *[F.col(c).alias(side[c]) for c in side if c in rows.columns]
        )
        for at, side in names
    )
    return left.join(right.hint("merge"), cell).where((F.col("lo") < F.col("hi")) | (F.col("_x") < F.col("_y")))


def member_pairs(
    rows: DataFrame,
    key: Sequence[str],
    member: str,
    hot_rows: int = HOT_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``key..., a, b`` with a < b for members sharing a key.

    For callers that need the occurrences themselves, such as the next level of an
    itemset search. Where only totals per pair are wanted, use :func:`pair_totals`.
    """
    key = list(key)
    pairs = _paired(rows.select(*key, F.col(member).alias("_m")), key, hot_rows, block_rows)
    return pairs.select(*key, F.least("_x", "_y").alias("a"), F.greatest("_x", "_y").alias("b"))


def pair_totals(
    rows: DataFrame,
    key: Sequence[str],
    member: str,
    weight: str | None = None,
    by: Sequence[str] = (),
    without: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
    block_rows: int = BLOCK_ROWS,
    carried: Sequence[str] = (),
    where: Column | None = None,
    of_member: Sequence[str] = (),
) -> DataFrame:
    """Per pair of members a < b: the number ``n`` of keys holding both.

    With ``weight`` also ``dot``, the sum over those keys of the product of both weights; a product with a null weight
    is left out, and ``dot`` is null where no product is left.
    ``by`` names key columns kept in the result. ``rows`` holds each (key, member) once.
    ``where`` drops pairs as they meet; it sees ``carried`` columns of both members as ``x_<name>`` and ``y_<name>``.
    Pairs ``a, b`` listed in ``without`` are left out: they join the same aggregate as rows
    with a count of 0, which needs neither another shuffle nor a sort of the pairs.

    ``of_member`` names columns of doubles that depend on the member alone; the result has them as ``a_<name>, b_<name>``.

    Integer members are counted in cells (:mod:`minelark.plans.pair_cells`). Elsewhere, and with ``by`` or ``where``, the
    pairs feed a partial aggregate, whatever the size of their group.
    """
    key, by = list(key), list(by)
    if not by and where is None and not carried and dict(rows.dtypes)[member] in ("bigint", "int"):
        return pair_cells.totals(rows, key, member, weight, without, of_member)
    if of_member:
        found = pair_totals(rows, key, member, weight, by, without, hot_rows, block_rows)
        for end in "ab":
            ends = rows.select(F.col(member).alias(end), *[F.col(c).cast("double").alias(f"{end}_{c}") for c in of_member]).distinct()
            found = found.join(ends, end)
        return found
    weights = [F.col(weight).cast("double").alias("_w")] if weight else []
    rows = rows.where(F.col(member).isNotNull()).select(*key, F.col(member).alias("_m"), *weights, *carried)
    met = _paired(rows, key, hot_rows, block_rows, carried)
    parts = (met if where is None else met.where(where)).select(
        *by, F.least("_x", "_y").alias("a"), F.greatest("_x", "_y").alias("b"), F.lit(1).cast("long").alias("n"),
        *([(F.col("_wx") * F.col("_wy")).alias("dot")] if weight else []),
    )
    totals = [F.sum("n").alias("n")] + ([F.sum("dot").alias("dot")] if weight else [])
    if without is None:
        return parts.groupBy(*by, "a", "b").agg(*totals)
    barred = without.select("a", "b", F.lit(0).cast("long").alias("n"))
    parts = parts.unionByName(barred, allowMissingColumns=True)
    least = F.min("n").alias("_least")
    return parts.groupBy(*by, "a", "b").agg(*totals, least).where("_least > 0").drop("_least")


def spread(df: DataFrame) -> DataFrame:
    """``df`` in at least as many partitions as tasks can run at once.

    For costly work on few large files; an input of many splits stays where it is.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(slots) if df.rdd.getNumPartitions() < slots else df


def join_spread(rows: DataFrame, table: DataFrame, keys: Sequence[str], by: str, salts: int = 32) -> DataFrame:
    """``rows`` joined to ``table`` on ``keys`` that many rows may share; ``table`` has few rows for a key.

    Rows are salted by a hash of ``by``, and the table has a copy for each salt that its keys occur with.
    """
    keys = list(keys)
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(by), F.lit(salts)))
    copies = salted.select(*keys, "_salt").distinct().join(table, keys)
    return salted.join(copies, [*keys, "_salt"]).drop("_salt")
