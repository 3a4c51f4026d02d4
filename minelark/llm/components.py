"""Connected components of an undirected graph by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from minelark.plans.lineage import release, settle


def large_star(edges: DataFrame) -> DataFrame:
    """Each node ties its larger neighbours to the least node next to it or itself."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    tied = both.where("v > u").join(least, "u")
    return tied.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Each node ties itself and its smaller neighbours to the least of these."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    tied = edges.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``u, v`` for each node ``u`` that is not the least of its component: ``v`` is.

    ``edges`` has distinct ids in ``u`` and ``v``, in any order. Both steps aggregate to a minimum per node and join it
    to the edges, so the neighbours of a node are never gathered. Every round is stored; only two numbers of it reach
    the driver, to see whether it changed anything.
    """
    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct()
    edges, before = settle(edges), None
    while True:
        now = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before or now[0] == 0:
            return edges
        before, last = now, edges
        edges = settle(small_star(large_star(last)))
        release(last)
