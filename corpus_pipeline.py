"""From documents to a training mix, in five stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from minelark.llm import decontaminate, line_dedup, mixing, near_dedup, quality
from minelark.llm.texts import quoted
from minelark.plans.lineage import settle


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    row = F.struct(*quoted(docs.columns))  # columns that the verdict would replace stay in it
    return quality.quality(docs.withColumn("_cp_row", row)).where("kept").select("_cp_row.*")


def shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that many of them share; ``n_chars`` follows the text."""
    done = line_dedup.dedup_lines(docs).withColumn("n_chars", F.char_length("text").cast("long"))
    return done.select(*quoted(docs.columns))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that of the least id."""
    printed = docs.withColumn("_cp_print", F.xxhash64("text"))
    found = near_dedup.near_duplicates(printed.select("doc_id", "text", "_cp_print"))
    gone = settle(found.where("not kept").select(F.col("doc_id").alias("id"), F.col("_cp_print").alias("print")).distinct())
    # most documents are not on the list: only those that may be go through the join
    maybe = near_dedup.likely_among(gone, F.col("doc_id"))
    checked = printed.where(maybe).join(
        gone, (F.col("doc_id") == F.col("id")) & (F.col("_cp_print") == F.col("print")), "left_anti"
    )
    return printed.where(~maybe).unionByName(checked).drop("_cp_print")


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontaminate.without_items(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def weighted_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each copy that the mix takes of a document, with ``copy`` from 1 on."""
    return mixing.mix(docs).where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))


STAGES = [
    ("quality_rules", quality_rules),
    ("shared_lines", shared_lines),
    ("near_copies", near_copies),
    ("benchmark_leaks", benchmark_leaks),
    ("weighted_mix", weighted_mix),
]

ORACLE_SQL = None  # the mix is drawn at random; the tests compare with a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir))
    return docs
