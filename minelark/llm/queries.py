"""The registered queries of this subpackage: each operator over its whole table, cut down to its digest columns."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from minelark.llm import (
    decontaminate, html_text, line_dedup, manifest, mixing, near_dedup, ngram_model, pii, quality, secret_scan, set_join, spelling,
    token_counts,
)
from minelark.llm.spans import span_digests


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
    return ngram_model.score_documents(table(spark, sf_dir, "documents")).select("doc_id", "held_out", *columns)


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def base_counts(spans: str, kinds: tuple[str, ...]) -> list[Column]:
    """The number ``n_<kind>`` of base spans of each kind."""

    def of(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s.base & (s.kind == kind))).cast("long").alias(f"n_{kind}")

    return [of(kind) for kind in kinds]


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan_secrets(table(spark, sf_dir, "documents"))
    digests = span_digests(F.col("secrets"), secret_scan.BASE_KINDS, secret_scan.KINDS)
    counts = base_counts("secrets", secret_scan.BASE_KINDS)
    return found.select("doc_id", *counts, digests.alias("d")).select("*", "d.*").drop("d")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return quality.quality(table(spark, sf_dir, "documents")).select("doc_id", *counts, "base_failed", "kept")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(token_counts.VOCABULARY)
    counted = token_counts.count_tokens(table(spark, sf_dir, "documents"), str(path))
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf_dir, "documents"))
    digests = span_digests(F.col("pii"), pii.BASE_KINDS, pii.KINDS)
    return found.select("doc_id", *base_counts("pii", pii.BASE_KINDS), digests.alias("d")).select("*", "d.*").drop("d")


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    made = manifest.manifest(docs.withColumn("tampered_leaf", F.when(tampered, manifest.lowered_leaf())))
    folded = manifest.folded(F.coalesce("tampered_leaf", "leaf"), F.col("proof"))
    rows = made.select("doc_id", "leaf", "subroot", "root", manifest.proof_digest(F.col("proof")).alias("proof_sha256"), folded.alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = set_join.similar_documents(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


QUERIES = {name: f for name, f in list(globals().items()) if name.startswith("op")}
