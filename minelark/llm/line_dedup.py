"""Dropping lines that many documents share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from minelark.llm.texts import WHITE, ascii_lower, let, whole, with_columns
from minelark.plans.lineage import settle

MIN_CHARS = 40
MIN_DOCUMENTS = 5


def line_hashes(text: Column, min_chars: int) -> Column:
    """Per line the md5 (128 bits) of its normalised form, null for lines whose form is shorter than ``min_chars``."""
    keys = F.transform(F.split(ascii_lower(text), "\n"), lambda line: F.btrim(line, F.lit(WHITE)))
    return F.transform(keys, lambda key: F.when(F.char_length(key) >= min_chars, F.unhex(F.md5(key))))


def kept_lines(lines: Column, dropped: Column) -> Column:
    """The lines joined without the positions in the sorted array ``dropped``: the stretches between these."""
    return let(
        F.concat(F.array(F.lit(-1)), dropped, F.array(F.size(lines))),
        lambda bound: F.array_join(
            F.flatten(
                F.transform(
                    F.sequence(F.lit(0), F.size(bound) - 2),
                    lambda k: F.slice(lines, bound[k] + 2, bound[k + 1] - bound[k] - 1),
                )
            ),
            "\n",
        ),
    )


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """Drop the lines that at least ``min_documents`` documents share, but for those of the largest ``doc_id``.

    Lines are compared without white space at both ends and with A-Z lower-cased; forms under ``min_chars`` code
    points always stay. Returns the columns of ``docs``, ``text`` being the kept lines joined by a line feed, and
    ``n_lines`` (before dropping) and ``n_dropped``, which replace columns of these names.

    Null text: one empty line. Null ``doc_id``: the row counts for no line and loses none. Rows that repeat a
    ``doc_id`` are one document when lines are counted, and each loses its lines. Names starting with ``_ld_`` are
    reserved.

    Two aggregates of (hash, document) pairs find the frequent lines, combining before each shuffle, so a line in a
    third of all documents costs its tasks no more than any other. Texts are shuffled once, to meet their positions.
    """
    docs = docs.withColumn("_ld_text", whole(F.col("text")))
    identity = [F.col("doc_id").alias("_ld_doc"), F.xxhash64("_ld_text").alias("_ld_print")]
    lines = docs.where("doc_id is not null").select(
        *identity, F.posexplode(line_hashes(F.col("_ld_text"), min_chars)).alias("_ld_at", "_ld_hash")
    ).where("_ld_hash is not null")
    frequent = settle(
        lines.select("_ld_hash", "_ld_doc").distinct()
        .groupBy("_ld_hash").agg(F.count(F.lit(1)).alias("_ld_n"), F.max("_ld_doc").alias("_ld_last"))
        .where(F.col("_ld_n") >= min_documents).select("_ld_hash", "_ld_last")
    )
    dropped = (
        lines.join(frequent, "_ld_hash").where("_ld_doc != _ld_last")
        .groupBy("_ld_doc", "_ld_print").agg(F.array_sort(F.collect_set("_ld_at")).alias("_ld_dropped"))
    )
    place = [column.alias(name) for column, name in zip(identity, ("_ld_a", "_ld_b"))]
    met = docs.select("*", *place).join(
        dropped, (F.col("_ld_a") == F.col("_ld_doc")) & (F.col("_ld_b") == F.col("_ld_print")), "left"
    )
    lines, none = F.split("_ld_text", "\n"), F.expr("cast(array() as array<int>)")
    met = met.withColumns({"_ld_lines": lines, "_ld_dropped": F.coalesce("_ld_dropped", none)})
    done = with_columns(met, {
        "text": F.when(F.size("_ld_dropped") == 0, F.col("_ld_text")).otherwise(
            kept_lines(F.col("_ld_lines"), F.col("_ld_dropped"))
        ),
        "n_lines": F.size("_ld_lines").cast("long"),
        "n_dropped": F.size("_ld_dropped").cast("long"),
    })
    return done.drop(*[c for c in done.columns if c.startswith("_ld_")])
