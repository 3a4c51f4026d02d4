"""Rules on the quality of a text, with thresholds that follow each language and source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from minelark.llm.texts import WHITE, let, whole, with_columns, words
from minelark.plans.lineage import settle

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
SKETCH_BITS = 6
MARGIN = 2
MIN_DOCUMENTS = 100
# Per measure the outer quantiles, in per cent, from which its low fence (if it has one) and its high fence are taken.
MEASURES = {"symbols": (None, 90), "shouts": (None, 90), "dup_lines": (None, 98), "word_length": (10, 90)}
GROUP = ("lang", "source")


def covered_words(found: Column) -> Column:
    """How many words stand in a window whose hash occurs twice or more; ``found`` has one hash per window."""

    def starts(windows: Column) -> Column:
        last = F.size(windows) - 1
        twin = F.filter(
            windows,
            lambda x, j: ((j > 0) & (x.h == F.get(windows, j - 1).h)) | ((j < last) & (x.h == F.get(windows, j + 1).h)),
        )
        return F.sort_array(F.transform(twin, lambda x: x.p))

    def cover(at: Column) -> Column:
        steps = F.transform(at, lambda p, j: F.when(j > 0, F.least(F.lit(WINDOW), p - F.get(at, j - 1))).otherwise(WINDOW))
        return F.aggregate(steps, F.lit(0), lambda total, step: total + step)

    windows = F.array_sort(F.transform(found, lambda h, p: F.struct(h.alias("h"), p.alias("p"))))
    some = F.size(F.array_distinct(found)) < F.size(found)
    return F.when(some, let(let(windows, starts), cover)).otherwise(0)


def window_hashes(found: Column) -> Column:
    """The hash of each window of words; no window where the text has fewer words."""

    def windows(h: Column) -> Column:
        at = F.when(F.size(h) >= WINDOW, F.sequence(F.lit(0), F.size(h) - WINDOW)).otherwise(F.array().cast("array<int>"))
        return F.transform(at, lambda p: F.xxhash64(*[F.get(h, p + k) for k in range(WINDOW)]))

    return let(F.transform(found, lambda word: F.xxhash64(word)), windows)


def with_counts(docs: DataFrame) -> DataFrame:
    """Add the counts that need no windows, as ``_qr_*`` columns."""
    text = F.col("_qr_text")
    docs = docs.withColumn("_qr_text", whole(F.col("text"))).withColumn("_qr_words", words(text))
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(WHITE)) != "")
    return docs.withColumns({
        "_qr_lines": lines,
        "_qr_n_words": F.size("_qr_words").cast("long"),
        "_qr_word_chars": F.char_length(F.array_join("_qr_words", "")).cast("long"),
        "_qr_n_symbols": F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long"),
        "_qr_n_shouts": F.regexp_count(text, F.lit("[!?]")).cast("long"),
    }).withColumns({
        "_qr_n_lines": F.size("_qr_lines").cast("long"),
        "_qr_n_dup_lines": (F.size("_qr_lines") - F.size(F.array_distinct("_qr_lines"))).cast("long"),
    })


def measures(less: int = 0) -> dict[str, Column]:
    """What the adaptive rules look at, in whole numbers: parts per 1,000, and hundredths of a character.

    ``less`` is taken off each count first.
    """
    per = {
        "symbols": (1000, "_qr_n_symbols", "_qr_n_words"),
        "shouts": (1000, "_qr_n_shouts", "_qr_n_words"),
        "dup_lines": (1000, "_qr_n_dup_lines", "_qr_n_lines"),
        "word_length": (100, "_qr_word_chars", "_qr_n_words"),
    }
    return {
        name: F.expr(f"({scale} * greatest({part} - {less}, 0L)) div greatest({whole_}, 1L)")
        for name, (scale, part, whole_) in per.items()
    }


def step(value: str) -> Column:
    """How many whole numbers the bucket of a value holds."""
    return F.pow(F.lit(2), F.greatest(F.length(F.bin(value)) - SKETCH_BITS, F.lit(0))).cast("long")


def sketch(rows: DataFrame, value: str) -> DataFrame:
    """Per language, source and measure a quantile sketch: counts ``n`` of log-linear buckets.

    A bucket keeps the ``SKETCH_BITS`` leading bits of a value: its values differ by at most 1/32. Sketches merge
    by adding counts, in any order and with the same outcome, which the partial aggregate does before the shuffle.
    """
    bucket = (F.col(value) - F.col(value) % step(value)).alias("bucket")
    return rows.select(*GROUP, "measure", bucket).groupBy(*GROUP, "measure", "bucket").agg(F.count(F.lit(1)).alias("n"))


def quantiles(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """Of each merged sketch the number ``n`` of its values, its median ``mid`` and its outer quantiles ``low`` and ``high``.

    A quantile is the least value of its bucket, ``high`` the greatest one.
    """
    merged = sketches.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*keys, "measure")
    below = F.sum("n").over(group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = merged.select(*keys, "measure", "bucket", below.alias("below"), F.sum("n").over(group).alias("total"))
    reached = 100 * F.col("below")

    def quantile(per_cent: Column | int, value: Column) -> Column:
        return F.min(F.when(reached >= per_cent * F.col("total"), value))

    low, high = ([F.when(F.col("measure") == m, outer[k]) for m, outer in MEASURES.items()] for k in (0, 1))
    bucket = F.col("bucket")
    return ranked.groupBy(*keys, "measure").agg(
        F.first("total").alias("n"), quantile(50, bucket).alias("mid"),
        quantile(F.coalesce(*low), bucket).alias("low"), quantile(F.coalesce(*high), bucket + step("bucket") - 1).alias("high"),
    )


def thresholds(docs: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """Per language and source the bounds ``<measure>_low`` and ``<measure>_high`` of every measure.

    A group of fewer than ``min_documents`` takes the bounds of its language, such a language those of all documents:
    its sketches are merged further. ``docs`` has the columns of :func:`with_counts`.
    """
    columns = [F.struct(F.lit(name).alias("measure"), column.alias("value")) for name, column in measures().items()]
    rows = docs.select(*GROUP, F.inline(F.array(*columns)))
    sketches = settle(sketch(rows, "value"))
    levels = [quantiles(sketches, list(GROUP[:k])) for k in (2, 1, 0)]
    found = levels[0]
    for k, level in enumerate(levels[1:]):
        names = {c: f"{c}_{k}" for c in level.columns}
        level = level.withColumnsRenamed(names)
        same = F.col("measure") == F.col(f"measure_{k}")
        if k == 0:
            same &= F.col("lang").eqNullSafe(F.col("lang_0"))
        enough = F.col("n") >= min_documents
        found = found.join(level, same).select(
            *GROUP, "measure", *[F.when(enough, F.col(c)).otherwise(F.col(f"{c}_{k}")).alias(c) for c in ("n", "mid", "low", "high")]
        )
    mid, low, high = (F.col(c) for c in ("mid", "low", "high"))
    found = found.select(*GROUP, "measure", (low - MARGIN * (mid - low)).alias("low"), (high + MARGIN * (high - mid)).alias("high"))
    bounds = [
        F.max(F.when(F.col("measure") == name, F.col(side))).alias(f"_qr_{name}_{side}")
        for name in MEASURES for side in ("low", "high")
    ]
    return found.groupBy(*GROUP).agg(*bounds)


def quality(docs: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """Count what the rules look at, and judge each document.

    Returns the columns of ``docs`` and ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    kept``, which replace columns of these names. ``base_failed``: fewer than 10 words, or more than 20 % of the words
    in repeated windows of five. Other documents are kept unless a measure (symbols, exclamation and question marks,
    repeated lines, word length) lies beyond its fences. A fence lies beyond an outer quantile of the language and source
    (``MEASURES``) by ``MARGIN`` times the distance between that quantile and the median, so it moves with both. The only
    floor is that of rounding: a quantile is as exact as its bucket, and a document is past a high fence only if it still
    is with one occurrence less, so a single symbol or repeated line in a short text decides nothing.

    Null text: no words, so it fails. Null ``lang`` or ``source``: a group like any other. Repeated rows: each is
    judged and counts. Very long texts are read whole. No rows: no groups, and no rows. Names starting with ``_qr_`` are reserved.

    Two passes over the texts: one for the sketches, whose size is that of the groups, one for the verdicts. No text
    is shuffled; the bounds are joined to the documents where they are, broadcast if the stored table is small.
    """
    counted = with_counts(docs)
    bounds = settle(thresholds(counted, min_documents)).withColumnsRenamed({"lang": "_qr_lang", "source": "_qr_source"})
    joined = counted.join(
        bounds, F.col("lang").eqNullSafe(F.col("_qr_lang")) & F.col("source").eqNullSafe(F.col("_qr_source")), "left"
    )
    joined = joined.withColumn("_qr_hashes", window_hashes(F.col("_qr_words")))
    joined = joined.withColumn("_qr_repeats", covered_words(F.col("_qr_hashes")).cast("long"))
    failed = (F.col("_qr_n_words") < MIN_WORDS) | (100 * F.col("_qr_repeats") > MAX_REPEAT_PERCENT * F.col("_qr_n_words"))
    inside = F.lit(True)
    for name, (low, _) in MEASURES.items():
        inside &= measures(less=1)[name] <= F.col(f"_qr_{name}_high")
        if low is not None:
            inside &= measures()[name] >= F.col(f"_qr_{name}_low")
    done = with_columns(joined, {
        "n_words": F.col("_qr_n_words"),
        "word_chars": F.col("_qr_word_chars"),
        "n_symbols": F.col("_qr_n_symbols"),
        "n_dup_lines": F.col("_qr_n_dup_lines"),
        "n_repeat_words": F.col("_qr_repeats"),
        "base_failed": failed,
        "kept": ~failed & inside,
    })
    return done.drop(*[c for c in done.columns if c.startswith("_qr_")])
