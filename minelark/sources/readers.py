"""File readers. Schemas are fixed or found from all rows; malformed numbers become null.

Readers take ``rejects``, an :class:`pyspark.sql.Observation`: the action that reads the result also counts there what
was dropped or did not parse, in the same scan.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from minelark.operators.clusters import numeric
from minelark.operators.links import parse_adjacency
from minelark.operators.neardup import parse_documents
from minelark.plans.watch import unparsed, watched

# Column names of the conditions file: fixed values.
CONDITIONS = T.StructType(
    [
        T.StructField("START", T.StringType()),
        T.StructField("STOP", T.StringType()),
        T.StructField("PATIENT", T.StringType()),
        T.StructField("ENCOUNTER", T.StringType()),
        T.StructField("CODE", T.LongType()),
        T.StructField("DESCRIPTION", T.StringType()),
    ]
)


# Types that a column of text can have, the narrowest first; text itself holds anything.
TYPES = ("bigint", "double", "date", "boolean")
EXACT_DOUBLE = 2**53


def _fitting(text: Column) -> Column:
    """One bit for each of :data:`TYPES` that holds this value without loss; all of them for a null."""
    bits = {kind: 1 << k for k, kind in enumerate(TYPES)}
    value = F.trim(text)
    whole = value.rlike(r"^[+-]?[0-9]+$")
    number = value.rlike(r"^[+-]?([0-9]+\.[0-9]*|\.?[0-9]+)([eE][+-]?[0-9]+)?$|^[+-]?(NaN|Infinity)$")
    as_whole = value.try_cast("bigint")
    exact = F.when(as_whole.between(-EXACT_DOUBLE, EXACT_DOUBLE), bits["bigint"] | bits["double"]).when(as_whole.isNotNull(), bits["bigint"])
    # no value but a whole number fits two types, so the first test that holds ends the search
    return (
        F.when(value.isNull(), F.lit((1 << len(TYPES)) - 1))
        .when(whole, exact.otherwise(0))
        .when(number & value.try_cast("double").isNotNull(), bits["double"])
        .when(value.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & value.try_cast("date").isNotNull(), bits["date"])
        .when(F.lower(value).isin("true", "false"), bits["boolean"])
        .otherwise(0)
    )


def infer_types(table: DataFrame) -> dict[str, str]:
    """The narrowest type of each text column that holds every value of it: bigint, double, date, boolean or string.

    Types form a lattice: a value has a bit for each type that holds it, and columns merge by ``bit_and``, so this is one
    partial aggregate over all rows, whose result is a number per column. A whole number beyond 2**53 is no double, so
    mixed with fractions it stays text. Columns without any value stay text as well.
    """
    names = table.columns
    columns = [F.col(f"`{name}`") for name in names]
    if not names:
        return {}
    merged = [F.bit_and(_fitting(c)).alias(f"m{k}") for k, c in enumerate(columns)]
    present = [F.count(c).alias(f"n{k}") for k, c in enumerate(columns)]
    found = table.agg(*merged, *present).first()
    types = {}
    for k, name in enumerate(names):
        bits = found[f"m{k}"] if found[f"n{k}"] else 0
        types[name] = next((kind for at, kind in enumerate(TYPES) if bits >> at & 1), "string")
    return types


def read_adjacency(spark: SparkSession, path: str, rejects: Observation | None = None) -> DataFrame:
    """``user, friends`` from text files of adjacency lists. Rejects: ``dropped_lines``, ``unparsed_friends``."""
    return parse_adjacency(spark.read.text(path), rejects)


def read_documents(spark: SparkSession, path: str, rejects: Observation | None = None) -> DataFrame:
    """``doc_id, text`` (cleaned) from tab-separated text files. Rejects: ``dropped_lines``."""
    return parse_documents(spark.read.text(path), rejects)


def read_conditions(spark: SparkSession, path: str, rejects: Observation | None = None) -> DataFrame:
    """The conditions table. Codes are bigint: some do not fit 32 bits. Rejects: ``unparsed_values``."""
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in CONDITIONS])
    return typed(spark.read.schema(as_text).csv(path, header=True), {"CODE": "bigint"}, rejects)


def typed(table: DataFrame, types: dict[str, str], rejects: Observation | None = None) -> DataFrame:
    """Give text columns a type; values that do not fit become null. Rejects: ``unparsed_values``."""
    cast = {name: F.trim(F.col(f"`{name}`")).try_cast(kind) for name, kind in types.items() if kind != "string"}
    watching = watched(table, rejects, unparsed_values=unparsed({name: (F.col(f"`{name}`"), c) for name, c in cast.items()}))
    return watching.withColumns(cast) if cast else watching


def read_table(
    spark: SparkSession, path: str, sep: str = ",", types: dict[str, str] | str | None = None, rejects: Observation | None = None
) -> DataFrame:
    """A CSV with header as strings, quotes doubled; a repeated column name gets ``.1``, ``.2``, ... in order.

    ``types`` gives columns, by these names, a type; values that do not fit become null. ``types="infer"`` finds the type
    of every column from all rows (see :func:`infer_types`), which reads the file once more. Rejects: ``unparsed_values``.
    """
    header = spark.read.csv(path, header=False, sep=sep, escape='"').first()
    seen: Counter[str] = Counter()
    fields = []
    for position, name in enumerate(header):
        name = name if name is not None else f"Unnamed: {position}"
        fields.append(T.StructField(f"{name}.{seen[name]}" if seen[name] else name, T.StringType()))
        seen[name] += 1
    rows = spark.read.schema(T.StructType(fields)).csv(path, header=True, sep=sep, escape='"')
    if types == "infer":
        types = infer_types(rows)
    return typed(rows, types or {}, rejects)


def read_ratings(spark: SparkSession, path: str, rejects: Observation | None = None) -> DataFrame:
    """``user_id, item_id, rating`` from a ratings CSV with userId, movieId and rating. Rejects: ``unparsed_values``."""
    table = read_table(spark, path).select("userId", "movieId", "rating")
    table = typed(table, {"userId": "bigint", "movieId": "bigint", "rating": "double"}, rejects)
    return table.withColumnsRenamed({"userId": "user_id", "movieId": "item_id"})


def read_movies(spark: SparkSession, path: str, rejects: Observation | None = None) -> DataFrame:
    """``item_id, title, genres`` from a movies CSV. Rejects: ``unparsed_values``."""
    table = read_table(spark, path).select("movieId", "title", "genres")
    return typed(table, {"movieId": "bigint"}, rejects).withColumnRenamed("movieId", "item_id")


def read_features(spark: SparkSession, path: str, key: str = "feature", rejects: Observation | None = None) -> DataFrame:
    """Feature table with numeric columns; the extra header rows have no numeric key and go.

    Rejects: ``dropped_rows``, ``unparsed_values`` (of the rows that stay).
    """
    table = read_table(spark, path)
    return numeric(table, [c for c in table.columns if c != key], key, rejects)


def read_tracks(spark: SparkSession, path: str, rejects: Observation | None = None) -> DataFrame:
    """Track table; rows without a numeric track id go. Rejects: ``dropped_rows``."""
    return numeric(read_table(spark, path), [], "track_id", rejects, others=True)
