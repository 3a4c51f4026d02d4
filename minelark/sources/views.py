"""Stand-in inputs over the test tables.

One SQL text per view runs in Spark and in DuckDB alike; ``{name}`` marks a table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("lineitem", "orders", "supplier", "part", "events", "documents", "embeddings")

VIEWS = {
    # parts sold together in one order are friends of each other
    "edges": """
        SELECT DISTINCT a.l_partkey AS src, b.l_partkey AS dst
        FROM {lineitem} a JOIN {lineitem} b ON a.l_orderkey = b.l_orderkey
        WHERE a.l_partkey <> b.l_partkey""",
    # the same as text, one friend a line
    "friend_lines": """
        SELECT concat(CAST(src AS STRING), chr(9), CAST(dst AS STRING)) AS value FROM (
        SELECT DISTINCT a.l_partkey AS src, b.l_partkey AS dst
        FROM {lineitem} a JOIN {lineitem} b ON a.l_orderkey = b.l_orderkey
        WHERE a.l_partkey <> b.l_partkey)""",
    # first line items give a user without friends, the others two friends
    "adjacency_lines": """
        SELECT CASE WHEN l_linenumber = 1 THEN CAST(l_orderkey AS STRING)
                    ELSE concat(CAST(l_orderkey AS STRING), chr(9), CAST(l_partkey AS STRING), ',',
                                CAST(l_suppkey AS STRING)) END AS value
        FROM {lineitem}""",
    "conditions": """
        SELECT CAST(l_shipdate AS STRING) AS START, CAST(NULL AS STRING) AS STOP,
               CAST(o_custkey AS STRING) AS PATIENT, CAST(l_orderkey AS STRING) AS ENCOUNTER,
               l_suppkey AS CODE, s_name AS DESCRIPTION
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {supplier} ON l_suppkey = s_suppkey""",
    # quantities are whole numbers, so sums of products are exact
    "ratings": """
        SELECT o_custkey AS user_id, l_partkey AS item_id, max(l_quantity) AS rating
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
        GROUP BY o_custkey, l_partkey""",
    "user_events": """
        SELECT user_id, event_type AS item_id, max(value) AS rating
        FROM {events} GROUP BY user_id, event_type""",
    # a column of each type, all of them text in a file; codes mix whole numbers with others
    "mixed_types": """
        SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, CAST(l_shipdate AS DATE) AS shipped,
               l_discount > 0.05 AS reduced, l_returnflag,
               CASE WHEN l_linenumber = 1 THEN concat('P', CAST(l_partkey AS STRING)) ELSE CAST(l_partkey AS STRING) END AS code,
               CAST(NULL AS STRING) AS remark
        FROM {lineitem}""",
    "movies": "SELECT p_partkey AS item_id, p_name AS title, p_type AS genres FROM {part}",
    "docs": "SELECT doc_id, text FROM {documents}",
    "document_lines": "SELECT concat(CAST(doc_id AS STRING), chr(9), text) AS value FROM {documents}",
    "vectors": """
        SELECT vec_id AS id, CAST(embedding AS {doubles}) AS features, label AS cluster
        FROM {embeddings}""",
    "tracks": """
        SELECT vec_id AS track_id, CASE WHEN label < 5 THEN 'small' ELSE 'large' END AS "set.1"
        FROM {embeddings}""",
}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view as a DataFrame over the parquet tables in ``sf_dir``."""
    text = VIEWS[name]
    tables = {
        t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if "{" + t + "}" in text
    }
    text = text.replace("{doubles}", "array<double>").replace('"', "`")
    return spark.sql(text, **tables)


def sql(name: str) -> str:
    """The same view as a DuckDB subquery."""
    names = {t: t for t in TABLES} | {"doubles": "DOUBLE[]"}
    return VIEWS[name].format(**names)
