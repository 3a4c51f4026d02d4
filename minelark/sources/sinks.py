"""Text sinks: one line per row, one file per partition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_value_lines(df: DataFrame, key: Column, value: Column) -> DataFrame:
    """Lines ``Key : k , Value : v``."""
    return df.select(
        F.concat(F.lit("Key : "), key.cast("string"), F.lit(" , Value : "), value.cast("string")).alias("value")
    )


def pair_lines(measured: DataFrame) -> DataFrame:
    """Key/value lines of ``i, j, jaccard`` rows."""
    key = F.format_string("(%d, %d)", "i", "j")
    return key_value_lines(measured, key, F.format_string("%.6f", "jaccard"))


def write_lines(lines: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write the ``value`` column as text files."""
    lines.select("value").write.mode(mode).text(path)


def write_table(df: DataFrame, path: str, sep: str = ",", mode: str = "errorifexists") -> None:
    """Write a delimited text table with a header; nulls are empty fields, quotes are doubled."""
    df.write.mode(mode).csv(path, header=True, sep=sep, escape='"')
