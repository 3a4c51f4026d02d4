"""Every registered query against its SQL at the smallest scale."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"
CHECKS = {name: sql for name, sql in entry.oracle_sql().items() if name not in entry.TEXT_QUERIES}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are absent")


def test_names_match():
    assert set(entry.queries()) - set(entry.TEXT_QUERIES) == set(CHECKS)


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query(spark, name):
    duck = duckdb.connect()
    for file in os.listdir(SF_DIR):
        duck.execute(f"CREATE VIEW {file[:-8]} AS SELECT * FROM '{SF_DIR}/{file}'")
    want = duck.execute(CHECKS[name]).df()
    got = entry.queries()[name](spark, SF_DIR).toPandas()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    a, b = (df[columns].sort_values(columns).reset_index(drop=True) for df in (got, want))
    pd.testing.assert_frame_equal(a, b, check_dtype=False)


def test_entry(spark):
    assert entry.entry(spark).columns == ["user", "rank", "suggested", "score"]
