import datetime
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Observation

from minelark.sources import readers as R
from minelark.sources.sinks import write_table


def written(folder, name, text):
    path = folder / name
    path.write_text(text)
    return str(path)


def brute_type(values):
    """The narrowest type that holds all texts, by plain Python."""
    values = [v.strip(" ") for v in values if v is not None]

    def whole(v):
        return re.fullmatch(r"[+-]?[0-9]+", v)

    def date(v):
        try:
            return bool(re.fullmatch(r"[0-9]{4}-[0-9]{2}-[0-9]{2}", v)) and datetime.date.fromisoformat(v) is not None
        except ValueError:
            return False

    checks = {
        "bigint": lambda v: whole(v) and -(2**63) <= int(v) < 2**63,
        "double": lambda v: abs(int(v)) <= 2**53 if whole(v) else re.fullmatch(r"[+-]?([0-9]+\.[0-9]*|\.?[0-9]+)([eE][+-]?[0-9]+)?|[+-]?(NaN|Infinity)", v),
        "date": date,
        "boolean": lambda v: v.lower() in ("true", "false"),
    }
    return next((k for k, fits in checks.items() if values and all(fits(v) for v in values)), "string")


VALUES = [
    None, "0", "007", "-12", "+3", " 8 ", str(2**63 - 1), str(2**63), str(2**53), str(2**53 + 1), "1.5", ".5", "5.", "1e3", "1E", "-2.5e-3", "NaN", "1d",
    "2024-02-29", "2023-02-29", "2024-2-9", "true", "False", "yes", "", "x",
]


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from(VALUES), min_size=3, max_size=3), max_size=5))
def test_inferred_types_against_brute_force(spark, cells):
    table = spark.createDataFrame([tuple(row) for row in cells], "a string, `b.c` string, d string").repartition(3)
    found = R.infer_types(table)
    assert found == {name: brute_type([row[k] for row in cells]) for k, name in enumerate(("a", "b.c", "d"))}


@pytest.mark.parametrize("value", VALUES[1:])
def test_each_value_alone(spark, value):
    assert R.infer_types(spark.createDataFrame([(value,)], "a string")) == {"a": brute_type([value])}


def test_one_odd_row_among_many_decides(spark):
    rows = spark.range(20_000).selectExpr("cast(id as string) a", "cast(id as string) b", "if(id = 19999, '1.5', cast(id as string)) c")
    odd = rows.selectExpr("a", "if(a = '12345', 'n/a', b) b", "c")
    assert R.infer_types(odd) == {"a": "bigint", "b": "string", "c": "double"}


def test_inferred_table(spark, rows, tmp_path):
    path = written(tmp_path, "t.csv", 'id;at;ok;x;x;none;name\n1;2024-01-05;true;1;2.5;;"a;""b"""\n2;2024-01-06;FALSE;;3;;c\n')
    table = R.read_table(spark, path, ";", types="infer")
    assert dict(table.dtypes) == {
        "id": "bigint", "at": "date", "ok": "boolean", "x": "bigint", "x.1": "double", "none": "string", "name": "string",
    }
    day = datetime.date
    assert rows(table) == [(1, day(2024, 1, 5), True, 1, 2.5, None, 'a;"b"'), (2, day(2024, 1, 6), False, None, 3.0, None, "c")]


def test_inferred_table_without_rows(spark, tmp_path):
    table = R.read_table(spark, written(tmp_path, "t.csv", "a,b\n"), types="infer")
    assert dict(table.dtypes) == {"a": "string", "b": "string"} and table.isEmpty()


def test_inference_is_one_pass_of_partial_aggregates(spark, capsys):
    table = spark.createDataFrame([("1", "x")], "a string, b string")
    table.agg(*[R.F.bit_and(R._fitting(R.F.col(c))) for c in table.columns]).explain()
    plan = capsys.readouterr().out
    assert "partial_bit_and" in plan and plan.count("Exchange") == 1


def test_round_trip(spark, rows, tmp_path):
    data = [(1, 'a "quoted", name', 0.25, None), (2, "back\\slash", -1e300, True), (3, None, None, False)]
    table = spark.createDataFrame(data, "k long, name string, x double, flag boolean")
    write_table(table, str(tmp_path / "t"), sep="|")
    assert rows(R.read_table(spark, str(tmp_path / "t"), "|", types="infer")) == rows(table)


def counts(read):
    """The rejects of a reader, after the one action that reads its rows."""
    rejects = Observation()
    found = read(rejects).collect()
    return found, rejects.get


def test_rejected_adjacency(spark, tmp_path):
    path = written(tmp_path, "a.txt", "1\t2,3\nx\t4\n\n5\t6,y,z\n7\n")
    found, rejects = counts(lambda r: R.read_adjacency(spark, path, r))
    assert len(found) == 3 and rejects == {"dropped_lines": 1, "unparsed_friends": 2}


def test_rejected_documents(spark, tmp_path):
    path = written(tmp_path, "d.txt", "1\ttext\nno id\ttext\n3\n4\tmore\n")
    found, rejects = counts(lambda r: R.read_documents(spark, path, r))
    assert sorted(r.doc_id for r in found) == [1, 4] and rejects == {"dropped_lines": 2}


def test_rejected_values(spark, tmp_path):
    path = written(tmp_path, "c.csv", "START,STOP,PATIENT,ENCOUNTER,CODE,DESCRIPTION\na,,p,e,10509002000119,d\na,,p,e,1x,d\na,,p,e,,d\n")
    found, rejects = counts(lambda r: R.read_conditions(spark, path, r))
    assert {r.CODE for r in found} == {10509002000119, None} and rejects == {"unparsed_values": 1}
    path = written(tmp_path, "r.csv", "userId,movieId,rating,timestamp\n1,2,3.5,x\n1,b,c,x\n,,,\n")
    found, rejects = counts(lambda r: R.read_ratings(spark, path, r))
    assert len(found) == 3 and rejects == {"unparsed_values": 2}
    path = written(tmp_path, "m.csv", 'movieId,title,genres\n1,"a, ""b""",g\nq,t,g\n')
    found, rejects = counts(lambda r: R.read_movies(spark, path, r))
    assert {(r.item_id, r.title) for r in found} == {(1, 'a, "b"'), (None, "t")} and rejects == {"unparsed_values": 1}
    found, rejects = counts(lambda r: R.read_table(spark, path, types={"movieId": "bigint", "genres": "double"}, rejects=r))
    assert rejects == {"unparsed_values": 3}


def test_rejected_features_and_tracks(spark, tmp_path):
    path = written(tmp_path, "f.csv", "feature,a,a\nstatistics,mean,mean\nnumber,01,02\ntrack_id,,\n2,1.5,x\n3,,4\n")
    found, rejects = counts(lambda r: R.read_features(spark, path, rejects=r))
    assert sorted((r["feature"], r["a"], r["a.1"]) for r in found) == [(2, 1.5, None), (3, None, 4.0)]
    assert rejects == {"dropped_rows": 3, "unparsed_values": 1}
    path = written(tmp_path, "t.csv", "track_id,set,set\n1,training,small\nnone,x,y\n")
    found, rejects = counts(lambda r: R.read_tracks(spark, path, rejects=r))
    assert [(r["track_id"], r["set.1"]) for r in found] == [(1, "small")] and rejects["dropped_rows"] == 1


def test_counts_need_no_second_scan(spark, tmp_path, capsys):
    path = written(tmp_path, "a.txt", "1\t2\nx\t3\n")
    R.read_adjacency(spark, path, Observation()).explain()
    plan = capsys.readouterr().out
    assert plan.count("FileScan") == 1 and "CollectMetrics" in plan
