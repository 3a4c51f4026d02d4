"""Pairing must give the same answer whatever counts as a hot key."""

import random
from collections import Counter

import pytest

from minelark.plans import pair_cells
from minelark.plans.skew import cells, member_pairs, pair_totals


def skewed(seed, hot_share=0.4, n=400):
    """(key, member, weight) with one key holding a large share of all rows."""
    rng = random.Random(seed)
    cells = {(0, m) for m in range(int(n * hot_share))}
    while len(cells) < n:
        cells.add((rng.randrange(1, 40), rng.randrange(200)))
    return [(k, m, float((k * 7 + m) % 5)) for k, m in sorted(cells)]


def brute(cells):
    n, dot = Counter(), Counter()
    for k, a, wa in cells:
        for k2, b, wb in cells:
            if k == k2 and a < b:
                n[a, b] += 1
                dot[a, b] += wa * wb
    return {p: (n[p], dot[p]) for p in n}


@pytest.mark.parametrize("hot_rows,block_rows", [(1000, 64), (50, 32), (3, 7)])
def test_pair_totals(spark, hot_rows, block_rows):
    cells = skewed(hot_rows)
    df = spark.createDataFrame(cells, "k long, m long, w double")
    got = pair_totals(df, ["k"], "m", "w", hot_rows=hot_rows, block_rows=block_rows)
    assert {(r.a, r.b): (r.n, r.dot) for r in got.collect()} == brute(cells)


@pytest.mark.parametrize("hot_rows", [1000, 20])
def test_member_pairs(spark, hot_rows):
    cells = skewed(7)
    df = spark.createDataFrame(cells, "k long, m long, w double")
    got = [tuple(r) for r in member_pairs(df, ["k"], "m", hot_rows=hot_rows, block_rows=16).collect()]
    want = [(k, a, b) for k, a, _ in cells for k2, b, _ in cells if k == k2 and a < b]
    assert sorted(got) == sorted(want)


def test_compound_key_kept_in_the_result(spark):
    cells = [(b, p, m) for b in range(3) for p in range(2) for m in range(12) if (b + p + m) % 3]
    df = spark.createDataFrame(cells, "b long, p string, m string")
    for hot_rows in (100, 4):
        got = pair_totals(df, ["b", "p"], "m", by=["p"], hot_rows=hot_rows, block_rows=5).collect()
        want = Counter(
            (str(p), min(str(x), str(y)), max(str(x), str(y)))
            for b, p, x in cells for b2, p2, y in cells if (b, p) == (b2, p2) and str(x) < str(y)
        )
        assert {(r.p, r.a, r.b): r.n for r in got} == dict(want)


def test_null_weights(spark):
    """A product with a null weight counts as a common key, but adds nothing."""
    rows = [(k, m, None if (k + m) % 4 == 0 or m == 3 else float(k + m)) for k in range(3) for m in range(9)]
    df = spark.createDataFrame(rows, "k long, m long, w double")
    got = [
        {(r.a, r.b): (r.n, r.dot) for r in pair_totals(df, ["k"], "m", "w", hot_rows=h, block_rows=4).collect()}
        for h in (2, 1000)
    ]
    assert got[0] == got[1] and got[0][3, 5] == (3, None) and got[0][1, 2] == (3, 14.0 * 0 + 2.0 + 6.0)


def test_copies_follow_the_size_of_the_own_group(spark):
    """Rows of a group of 200 go to 10 cells each, rows of small groups to one, however many large groups there are."""
    rows = [(k, m) for k in range(5) for m in range(200)] + [(k, m) for k in range(5, 50) for m in range(10)]
    spread = cells(spark.createDataFrame(rows, "k long, _m long"), ["k"], hot_rows=100, block_rows=20)
    copies = Counter((r.k, r["_m"]) for r in spread.collect())
    assert {copies[k, m] for k, m in rows if k < 5} == {10} and {copies[k, m] for k, m in rows if k >= 5} == {1}


@pytest.mark.parametrize("block_rows", [40, 100_000])
def test_cells_count_pairs_without_shuffling_them(spark, monkeypatch, block_rows):
    """Cells give final counts: no pair is shuffled, in however many blocks the members are; large blocks are cut by key."""
    monkeypatch.setattr(pair_cells, "BLOCK_ROWS", block_rows)
    monkeypatch.setattr(pair_cells, "LEAST_ROWS", 50)
    monkeypatch.setattr(pair_cells, "CHUNK_PAIRS", 70)
    cells = skewed(3) + [(k, 7, 2.0) for k in range(100, 350)]  # one member with very many keys
    df = spark.createDataFrame([(*c, float(c[1] * 3) if c[1] % 5 else None) for c in cells], "k long, m long, w double, t double")
    got = pair_totals(df, ["k"], "m", "w", of_member=["t"])
    want = brute(cells)
    assert {(r.a, r.b): (r.n, r.dot) for r in got.collect()} == want
    assert all((r.a_t, r.b_t) == tuple(float(m * 3) if m % 5 else None for m in (r.a, r.b)) for r in got.collect())
    barred = sorted(want)[::3]
    without = spark.createDataFrame([p if at % 2 else p for at, p in enumerate(barred)] + [(5000, 5001)], "a long, b long")
    left = pair_totals(df, ["k"], "m", without=without)
    assert {(r.a, r.b): r.n for r in left.collect()} == {p: n for p, (n, _) in want.items() if p not in set(barred)}
    plan = pair_totals(df, ["k"], "m")._jdf.queryExecution().executedPlan().toString()
    if block_rows == 100_000:
        assert "SortMergeJoin" not in plan and "HashAggregate" not in plan


@pytest.mark.parametrize("mounted", [True, False])
def test_blocks_are_read_where_they_are_stored(spark, monkeypatch, mounted):
    """However many blocks there are, cells shuffle nothing: what is shuffled grows with the rows, not with rows times blocks."""
    monkeypatch.setattr(pair_cells, "opened_by_tasks", lambda path: mounted)
    monkeypatch.setattr(pair_cells, "BLOCK_ROWS", 300)
    monkeypatch.setattr(pair_cells, "LEAST_ROWS", 50)
    cells = [(k, m, float(m)) for k in range(60) for m in range(k % 7, 150, 9)]
    df = spark.createDataFrame(cells, "k long, m long, w double")
    best = pair_cells.totals(df, ["k"], "m", best=4)
    for found in (pair_totals(df, ["k"], "m", "w"), best):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert ("Range" if mounted else "CartesianProduct") in plan and "Exchange" not in plan
    ends = {}
    for (a, b), (n, _) in brute(cells).items():
        ends.setdefault(a, []).append((-n, b))
        ends.setdefault(b, []).append((-n, a))
    got = {}
    for r in best.collect():
        got.setdefault(r.a, []).append((-r.n, r.b))
    assert {a: sorted(v)[:4] for a, v in got.items()} == {a: sorted(v)[:4] for a, v in ends.items()}
