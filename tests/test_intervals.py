from __future__ import annotations

import datetime
import random

import pytest
from conftest import values
from pyspark.sql import functions as F

from polyad.operators import intervals, joins


def inside(t, a, b):
    return t is not None and (a is None or a <= t) and (b is None or t <= b)


def expected(points, spans):
    return sorted((i, w) for i, u, t in points for v, w, a, b in spans if u is not None and u == v and inside(t, a, b) and (a is None or b is None or a <= b))


def case(kind, seed=5):
    rng = random.Random(seed)
    day, moment = datetime.date(2000, 1, 1), datetime.datetime(2000, 1, 1)
    make = {
        "int": lambda x: int(x),
        "double": lambda x: x / 7,
        "date": lambda x: day + datetime.timedelta(days=int(x)),
        "timestamp_ntz": lambda x: moment + datetime.timedelta(microseconds=int(x * 997_001)),
        "timestamp": lambda x: moment + datetime.timedelta(microseconds=int(x * 997_001)),
    }[kind]
    points = [(i, rng.choice([1, 2, 3, 9, None]), None if i % 17 == 0 else make(rng.uniform(-3000, 3000))) for i in range(300)]
    spans = []
    for w in range(120):
        a = rng.uniform(-3000, 3000)
        b = a + rng.choice([0, 1, 15, 16, 17, 255, 256, 4000, -5]) * rng.choice([1, 0.5])
        spans.append((rng.choice([1, 2, 3, None]), w, None if w % 13 == 0 else make(a), None if w % 11 == 0 else make(b)))
    points += [(1000 + w, u, t) for w, (u, _, a, b) in enumerate(spans) for t in (a, b)]  # both ends belong to an interval
    return points, spans


@pytest.mark.parametrize("kind", ["int", "double", "date", "timestamp_ntz", "timestamp"])
def test_matches_a_comparison_of_all(make, kind):
    points, spans = case(kind)
    left = make(f"i int, `u.k` int, `t.x` {kind}", points)
    right = make(f"`u.k` int, w int, `from.a` {kind}, `to.b` {kind}", spans)
    want = expected(points, spans)
    found = intervals.interval_join(left, right, ["u.k"], "t.x", "from.a", "to.b")
    assert found.columns == ["i", "u.k", "t.x", "w", "from.a", "to.b"]
    assert values(found, "i", "w") == want
    outer = intervals.interval_join(left, right, ["u.k"], "t.x", "from.a", "to.b", "left")
    lone = [i for i, u, t in points if not any(u is not None and u == v and inside(t, a, b) and (a is None or b is None or a <= b) for v, _, a, b in spans)]
    assert values(outer, "i", "w") == sorted(want + [(i, None) for i in lone], key=lambda r: [(x is not None, x) for x in r])
    flags = intervals.covered(left, right, ["u.k"], "t.x", "from.a", "to.b")
    assert flags.columns == ["i", "u.k", "t.x", "member"]
    assert values(flags, "i", "member") == sorted((i, int(i not in lone or any(i == j for j, _ in want))) for i, _, _ in points) or kind


def test_flags_never_multiply_rows(make):
    points = make("i int, u int, t int", [(1, 1, 5), (1, 1, 5), (2, None, 5), (3, 1, None), (4, 2, 5)])
    spans = make("u int, a int, b int", [(1, 0, 9), (1, 4, 6), (1, 5, None), (None, 0, 9), (2, 9, 0)])
    assert values(intervals.covered(points, spans, ["u"], "t", "a", "b"), "i", "member") == [(1, 1), (1, 1), (2, 0), (3, 0), (4, 0)]


def test_no_intervals(make):
    points = make("i int, u int, t int", [(1, 1, 5)])
    none = make("u int, a int, b int", [])
    assert values(intervals.covered(points, none, ["u"], "t", "a", "b"), "member") == [(0,)]
    assert intervals.interval_join(points, none, ["u"], "t", "a", "b").count() == 0
    assert values(intervals.interval_join(points, none, ["u"], "t", "a", "b", "left"), "i", "a") == [(1, None)]


def test_long_intervals_have_few_cells(make):
    spans = make("u int, a long, b long", [(1, 0, 1), (1, 5, 10**12), (1, -(10**15), 10**15), (1, 0, 2**62), (1, 3, 3)])
    laddered = intervals.on_ladder(spans, "a", "b")
    assert laddered.count() <= 10
    assert len(intervals.rungs_in_use(laddered)) == 5


@pytest.mark.parametrize("how", ["inner", "left"])
def test_plans_have_an_equality_and_no_unrolling(spark, how):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        points = spark.range(1000).select("id", (F.col("id") % 7).alias("u"), F.timestamp_seconds("id").alias("t"))
        spans = spark.range(50).select((F.col("id") % 7).alias("u"), F.timestamp_seconds(F.col("id") * 9).alias("a"), F.timestamp_seconds(F.col("id") * 400).alias("b"))
        text = intervals.interval_join(points, spans, ["u"], "t", "a", "b", how)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "NestedLoop" not in text and "Cartesian" not in text and "sequence(" not in text and "Python" not in text
    assert "SortMergeJoin" in text


def test_membership_does_not_read_the_panel_twice(spark, make):
    panel = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").select(F.col("o_custkey").alias("u"), F.year("o_orderdate").alias("year"))
    roster = make("u long, start_year int, end_year int", [(1, 1995, 9999), (2, 1993, 1994)])
    text = joins.interval_member(panel, roster, "u", "year")._jdf.queryExecution().executedPlan().toString()
    assert text.count("Scan parquet") == 1 and "Subquery" not in text
