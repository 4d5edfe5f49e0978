from __future__ import annotations

from conftest import values

from polyad.operators import observed


def test_dropped_rows_are_reported_by_the_run(make):
    df = make("k int, `x.y` double, s string", [(1, 1.0, "a"), (2, None, "b"), (3, None, None), (None, 4.0, "d")])
    complete, seen = observed.drop_missing(df, ["x.y", "s"])
    assert values(complete, "k") == [(None,), (1,)]
    assert seen.get == {"n_rows": 4, "n_dropped": 2, "missing_x.y": 2, "missing_s": 1}


def test_join_reports_its_coverage(make):
    left, right = make("k int, a int", [(1, 1), (1, 2), (2, 3), (None, 4)]), make("k int, b int", [(1, 7), (3, 8)])
    joined, seen = observed.observed_join(left, right, ["k"])
    assert values(joined) == [(None, 4, None), (1, 1, 7), (1, 2, 7), (2, 3, None)]
    assert seen.get == {"n_rows": 4, "n_matched": 2}


def test_both_sides(make):
    df, seen = observed.observed_coverage(make("`a.a` int, b int", [(1, None), (1, 2), (None, None)]), "a.a", "b")
    assert df.count() == 3
    assert seen.get == {"total": 3, "matched_a": 2, "matched_b": 1, "matched_both": 1}


def test_no_second_scan(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    complete, _ = observed.drop_missing(orders, ["o_custkey"])
    text = complete._jdf.queryExecution().executedPlan().toString()
    assert text.count("Scan parquet") == 1 and "CollectMetrics" in text


def test_empty_table(make):
    complete, seen = observed.drop_missing(make("k int", []), ["k"])
    assert complete.count() == 0 and seen.get == {"n_rows": 0, "n_dropped": 0, "missing_k": 0}
