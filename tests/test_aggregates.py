from __future__ import annotations

import math
import random
import statistics

import numpy as np
import pytest
from conftest import values
from pyspark.sql import functions as F

from polyad.operators import aggregates, scaling
from polyad.operators.aggregates import exact_quantiles


def test_quantiles_interpolate(make):
    df = make("g int, x double", [(1, 1.0), (1, 2.0), (1, 3.0), (1, 10.0), (2, None), (3, 4.0)])
    assert values(exact_quantiles(df, ["g"], "x", [0.25, 0.5])) == [(1, 0.25, 1.75), (1, 0.5, 2.5), (3, 0.25, 4.0), (3, 0.5, 4.0)]
    assert values(exact_quantiles(df, [], "x", [0.5])) == [(0.5, 3.0)]


@pytest.mark.parametrize("accuracy", [10_000, 20])
def test_quantiles_of_large_skewed_groups(make, monkeypatch, accuracy):
    """A coarse sketch misses ranks, and those groups are done again."""
    monkeypatch.setattr(aggregates, "SKETCH_ACCURACY", accuracy)
    rng = random.Random(5)
    hot = [(1, round(rng.expovariate(0.3), 3)) for _ in range(30_000)] + [(1, 0.0)] * 9_000
    other = [(2, float(i)) for i in range(1_501)]
    df = make("g int, x double", hot + other)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    found = {(g, p): q for g, p, q in values(exact_quantiles(df, ["g"], "x", probs))}
    for g, rows in ((1, hot), (2, other)):
        expected = np.quantile([x for _, x in rows], probs)
        assert [found[g, p] for p in probs] == pytest.approx(list(expected), abs=1e-9)


def test_null_group_gets_its_median(make):
    df = make("g int, x double", [(None, 1.0), (None, 3.0), (1, 5.0)])
    assert values(scaling.attach_medians(df, ["g"], "x", "m")) == [(None, 1.0, 2.0), (None, 3.0, 2.0), (1, 5.0, 5.0)]


def test_six_number(make):
    df = make("a int, b double", [(1, 0.5), (2, None), (3, None), (10, 1.5)])
    assert values(aggregates.six_number(df, ["a", "b"])) == [
        ("a", 1.0, 1.75, 2.5, 4.0, 4.75, 10.0, 0),
        ("b", 0.5, 0.75, 1.0, 1.0, 1.25, 1.5, 2),
    ]


def test_frequency(make):
    df = make("s string", [("a",), (None,), ("a",)])
    assert values(aggregates.frequency(df, ["s"])) == [(None, 1), ("a", 2)]
    assert values(aggregates.frequency(df, ["s"], include_null=False)) == [("a", 2)]


def test_missing_profile_order_and_text(make):
    df = make("full int, b int, a int, none int", [(1, 1, None, None), (2, None, 2, None)])
    found = [tuple(r) for r in aggregates.missing_profile(df, top=3).collect()]
    assert found == [("none", 100.0, "100%"), ("b", 50.0, "50%"), ("a", 50.0, "50%")]


def test_coverage(make):
    df = make("x int, y int", [(1, None), (None, None), (3, None)])
    assert values(aggregates.coverage(df, ["x", "y", "z"])) == [
        ("x", True, 1, 66.7),
        ("y", True, 3, 0.0),
        ("z", False, None, None),
    ]


def test_correlations_use_complete_rows(make):
    rows = [(1.0, 2.0, 1.0), (2.0, 1.0, 1.0), (3.0, 5.0, 1.0), (4.0, None, 1.0)]
    found = {(a, b): r for a, b, r in values(aggregates.correlation_matrix(make("x double, y double, k double", rows), ["x", "y", "k"]))}
    r = statistics.correlation([1, 2, 3], [2, 1, 5])
    assert found["x", "y"] == pytest.approx(r) == found["y", "x"]
    assert (found["x", "x"], found["k", "k"], len(found)) == (1.0, None, 9)


def test_dispersion_and_group_summary(make):
    df = make("g string, x double", [("a", 1.0), ("a", 4.0), (None, 2.0)])
    assert values(aggregates.group_summary(df, ["g"], "x")) == [
        (None, 2.0, None, 1),
        ("a", 2.5, pytest.approx(math.sqrt(4.5)), 2),
    ]
    assert values(aggregates.dispersion(df, ["x"])) == [("x", pytest.approx(statistics.stdev([1, 4, 2])), 3.0)]


def test_zscores(make):
    df = make("x double, c double", [(1.0, 5.0), (2.0, 5.0), (3.0, 5.0), (None, 5.0)])
    found = scaling.zscores(df, {"x": "zx", "c": "zc"})
    assert values(found, "zx", "zc") == [(None, None), (-1.0, None), (0.0, None), (1.0, None)]
    assert values(scaling.above_mean(df, "x"), "x") == [(3.0,)]


def test_results_do_not_depend_on_partitions(spark):
    df = spark.range(5_000).select((F.col("id") % 7).alias("g"), (F.col("id") * 37 % 1009).cast("double").alias("x"))
    runs = []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "4", "64"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            runs.append(values(exact_quantiles(df.repartition(int(n)), ["g"], "x", [0.25, 0.5])))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert runs[0] == runs[1] == runs[2]


def test_attribute_medians_are_medians(make):
    df = make("g int, x double", [(1, 1.0)] * 5 + [(1, 4.0)] * 3 + [(1, 9.0)] * 4 + [(1, None), (None, 2.0), (None, 3.0), (2, None)])
    assert values(scaling.attach_attribute_medians(df, ["g"], "x", "m")) == values(scaling.attach_medians(df, ["g"], "x", "m"))
