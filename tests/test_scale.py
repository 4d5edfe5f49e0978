"""Plan shapes that must hold at any size, and results without any broadcast."""

from __future__ import annotations

import pytest
from conftest import values
from pyspark.sql import functions as F

from polyad.operators import joins, ranking, series
from polyad.operators.aggregates import exact_quantiles
from polyad.operators.grid import all_pairs
from workload.queries import QUERIES

DATA = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


LIGHT = ["dispute_monadic", "order_membership", "dyad_spine", "all_pairs_dyads", "dyad_distance", "interpolate_ends", "yearly_median", "sequence_samples", "latest_window", "normalize_groups", "sample_index", "sample_steps", "crosswalk_name_table"]


@pytest.mark.parametrize("name", LIGHT)
def test_no_join_without_an_equality(name, spark, no_broadcast):
    text = plan(QUERIES[name](spark, DATA))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    assert "BroadcastHashJoin" not in text
    assert "Python" not in text and "Pandas" not in text


@pytest.mark.parametrize("name", ["order_membership", "all_pairs_dyads", "dyad_distance", "yearly_median", "salted_join"])
def test_results_do_not_need_a_broadcast(name, spark, no_broadcast):
    shuffled = values(QUERIES[name](spark, DATA))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 << 20))
    assert shuffled == values(QUERIES[name](spark, DATA))


def test_latest_is_pruned_before_the_shuffle(spark):
    text = plan(QUERIES["latest_per_group"](spark, DATA))
    assert text.count("WindowGroupLimit") == 2
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(QUERIES["staged_replace"](spark, DATA))
    assert "ReadSchema: struct<c_custkey:bigint,c_acctbal:double>" in text
    orders = QUERIES["above_mean"](spark, DATA)
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in plan(orders)


def test_windows_have_a_partition(spark):
    for name in ("locf", "interpolate_linear", "sequence_samples", "yearly_median", "zscore"):
        text = plan(QUERIES[name](spark, DATA))
        assert "SinglePartition" not in text.split("Subquery")[0] or "Window" not in text


def test_hot_key_join_and_groups(spark):
    """One key holds a third of the rows; results equal the plain formulation."""
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 500).cast("int").alias("k"),
        (F.col("id") * 7919 % 10007).cast("double").alias("x"),
        "id",
    )
    lookup = spark.range(500).select(F.col("id").cast("int").alias("k"), (F.col("id") * 2).alias("w"))
    salted = joins.key_join(rows, lookup, ["k"], salt=16).agg(F.sum("w"), F.count("*")).first()
    assert salted == joins.key_join(rows, lookup, ["k"]).agg(F.sum("w"), F.count("*")).first()
    exact = exact_quantiles(rows, ["k"], "x", [0.5])
    plain = rows.groupBy("k").agg(F.median("x").alias("m"))
    assert values(exact, "k", "quantile") == values(plain, "k", "m")
    first = ranking.first_per_group(rows, ["k"], ["x", "id"])
    assert values(first, "k", "x") == values(rows.groupBy("k").agg(F.min("x").alias("x")))


def test_long_unit_is_cut_into_blocks(spark):
    """A unit with 60,000 steps gives the same fill for any block size."""
    long = spark.range(60_000).select(
        F.lit(1).alias("u"), F.col("id").cast("int").alias("t"), F.when(F.col("id") % 997 == 5, F.col("id") * 1.0).alias("x")
    )
    sums = set()
    for step in (500, 1 << 20):
        filled = series.interpolate(long, "u", "t", ["x"], ends="constant", step=step)
        sums.add(filled.agg(F.round(F.sum("x"), 3), F.count("x")).first())
    assert len(sums) == 1


def test_pairs_do_not_need_one_big_side(spark, no_broadcast):
    units = spark.range(120).select(F.col("id").cast("int").alias("unit"), F.lit(2000).alias("year"))
    assert all_pairs(units).count() == 120 * 119


def test_the_profile_is_shuffled_once_for_both_sides(make, no_broadcast):
    profile = make("COWcode int, year int, x double", [(u, y, u + y / 10) for u in range(20) for y in range(10)]).repartition(3)
    pairs = make("COWcode_a int, COWcode_b int, year int", [(a, b, a % 10) for a in range(21) for b in range(20)]).repartition(3)
    found = joins.enrich_both_sides(pairs, profile, "COWcode", "year", {"_a": "COWcode_a", "_b": "COWcode_b"})
    assert all(r.x_b == r.COWcode_b + r.year / 10 and (r.x_a is None) == (r.COWcode_a == 20) for r in found.collect())
    final = plan(found).split("Initial Plan")[0]
    assert final.count("ReusedExchange") == 1 and final.count("SortMergeJoin") == 2
