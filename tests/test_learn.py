from __future__ import annotations

import math

import numpy as np
import pytest
from conftest import values
from pyspark.sql import functions as F

from polyad.learn import impute, metrics, sequences


@pytest.fixture(scope="module")
def gaps(spark):
    """y depends on x and z; gaps in y and z overlap on some rows."""
    key = F.col("id")
    x = (key * 37 % 101).cast("double")
    z = 3 * x + (key * 53 % 17)
    y = 2 * x - z + 5 + (key * 29 % 7) / 10
    return spark.range(600).select(
        "id",
        F.when(key % 5 != 0, y).alias("y"),
        F.when(key % 7 != 0, z).alias("z"),
        x.alias("x"),
        F.lit(1e9).alias("constant"),
    )


def chained(table: np.ndarray, rounds: int, order: list[int]) -> np.ndarray:
    """Row-by-row brute force of the chain with plain least squares."""
    missing = np.isnan(table)
    filled = np.where(missing, np.nanmean(table, axis=0), table)
    for _ in range(rounds):
        for j in order:
            others = [k for k in range(table.shape[1]) if k != j]
            design = np.column_stack([np.ones(len(filled)), filled[:, others]])
            seen = ~missing[:, j]
            beta = np.linalg.lstsq(design[seen], filled[seen, j], rcond=None)[0]
            filled[missing[:, j], j] = design[missing[:, j]] @ beta
    return filled


def test_chain_equals_row_by_row_regression(gaps):
    rows = values(gaps, "id", "y", "z", "x")
    table = np.array([[math.nan if v is None else v for v in r[1:]] for r in rows])
    expected = chained(table, rounds=4, order=[1, 0])
    done = impute.chained_imputation(gaps, ["y", "z"], ["x"], ["id"], rounds=4, sample=False, ridge=0.0)
    found = np.array(values(done.filled, "id", "y", "z"))
    assert np.allclose(found[:, 1:], expected[:, :2], rtol=1e-6, atol=1e-6)
    assert values(done.report) == [("y", 120), ("z", 86)]


def test_predictors_keep_their_gaps(gaps):
    done = impute.chained_imputation(gaps, ["y"], ["z", "x", "constant"], ["id"], rounds=2, sample=False)
    assert done.filled.where("y is null").count() == 0
    assert done.filled.where("z is null").count() == 86
    assert done.filled.columns == gaps.columns


def test_sampled_values(spark, gaps):
    def run(df, seed=42):
        done = impute.chained_imputation(df, ["y", "z"], ["x"], ["id"], rounds=5, seed=seed)
        return values(done.filled.select("id", F.round("y", 6).alias("y"), F.round("z", 6).alias("z")))

    first = run(gaps)
    assert first == run(gaps.repartition(13, "x"))
    assert first != run(gaps, seed=7)
    observed = {r[0]: r[1] for r in values(gaps, "id", "y") if r[1] is not None}
    assert all(abs(r[1] - observed[r[0]]) < 1e-6 for r in first if r[0] in observed)
    exact = impute.chained_imputation(gaps, ["y", "z"], ["x"], ["id"], rounds=5, sample=False)
    mean = {r[0]: r[2] for r in values(exact.filled, "id", "y", "z")}
    noise = [r[2] - mean[r[0]] for r in first if r[0] % 7 == 0]
    assert 0.5 < np.std(noise) < 12
    assert abs(np.mean(noise)) < 3


def test_no_gaps_and_no_values(make):
    full = make("k int, y double, x double", [(1, 1.0, 2.0), (2, 3.0, 4.0)])
    assert values(impute.chained_imputation(full, ["y"], ["x"], ["k"]).filled) == values(full)
    with pytest.raises(ValueError, match="without any value"):
        impute.chained_imputation(make("k int, y double, x double", [(1, None, 2.0)]), ["y"], ["x"], ["k"])


def test_refresh_logs(make):
    df = impute.refresh_logs(make("x double", [(0.0,), (None,)]), {"log_x": "x", "log_absent": "absent"})
    assert values(df) == [(None, None), (0.0, 0.0)]


def test_prepared_frame(make):
    rows = [("2", "2000", 0.5, -5.0, None, 1.7), ("2.0", "2001", 0.6, None, 3.0, None), ("abc", "2000", 0.5, 1.0, 1.0, 1.0), ("3", "2000", None, 1.0, 1.0, 1.0)]
    df = make("COWcode string, year string, v2x_libdem double, unified_gdp_pc double, gini_disp double, mid_max_hostility double", rows)
    found = sequences.prepare_sequences_frame(df)
    assert values(found, "COWcode", "time_idx", "unified_gdp_pc", "log_gdp_pc", "gini_disp", "mid_max_hostility") == [
        ("2", 2000, 0.0, 0.0, 0.0, "1"),
        ("2", 2001, 0.0, 0.0, 3.0, "-1"),
    ]


@pytest.fixture(scope="module")
def steps(make):
    rows = [(9, t) for t in range(9)] + [(10, t) for t in range(10)] + [(11, t) for t in range(11)] + [(25, t + 50) for t in range(25)]
    return make("u int, t int", rows).withColumn("v", F.col("t") * 1.0)


@pytest.mark.parametrize("step", [25, 31, 4096])
def test_windows(steps, step):
    found = sequences.sequence_windows(steps, "u", "t", ["v"], step=step)
    sizes = values(found, "u", "cut", "encoder_length", "decoder_length")
    expected = [(11, 10, 10, 1)] + [(25, 50 + c, min(c, 20), min(25 - c, 5)) for c in range(10, 25)]
    assert sizes == expected
    last = found.where("u = 25 and cut = 72").first()
    assert [s.t for s in last.encoder] == list(range(52, 72)) and [s.v for s in last.decoder] == [72.0, 73.0, 74.0]


def test_gap_steps_repeat_the_last_value(make):
    df = make("u int, t int, v double", [(1, 0, 1.0), (1, 3, 2.0)])
    assert values(sequences.fill_steps(df, "u", "t", ["v"], step=2)) == [(1, 0, 1.0), (1, 1, 1.0), (1, 2, 1.0), (1, 3, 2.0)]


def test_sequence_rows_have_relative_time(steps):
    rows = sequences.sequence_steps(sequences.sequence_windows(steps, "u", "t", ["v"]), "u", "t")
    one = values(rows.where("u = 11"), "t", "role", "relative_time_idx", "encoder_length")
    assert one[0] == (0, "encoder", -0.5, 10) and one[-1] == (10, "decoder", 0.0, 10)


def test_latest_window(steps):
    found = sequences.latest_window_per_unit(steps, "u", "t", ["v"])
    assert values(found.groupBy("u", "role").count()) == [(25, "decoder", 5), (25, "encoder", 20)]
    assert sequences.latest_window_per_unit(steps, "u", "t", ["v"], units=[9]).count() == 0


def test_split(steps):
    found = sequences.time_split(steps, "t")
    assert values(found.groupBy("split").agg(F.max("t"), F.min("t"))) == [("holdout", 74, 70), ("train", 69, 0)]


def test_normalizer(make):
    df = make("g int, y double", [(1, 0.0), (1, 1.0), (1, 40.0), (2, 3.0), (2, None)])
    found = sequences.group_normalizer(df, "g", "y")
    rows = values(found.where("g = 1"), "y", "target_softplus_inv", "target_normalized")
    inverse = [math.log(math.expm1(max(y, 1e-8))) for y in (0.0, 1.0, 40.0)]
    assert [r[1] for r in rows] == pytest.approx(inverse)
    assert sum(r[2] for r in rows) == pytest.approx(0.0)
    assert {r.target_scale for r in found.where("g = 2").collect()} == {None}


def test_quantile_loss(make):
    df = make("y double, p double", [(3.0, 1.0), (1.0, 3.0), (None, 1.0)])
    assert values(metrics.quantile_loss(df, "y", {0.9: "p"})) == [(0.9, pytest.approx((1.8 + 0.2) / 2))]


def test_many_gap_columns_and_nan(spark):
    """Fourteen columns with gaps, one of them with NaN; the pass-by-pass chain gives the same."""
    from polyad.learn import impute

    columns = [f"c{i}" for i in range(14)]
    base = spark.range(400).select(
        "id", *[F.when((F.col("id") * (i + 3)) % 13 != i, F.col("id") * 0.1 * (i + 1) + (F.col("id") * 31 * (i + 1)) % 17).alias(c) for i, c in enumerate(columns)]
    )
    base = base.withColumn("c0", F.coalesce("c0", F.lit(float("nan"))))
    plain = impute.chained_imputation(base, columns[:3], columns[3:], ["id"], rounds=2, sample=False, ridge=0.0).filled
    limit, impute.PATTERN_CELLS = impute.PATTERN_CELLS, 1
    try:
        passes = impute.chained_imputation(base, columns[:3], columns[3:], ["id"], rounds=2, sample=False, ridge=0.0).filled
        drawn = impute.chained_imputation(base, columns[:3], columns[3:], ["id"], rounds=1).filled
    finally:
        impute.PATTERN_CELLS = limit
    both = plain.join(passes.select("id", *[F.col(c).alias(f"p_{c}") for c in columns[:3]]), "id")
    assert both.where(" OR ".join(f"abs({c} - p_{c}) > 1e-6 OR {c} IS NULL OR isnan({c})" for c in columns[:3])).count() == 0
    assert drawn.where("c0 IS NULL OR isnan(c0)").count() == 0
