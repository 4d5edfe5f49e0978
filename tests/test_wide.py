from __future__ import annotations

import numpy as np
import pytest
from conftest import values
from pyspark.sql import functions as F

from polyad.operators.aggregates import correlation_matrix
from polyad.operators.wide import wide_correlations


def test_as_the_expressions_give(make):
    rng = np.random.default_rng(1)
    rows = [tuple(None if rng.random() < 0.05 else float(x) for x in r) for r in rng.normal(1e6, 1.0, (500, 5))]
    df = make("a double, `b.c` double, d double, e double, f double", rows).repartition(7)
    names = ["a", "b.c", "d", "e", "f"]
    plain = df.toDF(*"vwxyz").dropna().toPandas().to_numpy()
    expected = np.corrcoef(plain, rowvar=False)
    found = {(r, c): v for r, c, v in values(wide_correlations(df, names))}
    assert len(found) == 25
    for i, a in enumerate(names):
        for k, b in enumerate(names):
            assert found[a, b] == pytest.approx(expected[i, k], abs=1e-9)
    short = ["a", "d", "e"]
    other = {(r, c): v for r, c, v in values(correlation_matrix(df, short))}
    assert {k: pytest.approx(v) for k, v in other.items()} == {(r, c): v for r, c, v in values(wide_correlations(df.withColumn("b.c", F.lit(1.0)), short))}


def test_constant_columns_and_no_rows(make):
    df = make("a double, b double, c int", [(0.1, 1.0, 1), (0.1, 2.0, 2), (0.1, float("nan"), 9), (0.1, 4.0, 5)])
    assert values(wide_correlations(df, ["a", "b"])) == [("a", "a", None), ("a", "b", None), ("b", "a", None), ("b", "b", 1.0)]
    for few in (df.limit(0), df.where("c = 1")):
        assert {r[2] for r in values(wide_correlations(few, ["a", "b"]))} == {None}
    assert values(wide_correlations(df, [])) == []
    with pytest.raises(ValueError, match="repeat"):
        wide_correlations(df, ["a", "a"])


def test_five_hundred_columns(spark):
    base = spark.range(0, 3000, 1, 6)
    wide = base.select(*[(F.hash(F.col("id"), F.lit(k)) / 1e6 + F.col("id") * (k % 7)).alias(f"x{k}") for k in range(500)])
    found = wide_correlations(wide, wide.columns).toPandas().pivot(index="row_variable", columns="column_variable", values="correlation")
    found = found.loc[wide.columns, wide.columns].to_numpy()
    expected = np.corrcoef(wide.toPandas().to_numpy(), rowvar=False)
    assert found.shape == (500, 500) and np.allclose(found, expected, atol=1e-9)
