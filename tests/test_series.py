from __future__ import annotations

import pytest
from conftest import values
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from polyad.operators import grid, series


@pytest.fixture(scope="module")
def sparse(make):
    rows = [(1, 1950, 1.0), (1, 1954, 5.0), (2, 1948, 7.0), (3, 1950, None), (4, 1945, 2.0), (4, 1950, 12.0)]
    return make("u int, t int, x double", rows)


@pytest.fixture(scope="module")
def gridded(sparse):
    return grid.complete_grid(sparse, "u", "t", 1946, 1956)


def curve(df, unit):
    return {r.t: r.x for r in df.where(F.col("u") == unit).collect()}


@pytest.mark.parametrize("step", [1, 3, 4096])
def test_interpolation_and_carry(gridded, step):
    filled = series.interpolate(gridded, "u", "t", ["x"], ends="carry", step=step)
    one = curve(filled, 1)
    assert (one[1949], one[1950], one[1951], one[1954], one[1956]) == (None, 1.0, 2.0, 5.0, 5.0)
    two, three = curve(filled, 2), curve(filled, 3)
    assert (two[1947], two[1948], two[1956]) == (None, 7.0, 7.0)
    assert set(three.values()) == {None}
    inner = curve(series.interpolate(gridded, "u", "t", ["x"], step=step), 1)
    assert (inner[1953], inner[1955]) == (4.0, None)
    ends = curve(series.interpolate(gridded, "u", "t", ["x"], ends="constant", step=step), 1)
    assert (ends[1946], ends[1956]) == (1.0, 5.0)


def test_off_grid_anchor(sparse):
    anchored = grid.complete_grid(sparse, "u", "t", 1946, 1956, anchor=True)
    filled = grid.trim(series.interpolate(anchored, "u", "t", ["x"], ends="carry"), "t", 1946, 1956)
    four = curve(filled, 4)
    assert (four[1946], four[1949], min(four)) == (4.0, 10.0, 1946)


def test_pooled_differs_from_per_unit(make):
    df = make("u int, t int, x double", [(1, 1, 0.0), (1, 2, None), (1, 3, 2.0), (2, 1, 10.0), (2, 2, None), (2, 3, None)])
    per_unit = series.interpolate(df, "u", "t", ["x"], ends="constant")
    assert values(per_unit) == [(1, 1, 0.0), (1, 2, 1.0), (1, 3, 2.0), (2, 1, 10.0), (2, 2, 10.0), (2, 3, 10.0)]
    pooled = series.interpolate_pooled(df, "u", "t", ["x"])
    assert values(pooled) == [(u, t, x) for u in (1, 2) for t, x in ((1, 5.0), (2, 3.5), (3, 2.0))]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.dictionaries(
        st.tuples(st.integers(1, 3), st.integers(-20, 20)),
        st.one_of(st.none(), st.floats(-5, 5).map(lambda x: round(x, 3))),
        min_size=1,
        max_size=25,
    ),
    st.integers(1, 9),
)
def test_blocks_never_matter_and_observed_values_stay(make, cells, step):
    df = make("u int, t int, x double", [(u, t, x) for (u, t), x in cells.items()])

    def run(size):
        filled = series.interpolate(df, "u", "t", ["x"], ends="constant", step=size)
        both = series.carry_forward(filled.withColumn("y", F.col("x")), "u", "t", ["y"], step=size)
        return [(u, t, None if x is None else round(x, 9), y is None) for u, t, x, y in values(both, "u", "t", "x", "y")]

    small = run(step)
    assert small == run(4096)
    kept = {(u, t): x for u, t, x, _ in small}
    assert all(kept[k] == x for k, x in cells.items() if x is not None)


def test_times_must_be_unique(make):
    df = make("u int, t int, x double", [(1, 2000, 3.0), (1, 2000, 4.0), (1, 2001, None), (1, 2002, 5.0)])
    with pytest.raises(Exception, match="t repeats within a u"):
        series.interpolate(df, "u", "t", ["x"]).collect()
    assert values(series.interpolate(series.mean_of_ties(df, "u", "t", ["x"]), "u", "t", ["x"]), "t", "x") == [(2000, 3.5), (2001, 4.25), (2002, 5.0)]
