"""Column names with dots, through every public operator that takes names."""

from __future__ import annotations

import pytest
from conftest import values
from pyspark.sql import functions as F

from polyad.operators import aggregates, joins, ranking, schema


@pytest.fixture
def dotted(make):
    return make("`a.k` int, `b.x` double, `c.s` string", [(1, 1.0, "p"), (1, 3.0, None), (2, None, "q"), (None, 5.0, "p")])


def test_joins(dotted, make):
    names = make("`n.k` int, `n.name` string", [(1, "one"), (None, "none")])
    for how in ({}, {"salt": 3}, {"null_slots": 4}):
        found = joins.key_join(dotted, names, {"a.k": "n.k"}, **how)
        assert values(found, "`a.k`", "`n.name`") == [(None, "none"), (1, "one"), (1, "one"), (2, None)]
    assert values(joins.key_join(dotted, names, {"a.k": "n.k"}, "left_semi"), "`a.k`") == [(None,), (1,), (1,)]
    assert values(joins.key_join(dotted, names, {"a.k": "n.k"}, "full"), "`a.k`") == [(None,), (1,), (1,), (2,)]
    assert values(joins.duplicate_keys(dotted, ["a.k"])) == [(1, 2)]
    assert joins.fan_out(dotted, names, {"a.k": "n.k"}).first().matched_rows == 3
    assert joins.merge_coverage(dotted, "a.k", "c.s").first().matched_both == 2
    events = make("`e.k` int, `e.v` int", [(1, 7), (1, 8)])
    assert values(joins.events_join(make("`a.k` int, z int", [(1, 0), (2, 0)]), events, {"a.k": "e.k"}), "`a.k`", "`e.v`") == [(1, 7), (1, 8), (2, None)]
    assert joins.coerced_join(dotted, make("`a.k` string, w int", [("1", 5)]), ["a.k"]).where("w = 5").count() == 2


def test_schema(dotted):
    assert schema.suffix_columns(dotted, "_z", ["a.k"]).columns == ["a.k", "b.x_z", "c.s_z"]
    assert values(schema.across(dotted, ["b.x"], lambda c: c + 1, "{}_up"), "`b.x_up`") == [(None,), (2.0,), (4.0,), (6.0,)]
    assert values(dotted.select(schema.column_or(dotted, "b.x").alias("v")))[-1] == (5.0,)


def test_aggregates(dotted):
    assert values(aggregates.missing_profile(dotted), "variable", "share") == [("a.k", 25.0), ("b.x", 25.0), ("c.s", 25.0)]
    assert values(aggregates.coverage(dotted, ["b.x", "none"]), "variable", "missing") == [("b.x", 1), ("none", None)]
    assert values(aggregates.dispersion(dotted, ["b.x"]), "variable", "range") == [("b.x", 4.0)]
    assert values(aggregates.frequency(dotted, ["c.s"]), "n") == [(1,), (1,), (2,)]
    assert values(aggregates.frequency(dotted, ["c.s"], include_null=False), "n") == [(1,), (2,)]
    assert aggregates.group_summary(dotted, ["c.s"], "b.x").count() == 3
    assert aggregates.panel_extent(dotted, "a.k", "b.x").first().n_units == 2


def test_ranking(dotted):
    assert values(ranking.first_per_group(dotted, ["c.s"], ["b.x"]), "`a.k`") == [(1,), (1,), (2,)]
    assert values(ranking.latest_per_group(dotted, ["c.s"], "b.x", [F.col("`a.k`")]), "`b.x`") == [(None,), (3.0,), (5.0,)]
    assert ranking.top_distinct(dotted, ["a.k", "b.x"], "b.x", 1).count() == 1
