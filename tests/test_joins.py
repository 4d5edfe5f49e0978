from __future__ import annotations

import pytest
from conftest import values
from pyspark.sql import functions as F

from polyad.operators import crosswalk, grid, joins, ranking


def test_null_keys(make):
    left = make("k int, v string", [(1, "a"), (None, "b")])
    right = make("k int, w string", [(1, "x"), (None, "y")])
    assert values(joins.key_join(left, right, ["k"])) == [(None, "b", "y"), (1, "a", "x")]
    assert values(joins.key_join(left, right, ["k"], null_safe=False)) == [(None, "b", None), (1, "a", "x")]


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salt_changes_nothing(make, how):
    left = make("k int, v int", [(1, i) for i in range(40)] + [(None, 99), (5, 98)])
    right = make("k int, w int", [(1, 10), (1, 11), (None, 12), (2, 13)])
    assert values(joins.key_join(left, right, ["k"], how, salt=7)) == values(joins.key_join(left, right, ["k"], how))


def test_events_join_equals_a_left_join(make):
    left = make("k int, y int, w string", [(1, 1, "a"), (1, 2, "b"), (None, 1, "c"), (3, 1, "d")])
    events = make("unit int, y int, e int", [(1, 1, i) for i in range(5)] + [(None, 1, 7), (9, 9, 8)])
    on = {"k": "unit", "y": "y"}
    assert values(joins.events_join(left, events, on)) == values(joins.key_join(left, events, on))


def test_collisions(make):
    left, right = make("k int, v int", [(1, 2)]), make("k int, v int", [(1, 3)])
    with pytest.raises(ValueError, match="both sides"):
        joins.key_join(left, right, ["k"])
    assert values(joins.key_join(left, right, ["k"], collisions="keep_left")) == [(1, 2)]


def test_coerced_keys(make):
    left = make("code int, v int", [(2, 1), (3, 2), (None, 3)])
    right = make("unit string, w int", [("2", 7), ("abc", 8), ("2.0", 9)])
    assert values(joins.coerced_join(left, right, {"code": "unit"})) == [(None, 3, 8), (2, 1, 7), (2, 1, 9), (3, 2, None)]
    text = make("code string, v int", [("2", 1)])
    assert values(joins.coerced_join(text, make("code int, w int", [(2, 5)]), ["code"], "full")) == [("2", 1, 5)]
    assert values(joins.coerced_join(text, make("code int, w int", [(4, 5)]), ["code"], "right")) == [("4", None, 5)]


def test_both_sides(make):
    pairs = make("unit_a int, unit_b int, year int", [(1, 2, 2000), (2, 9, 2000)])
    monad = make("unit int, year int, x int", [(1, 2000, 10), (2, 2000, 20)])
    assert values(joins.enrich_both_sides(pairs, monad)) == [(1, 2, 2000, 10, 20), (2, 9, 2000, 20, None)]


def test_interval_member(make):
    panel = make("u int, year int", [(91, y) for y in range(2007, 2012)] + [(5, 2011), (6, 2008), (None, 2008)])
    roster = make(
        "u int, start_year int, end_year int", [(91, 2008, 2010), (91, 2009, 2009), (5, 2004, 9999), (7, 2000, 2001)]
    )
    found = {(r.u, r.year): r.member for r in joins.interval_member(panel, roster, "u", "year").collect()}
    assert [found[91, y] for y in range(2007, 2012)] == [0, 1, 1, 1, 0]
    assert (found[5, 2011], found[6, 2008], found[None, 2008], len(found)) == (1, 0, 0, 8)


def test_cardinality_checks(make):
    left, right = make("k int", [(1,), (2,), (3,)]), make("k int, v int", [(1, 1), (1, 2), (2, 3)])
    assert values(joins.duplicate_keys(right, ["k"])) == [(1, 2)]
    assert values(joins.fan_out(left, right, ["k"])) == [(3, 2, 4, 2)]
    with pytest.raises(AssertionError, match="not unique"):
        joins.require_empty(joins.duplicate_keys(right, ["k"]), "not unique")
    joins.require_empty(joins.duplicate_keys(left, ["k"]), "unique")


def test_violations_name_every_broken_rule(make):
    df = make("x int", [(1,), (5,), (None,)])
    assert values(joins.violations(df, big=F.col("x") > 3, odd=F.col("x") % 2 == 1)) == [(1, "odd"), (5, "big"), (5, "odd")]


def test_code_overrides_beat_the_table(make):
    table = make("code string, unit int", [("AAA", 1), ("BBB", 2), ("CCC", 3)])
    rows = make("iso string", [("AAA",), ("BBB",), ("CCC",), ("ZZZ",), ("SUN",), (None,)])
    mapped = crosswalk.map_codes(rows, "iso", table, {"BBB": None, "SUN": 1})
    assert values(mapped) == [(None, None), ("AAA", 1), ("BBB", None), ("CCC", 3), ("SUN", 1), ("ZZZ", None)]


def test_name_patterns(make):
    patterns = [("(?i)korea", 732), ("(?i)north.*korea", 731), ("^Peru$", 135), ("(?i)^peru", 135)]
    names = make("name string, v int", [("South Korea", 1), ("North Korea", 2), ("Peru", 3), ("Guam", 4), ("Mars", 5), (None, 6)])
    report = crosswalk.match_names(names, "name", patterns, {"Guam": None})
    assert values(report) == [
        ("Guam", None, 0, "override"),
        ("Mars", None, 0, "unmatched"),
        ("North Korea", None, 2, "ambiguous"),
        ("Peru", 135, 1, "matched"),
        ("South Korea", 732, 1, "matched"),
    ]
    assert values(crosswalk.map_names(names, "name", patterns, {"North Korea": 731}), "v", "unit") == [
        (1, 732),
        (2, 731),
        (3, 135),
        (4, None),
        (5, None),
        (6, None),
    ]


def test_grids(make):
    df = make("u int, t int, v int", [(1, 3, 10), (2, 5, 20), (1, 0, 99)])
    assert len(values(grid.complete_grid(df, "u", "t", 2, 4))) == 6
    anchored = grid.complete_grid(df, "u", "t", 2, 4, anchor=True)
    assert (1, 0, 99) in values(anchored) and (2, 5, 20) in values(anchored)
    assert len(values(grid.trim(anchored, "t", 2, 4))) == 6


def test_time_gaps_are_filled_in_blocks(make):
    df = make("u int, t int, v int", [(1, 3, 10), (1, 12, 11), (2, 5, 20)])
    expected = [(1, t, {3: 10, 12: 11}.get(t)) for t in range(3, 13)] + [(2, 5, 20)]
    for step in (2, 3, 100):
        assert values(grid.fill_time_gaps(df, "u", "t", step)) == expected


def test_all_pairs(make):
    panel = make("unit int, year int", [(1, 2000), (2, 2000), (3, 2001), (1, 2000)])
    found = values(grid.all_pairs(panel), "unit_a", "year", "unit_b", "dyad_year_id")
    assert found == [(a, y, b, f"{a}_{b}_{y}") for a, y in ((1, 2000), (2, 2000), (3, 2001)) for b in (1, 2, 3) if a != b]
    assert found == values(grid.all_pairs(panel, cell=1), "unit_a", "year", "unit_b", "dyad_year_id")


def test_ranking(make):
    df = make("g int, s int, k int", [(1, 5, 1), (1, 9, 2), (1, 9, 3), (2, None, 4)])
    assert values(ranking.latest_per_group(df, ["g"], "s", ["k"])) == [(1, 9, 2), (2, None, 4)]
    assert values(ranking.first_per_group(df, ["g"], ["k"])) == [(1, 5, 1), (2, None, 4)]
    assert [tuple(r) for r in ranking.top_distinct(df, ["s", "g"], "s", 2).collect()] == [(9, 1), (5, 1)]


def test_hot_null_key_is_dealt_to_slots(spark):
    """A third of the rows has a NULL key; it meets its match in every slot and nothing is doubled."""
    rows = spark.range(3000).select("id", F.when(F.col("id") % 3 != 0, F.col("id") % 7).alias("k"))
    lookup = spark.createDataFrame([(None, "none"), (1, "one"), (2, "two")], "k long, name string")
    joined = joins.key_join(rows, lookup, ["k"])
    assert joined.count() == 3000 and joined.where("name = 'none'").count() == 1000
    assert joins.key_join(rows, lookup, ["k"], "inner").count() == joined.where("name IS NOT NULL").count()
    assert joins.key_join(rows, lookup, ["k"], null_safe=False).where("name = 'none'").count() == 0
    assert "__salt" not in joined.columns


def test_candidate_pairs(spark):
    units = spark.range(6).select(F.col("id").cast("int").alias("unit"), F.lit(2000).alias("year"))
    wanted = spark.createDataFrame([(1, 2), (2, 1), (3, 3), (4, 9)], "unit_a int, unit_b int")
    found = grid.all_pairs(units, candidates=wanted)
    assert found.columns == grid.all_pairs(units).columns or set(found.columns) == set(grid.all_pairs(units).columns)
    assert sorted((r.unit_a, r.unit_b) for r in found.collect()) == [(1, 2), (2, 1)]
