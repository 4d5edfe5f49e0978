"""Pair tables on hand-made rows."""

from __future__ import annotations

from datetime import date

import pytest
from conftest import values
from pyspark.sql import functions as F

from polyad.plans import checks, dyadic


@pytest.fixture(scope="module")
def sources(make):
    influence = make("iso3a string, iso3b string, year int, w double", [("AAA", "BBB", 2000, 1.0), ("BBB", "AAA", 2000, 2.0), ("AAA", "XXX", 2000, 3.0)])
    codes = make("code string, unit int", [("AAA", 1), ("BBB", 2)])
    disputes = make("statea int, stateb int, year int, hihosta int, fatlev int", [(1, 2, 2000, 4, -9), (1, 2, 2000, -9, 2)])
    trade = make(
        "exporter_cow int, importer_cow int, year int, RED_export_importance double, RED_import_importance double",
        [(1, 2, 2000, 60.0, 10.0), (1, 3, 2000, 40.0, 20.0), (2, 1, 2000, 100.0, None)],
    )
    return influence, codes, disputes, trade


def test_spine_fan_out_and_collapse(sources):
    literal = dyadic.dyad_spine(*sources)
    assert values(literal, "COWcode_a", "COWcode_b", "hihosta", "fatlev", "RED_export_importance") == [
        (1, 2, -9, 2, 60.0),
        (1, 2, 4, -9, 60.0),
        (2, 1, None, None, 100.0),
    ]
    collapsed = dyadic.dyad_spine(*sources, collapse="max")
    assert values(collapsed, "COWcode_a", "hihosta", "fatlev") == [(1, 4, 2), (2, None, None)]


def test_profiles_of_both_sides(make, sources):
    monad = make(
        "COWcode int, year int, v2x_libdem double, mid_x int, trade_export_hhi double, countrya string, islmgenpct double, chrstgenpct double",
        [(1, 2000, 0.2, 1, 0.5, "A", 10.0, None), (2, 2000, 0.6, 1, 0.5, "B", 40.0, 5.0)],
    )
    profile = dyadic.monad_profile(monad, sources[3])
    assert profile.columns == ["COWcode", "year", "v2x_libdem", "country", "islmgenpct", "chrstgenpct", "hhi_export", "hhi_import"]
    both = dyadic.dyad_context(dyadic.monad_to_dyad(dyadic.dyad_spine(*sources, collapse="max"), profile, salt=3))
    row = {r.COWcode_a: r for r in both.collect()}[1]
    assert row.hhi_export_a == pytest.approx(0.52)
    assert row.hhi_export_gap == pytest.approx(-0.48)
    assert (row.country_b, row.targeted_democracy, row.islm_dist, row.chrst_dist) == ("B", 1, 30.0, None)


@pytest.mark.parametrize(
    ("a", "b", "expected"), [(None, 0.9, None), (None, 0.4, 0), (0.2, None, None), (0.5, None, 0), (None, None, None)]
)
def test_targeting_with_unknown_scores(make, a, b, expected):
    row = make(
        "v2x_libdem_a double, v2x_libdem_b double, hhi_export_a double, hhi_export_b double, islmgenpct_a double,"
        " islmgenpct_b double, chrstgenpct_a double, chrstgenpct_b double",
        [(a, b, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0)],
    )
    assert dyadic.dyad_context(row).first().targeted_democracy == expected


def test_distances_follow_the_valid_capital(make):
    capitals = make(
        "COWcode int, valid_from date, valid_to date, lat double, lon double",
        [
            (1, date(1900, 1, 1), date(1999, 12, 31), 0.0, 0.0),
            (1, date(2000, 1, 1), date(2100, 1, 1), 0.0, 90.0),
            (2, date(1900, 1, 1), date(2100, 1, 1), 0.0, 180.0),
        ],
    )
    pairs = make("COWcode_a int, COWcode_b int, year int", [(1, 2, 1999), (1, 2, 2000), (1, 3, 2000), (1, 2, 2020)])
    found = {(r.COWcode_b, r.year): r.dist_km for r in dyadic.dyad_distance(pairs, capitals).collect()}
    half = 6371.0088 * 3.141592653589793
    assert found == {(2, 1999): pytest.approx(half), (2, 2000): pytest.approx(half / 2), (3, 2000): None}


def test_leader_variables(make):
    columns = "COWcode int, year int, " + ", ".join(
        f"{c} {'int' if 'year' in c or 'days' in c or c in ('leader_age', 'exitcode', 'post_tenure_fate', 'previous_times') else 'string'}"
        for c in dyadic.LEADER_COLUMNS
    )
    leaders = make(
        columns,
        [
            (1, 2000, "A", "id1", 1, 100, 1, 0, 50, "F", "Irregular", None, 0, 0, 0),
            (2, 2000, "B", "id1", 4, 900, 0, 0, None, "F", "Irregular", None, 0, 0, 0),
        ],
    )
    pairs = make("COWcode_a int, COWcode_b int, year int", [(1, 2, 2000), (1, 9, 2000), (2, 9, 2000)])
    led = dyadic.dyad_leaders(pairs, leaders)
    wanted = ["COWcode_a", "COWcode_b", "leader_tenure_diff", "both_leaders_new", "any_leader_new", "same_leader"]
    more = ["both_female_leaders", "leader_age_diff", "irregular_entry_b", "both_irregular_entry"]
    assert values(led, *wanted, *more) == [
        (1, 2, 3, 0, 1, 1, 1, None, 1, 1),
        (1, 9, None, None, 1, 0, None, None, 0, 0),
        (2, 9, None, 0, None, 0, None, None, 0, 0),
    ]
    assert values(checks.leader_coverage(led)) == [(3, 3, 1, 1)]
    assert values(checks.leader_events(led)) == [(2, 0, 3, 1)]


@pytest.fixture(scope="module")
def scored(make):
    rows = [(1, 2, 2000, 1.0, 2.0, 0.1, 0.8), (1, 3, 2000, 3.0, None, 0.2, 0.9), (2, 3, 2000, 5.0, 0.0, 0.9, None), (2, 1, 2001, None, 1.0, 0.5, 0.5)]
    return make(
        "COWcode_a int, COWcode_b int, year int, v2exl_legitideol_a double, v2exl_legitideol_b double,"
        " v2x_libdem_a double, v2x_libdem_b double",
        rows,
    )


def test_extremity_uses_side_a(scored):
    found = dyadic.ideology_extremity(scored)
    assert values(found, "COWcode_a", "COWcode_b", "global_med_ideol", "ideol_extremity_a", "ideol_extremity_b") == [
        (1, 2, 3.0, 2.0, 1.0),
        (1, 3, 3.0, 0.0, None),
        (2, 1, None, None, None),
        (2, 3, 3.0, 2.0, 3.0),
    ]


def test_index_variants(scored):
    extreme = dyadic.ideology_extremity(scored)
    raw = {(r.COWcode_a, r.COWcode_b): r for r in dyadic.revisionist_index(extreme, "raw").collect()}
    assert raw[1, 2].rev_potential_a == pytest.approx((2.0 + 0.9 + 1.0) / 3)
    assert raw[1, 2].revisionism_distance == pytest.approx(abs((2.0 + 0.9 + 1.0) / 3 - (1.0 + 0.2 + 2.0) / 3))
    assert raw[2, 3].rev_potential_b is None
    z = dyadic.revisionist_index(extreme, "z").agg(F.avg("z_legit_a"), F.stddev_samp("z_legit_a"), F.avg("rev_potential_a")).first()
    assert tuple(z)[:2] == (pytest.approx(0.0, abs=1e-12), pytest.approx(1.0))
    with pytest.raises(ValueError, match="variant"):
        dyadic.revisionist_index(extreme, "other")


def test_buckets_and_conditions(make):
    rows = [(0.8, 1.0, 0.9, 0.1), (0.1, 3.0, 0.9, 0.4), (0.1, 5.0, 0.8, 0.9), (0.5, None, 0.9, 0.2), (None, 2.0, 0.9, 0.2)]
    df = make("v2x_libdem_a double, rev_potential_a double, v2x_libdem_b double, hhi_import_b double", rows)
    assert values(checks.regime_buckets(df), "regime_cat", "mean", "n") == [
        (None, 2.0, 1),
        ("Autocracy", 4.0, 2),
        ("Democracy", 1.0, 1),
        ("Mixed", None, 1),
    ]
    assert values(checks.conditional_correlation(df)) == [(pytest.approx(1.0),)]
    assert values(checks.missing_share(df, "rev_potential_a")) == [(20.0,)]


def test_latest_valid_capital_counts(spark):
    from polyad.plans import dyadic

    pairs = spark.createDataFrame([(1, 2, 2000)], "COWcode_a int, COWcode_b int, year int")
    capitals = spark.createDataFrame(
        [(1, "1900-01-01", "2100-01-01", 0.0, 0.0), (1, "1990-01-01", "2100-01-01", 10.0, 0.0), (2, "1900-01-01", "2100-01-01", 10.0, 0.0)],
        "COWcode int, valid_from string, valid_to string, lat double, lon double",
    ).withColumns({c: F.col(c).cast("date") for c in ("valid_from", "valid_to")})
    (row,) = dyadic.dyad_distance(pairs, capitals).collect()
    assert row.dist_km == 0.0
