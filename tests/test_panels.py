"""Unit-year modules and spells on hand-made rows."""

from __future__ import annotations

from datetime import date

import pytest
from conftest import values
from pyspark.sql import functions as F

from polyad.operators import spells
from polyad.operators.joins import require_empty
from polyad.operators.schema import inline_table
from polyad.plans import constants, monadic


@pytest.fixture(scope="module")
def panel(make):
    return make("COWcode int, year int, v2x_libdem double", [(1, 2000, 0.4), (2, 2000, 0.6), (3, 2000, None), (1, 2001, 0.4)])


def test_disputes(make, panel):
    rows = [
        (1, 9, 2000, 1, -9, -9),
        (1, 9, 2000, 3, -9, -9),
        (2, 9, 2000, 1, 3, 0),
        (2, 9, 2000, 1, -9, 4),
        (2, 9, 2000, 3, 5, 6),
        (2, 9, 2000, 2, None, None),
        (2, 9, 1900, 1, 5, 6),
    ]
    disputes = make("statea int, stateb int, year int, dyad_rolea int, hihosta int, fatlev int", rows)
    found = monadic.dispute_monadic(panel.select("COWcode", "year"), disputes)
    assert values(found) == [
        (1, 2000, 2, 1, 1, 1, 0, 0, 0),
        (1, 2001, 0, 0, 0, 1, 0, 0, 0),
        (2, 2000, 4, 2, 1, 5, 1, 6, 2),
        (3, 2000, 0, 0, 0, 1, 0, 0, 0),
    ]


def test_bloc_with_the_fixed_roster(spark, make):
    roster = inline_table(spark, "COWcode int, start_year int, end_year int, name string", constants.BLOC_ROSTER)
    panel = make("COWcode int, year int", [(91, y) for y in range(2007, 2012)] + [(101, 2003), (101, 2004), (200, 2010), (20, 2010)])
    found = monadic.bloc_membership(panel, roster.drop("name"))
    flags = {(u, y): (p, m) for u, y, p, m in values(found)}
    assert [flags[91, y] for y in range(2007, 2012)] == [(1, 0), (1, 1), (1, 1), (1, 1), (1, 0)]
    assert (flags[101, 2003], flags[101, 2004], flags[200, 2010], flags[20, 2010]) == ((0, 0), (1, 1), (0, 0), (0, 0))
    require_empty(monadic.membership_violations(found), "membership rules are broken")


def test_trade_stays_null_without_rows(make, panel):
    trade = make(
        "exporter_cow int, importer_cow int, year int, RED_export_importance double, RED_import_importance double",
        [(1, 2, 2000, 50.0, None), (1, 710, 2000, 30.0, None), (1, 40, 2000, 20.0, None)],
    )
    found = {(r.COWcode, r.year): r for r in monadic.trade_dependence(panel, trade).collect()}
    row = found[1, 2000]
    assert row.trade_export_hhi == pytest.approx(0.38)
    assert (row.exp_dep_usa, row.exp_dep_china, row.exp_dep_venezuela, row.exp_dep_alba_bloc) == (50.0, 30.0, 0.0, 20.0)
    assert (row.trade_import_hhi, row.imp_dep_usa) == (0.0, 0.0)
    assert found[2, 2000].trade_export_hhi is None


def test_alliances_ignore_unknown_partners(make, panel):
    pacts = make(
        "stateA int, stateB int, year int, defense int, offense int, nonagg int, consul int",
        [(5, 1, 2000, 1, 0, 1, 1), (5, 2, 2000, 1, 1, None, None), (5, 3, 2000, 1, 0, 0, 1)],
    )
    whole = panel.unionByName(make("COWcode int, year int, v2x_libdem double", [(5, 2000, 0.9)]))
    found = monadic.alliance_weighted(whole, pacts).where("COWcode = 5").first()
    assert (found.atop_defense_total, found.atop_defense_with_auto) == (3, 1)
    assert (found.atop_offense_with_auto, found.atop_nonagg_total, found.atop_consul_total) == (0, 1, 2)
    assert monadic.alliance_weighted(whole, pacts).where("COWcode = 1 and atop_defense_total <> 0").count() == 0


def test_ideology(make, panel):
    labels = make(
        "country_code_cow int, year int, leader_ideology string, hog_ideology string",
        [(1, 2000, "leftist", "no information"), (2, 2000, None, "rightist"), (None, 2000, "centrist", None)],
    )
    found = {(r.COWcode, r.year): r for r in monadic.ideology_recode(panel, labels).collect()}
    assert (found[1, 2000].gli_leader_ideology_num, found[1, 2000].is_leftist_leader) == (1, 1)
    assert (found[2, 2000].gli_leader_ideology_num, found[2, 2000].gli_hog_ideology_num) == (0, 3)
    assert (found[3, 2000].leader_ideology_raw, found[3, 2000].gli_hog_ideology_num) == (None, 0)


def test_population_of_nothing(make):
    economy = make("iso2c string, year int, `SP.POP.TOT` double", [("AA", 2000, None), ("AB", 2000, None), ("BB", 2000, 5.0)])
    governance = make("iso2c string, year int, `CC.EST` double", [("AA", 2000, 1.0)])
    codes = make("code string, unit int", [("AA", 1), ("AB", 1), ("BB", 2)])
    for empty, population in (("null", None), ("zero", 0.0)):
        found = monadic.indicator_panel(economy, governance, codes, {}, empty_population=empty)
        assert values(found, "COWcode", "wdi_pop") == [(1, population), (2, 5.0)]
    assert values(found, "wdi_gdp_pc", "govt_effectiveness") == [(None, None)] * 2


def test_unified_values_and_priority(make):
    panel = make("COWcode int, year int", [(k, 2000) for k in range(1, 6)])
    wdi = make(
        "COWcode string, year int, wdi_gdp_pc double, wdi_pop double, resource_rents double, corruption_control double",
        [("1", 2000, 10.0, None, 50.0, 0.0), ("2", 2000, None, 3.0, 11.0, None), ("3", 2000, -1.0, 1.0, 10.0, 2.5)],
    )
    history = make("COWcode int, year int, maddison_gdp_pc double, maddison_pop double", [(1, 2000, 9.0, 8.0), (2, 2000, 7.0, 6.0)])
    oil = make("COWcode int, year int, oil_gas_pop double, is_petro_state_ross int", [(1, 2000, 0.0, 0), (4, 2000, 500.0, 1)])
    found = {r.COWcode: r for r in monadic.unify_indicators(panel, history, wdi, oil).collect()}
    assert [found[k].unified_gdp_pc for k in range(1, 6)] == [10.0, 7.0, -1.0, None, None]
    assert (found[1].unified_pop, found[3].log_gdp_pc, found[1].log_oil_gas_wealth) == (8.0, None, 0.0)
    assert [found[k].is_petro_state for k in range(1, 6)] == [0, 1, 0, 1, 0]


def test_unified_index_with_and_without_the_primary(make):
    rows = make(
        "COWcode int, aut_ep_id string, dem_ep_id string, corruption_control double, e_x int, dem_founding_elec int",
        [(1, "a", None, 0.0, 1, 1), (2, None, "d", None, 1, 1)],
    )
    found = monadic.unified_index(rows)
    assert found.columns == ["COWcode", "is_aut_episode", "is_dem_episode", "unified_corruption"]
    assert values(found) == [(1, 1, 0, 0.5), (2, 0, 1, None)]
    primary = monadic.unified_index(rows.withColumn("v2x_corr", F.lit(0.25)))
    assert values(primary, "unified_corruption") == [(0.25,), (0.25,)]


def test_share_series(make):
    shares = make("COWcode int, year int, apct double", [(1, 1945, 10.0), (1, 1950, 20.0), (1, 1955, 30.0)])
    literal = {r.year: r.apct for r in monadic.share_series_yearly(shares, ["apct"], end=1958).collect()}
    assert (literal[1946], literal[1950], literal[1952], literal[1958], len(literal)) == (None, 20.0, 24.0, 30.0, 13)
    anchored = {r.year: r.apct for r in monadic.share_series_yearly(shares, ["apct"], end=1958, anchor=True).collect()}
    assert (anchored[1946], anchored[1949], len(anchored)) == (12.0, 18.0, 13)


@pytest.fixture(scope="module")
def reigns(make):
    rows = [
        (1, "first", date(1999, 1, 1), date(2000, 6, 1)),
        (1, "second", date(2000, 6, 1), date(2001, 12, 30)),
        (2, "exits on the day", date(2000, 1, 1), date(2001, 12, 31)),
        (3, "open", date(2018, 3, 1), None),
        (4, "reversed", date(2019, 3, 1), date(2017, 1, 1)),
        (5, "same day b", date(2000, 1, 1), date(2000, 12, 31)),
        (5, "same day a", date(2000, 1, 1), date(2000, 12, 31)),
    ]
    return make("unit int, name string, start_date date, end_date date", rows)


def test_spells(reigns):
    held = spells.expand_spells(reigns, tie_break=["name"])
    assert values(held, "unit", "year", "name") == [
        (1, 1999, "first"),
        (1, 2000, "second"),
        (2, 2000, "exits on the day"),
        (2, 2001, "exits on the day"),
        (5, 2000, "same day a"),
    ]
    tenure = spells.spell_tenure(held)
    assert values(tenure.where("unit = 2"), "year", "tenure_years", "tenure_days", "first_year", "last_year") == [
        (2000, 1, 365, 1, 0),
        (2001, 2, 730, 0, 1),
    ]


def test_open_spells_can_be_closed(reigns):
    held = spells.expand_spells(reigns, close_open_spells=True, tie_break=["name"])
    assert values(held.where("unit in (3, 4)"), "unit", "year") == [(3, 2018), (3, 2019), (3, 2020), (4, 2019), (4, 2020)]
