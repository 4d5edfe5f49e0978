"""One callable per operator: (session, data folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from polyad.functions.values import finite_or_null, nan_to_null, paste_id, percent_text, round_even, to_number
from polyad.learn import sequences
from polyad.learn.impute import chained_imputation, refresh_logs
from polyad.learn.metrics import QUANTILES, quantile_loss
from polyad.learn.samples import materialise, sequence_index, sequence_store
from polyad.learn.sequences import (
    fill_steps,
    group_normalizer,
    latest_window_per_unit,
    prepare_sequences_frame,
    sequence_steps,
    sequence_windows,
    time_split,
)
from polyad.operators import aggregates, crosswalk, grid, intervals, joins, observed, ranking, scaling, schema, series, spells
from polyad.operators.patterns import match_name_table
from polyad.operators.wide import wide_correlations
from polyad.plans import checks, dyadic, monadic
from polyad.session import scratch_path, stage
from polyad.sources import checked, tables
from workload import views as V
from workload.views import Views

PARTNERS = {"usa": [2], "china": [7], "venezuela": [1], "alba_bloc": [4, 14, 9, 5]}
SCORES = ["v2x_libdem", "v2x_corr", "v2exl_legitideol", "islmgenpct", "chrstgenpct"]
SHARES = ["islmgenpct", "chrstgenpct"]

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Callable[[Views], DataFrame]) -> Callable[[Views], DataFrame]:
    QUERIES[fn.__name__] = lambda spark, sf_dir: fn(Views(spark, sf_dir))
    return fn


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round doubles for the comparison with another engine."""
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({c: F.round(c, digits) for c in doubles})


# -- unit-year modules ----------------------------------------------------------


@query
def dispute_monadic(v: Views) -> DataFrame:
    return monadic.dispute_monadic(v.panel().select("COWcode", "year"), v.disputes())


def with_bloc(v: Views, panel: DataFrame) -> DataFrame:
    return monadic.bloc_membership(panel, v.roster(), V.REGION, V.ELIGIBLE_FROM)


@query
def bloc_membership(v: Views) -> DataFrame:
    return with_bloc(v, v.panel().select("COWcode", "year"))


@query
def membership_violations(v: Views) -> DataFrame:
    """Checked against a stricter rule than the one applied, so that rows are found."""
    return monadic.membership_violations(bloc_membership(v), region_end=15, eligible_from=1998)


@query
def wide_membership(v: Views) -> DataFrame:
    """Shipments of far later and earlier years than any interval's first and last: open intervals reach them."""
    years = F.col("l_linenumber") * 7 + 1980
    items = v.table("lineitem").select((F.col("l_suppkey") % 20).cast("int").alias("COWcode"), years.cast("int").alias("year"))
    flagged = monadic.bloc_membership(items, v.roster(), V.REGION, V.ELIGIBLE_FROM)
    return flagged.groupBy("COWcode", "year", "alba_possible", "alba_member").agg(F.count("*").alias("n"))


@query
def order_membership(v: Views) -> DataFrame:
    """Orders placed while the buyer's nation was a member: the interval join on raw rows."""
    orders = v.unit_orders().select(F.col("u").alias("COWcode"), F.col("y").alias("year"), "o_totalprice")
    flagged = joins.interval_member(orders, v.roster(), "COWcode", "year")
    return rounded(
        flagged.groupBy("year", "member").agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("total")), 2
    )


def event_windows(v: Views) -> DataFrame:
    """Windows of up to some hours after every seventh event of a user; some stay open, some end before they start."""
    n = F.col("event_id")
    opened = F.when(n % 77 != 0, F.col("ts"))
    closed = F.when(n % 35 != 0, F.col("ts") + F.make_dt_interval(secs=(n * 37 % 20000 - 300).cast("decimal(18,6)")))
    return v.table("events").where(n % 7 == 0).select("user_id", n.alias("window"), opened.alias("opened"), closed.alias("closed"))


@query
def event_intervals(v: Views) -> DataFrame:
    """Events of a user within the user's windows, to the microsecond."""
    events = v.table("events").select("event_id", "user_id", "ts")
    met = intervals.interval_join(events, event_windows(v), ["user_id"], "ts", "opened", "closed")
    return met.groupBy("window").agg(F.count("*").alias("n"), F.min("event_id").alias("first_event"), F.max("event_id").alias("last_event"))


@query
def event_intervals_left(v: Views) -> DataFrame:
    """Every event with the closed windows that hold it, or with none."""
    events = v.table("events").select("event_id", "user_id", "ts")
    return intervals.interval_join(events, event_windows(v).dropna(), ["user_id"], "ts", "opened", "closed", "left").select("event_id", "window")


@query
def event_covered(v: Views) -> DataFrame:
    """Is an event in any window of its user? A third of the events has no user."""
    user = F.when(F.col("event_id") % 3 != 0, F.col("user_id"))
    events = v.table("events").select("event_id", user.alias("user_id"), "ts")
    return intervals.covered(events, event_windows(v), ["user_id"], "ts", "opened", "closed").select("event_id", "member")


@query
def bloc_score_series(v: Views) -> DataFrame:
    return rounded(monadic.bloc_score_series(with_bloc(v, v.panel())))


@query
def trade_dependence(v: Views) -> DataFrame:
    return rounded(monadic.trade_dependence(v.panel().select("COWcode", "year"), v.trade(), PARTNERS))


@query
def hhi_by_exporter(v: Views) -> DataFrame:
    return rounded(monadic.concentration_by(v.trade(), "exporter_cow", "RED_import_importance", "hhi_import"))


@query
def hhi_by_importer(v: Views) -> DataFrame:
    return rounded(monadic.concentration_by(v.trade(), "importer_cow", "RED_import_importance", "hhi_import"))


@query
def alliance_weighted(v: Views) -> DataFrame:
    weighted = monadic.alliance_weighted(v.panel().select("COWcode", "year", "v2x_libdem"), v.alliances())
    return rounded(weighted)


@query
def ideology_recode(v: Views) -> DataFrame:
    return monadic.ideology_recode(v.panel().select("COWcode", "year"), v.ideology())


@query
def gdp_history(v: Views) -> DataFrame:
    return rounded(monadic.gdp_history(v.history(), v.crosswalk(), V.CODE_OVERRIDES), 7)


@query
def crosswalk_code(v: Views) -> DataFrame:
    """Rows per unit after the code lookup; the NULL unit collects dropped and unknown codes."""
    mapped = crosswalk.map_codes(v.history(), "countrycode", v.crosswalk(), V.CODE_OVERRIDES, into="COWcode")
    return mapped.groupBy("COWcode").agg(F.count("*").alias("n"), F.count_distinct("countrycode").alias("codes"))


@query
def crosswalk_name(v: Views) -> DataFrame:
    return crosswalk.match_names(v.named_orders(), "name", V.NAME_PATTERNS, V.NAME_OVERRIDES)


@query
def crosswalk_name_table(v: Views) -> DataFrame:
    """Free text in orders matched with a pattern for each customer, and some for many or all of them."""
    key = F.col("c_custkey")
    patterns = v.table("customer").select(
        F.when(key % 3 == 0, F.concat(F.lit("^ORD .*"), "c_name", F.lit("$")))
        .when(key % 3 == 1, F.concat(F.lit("(?i)CUSTOMER#0*"), key.cast("string"), F.lit("( rush| late)?$")))
        .otherwise(F.concat(F.lit("(mr|ms)[.] "), "c_name", F.lit("$|"), "c_name", F.lit(" rush")))
        .alias("pattern"),
        (key + 1000).cast("int").alias("unit"),
    )
    few = schema.inline_table(v.spark, "pattern string, unit int", [("late$", 1), ("^[a-z. ]+#\\d+7$", 2), (None, 3)])
    order = F.col("o_orderkey")
    number = F.lpad(F.col("o_custkey").cast("string"), 9, "0")
    head = F.when(order % 4 == 0, "ord of ").when(order % 4 == 1, "ORD ").when(order % 4 == 2, "ms. ").otherwise("")
    tail = F.when(order % 5 == 0, " rush").when(order % 7 == 0, " late").otherwise("")
    names = v.table("orders").select(F.concat(head, F.lit("Customer#"), number, tail).alias("name"))
    return match_name_table(names, "name", patterns.unionByName(few), {"ms. Customer#000000002": 7, "Customer#000000004": None})


@query
def resource_wealth(v: Views) -> DataFrame:
    rows = v.named_orders().select(
        F.col("name").alias("cty_name"), "year", "o_orderkey", (F.col("o_totalprice") / 1900).alias("oil_gas_valuePOP_2014")
    )
    return rounded(monadic.resource_wealth(rows, V.NAME_PATTERNS, ["o_orderkey"], V.NAME_OVERRIDES))


@query
def inequality_mean(v: Views) -> DataFrame:
    rows = v.named_orders().select(
        F.col("name").alias("country"), "year", (F.col("o_totalprice") / 7 % 60).alias("gini_disp")
    )
    return rounded(monadic.inequality_mean(rows, V.NAME_PATTERNS, V.NAME_OVERRIDES), 7)


@query
def premium_mean(v: Views) -> DataFrame:
    rows = v.history().select(
        F.col("countrycode").alias("iso_code"), "year", (F.col("gdppc") / 100).alias("black_market_exchange_rates")
    )
    return rounded(monadic.premium_mean(rows, v.crosswalk(), V.CODE_OVERRIDES), 7)


@query
def indicator_panel(v: Views) -> DataFrame:
    return rounded(monadic.indicator_panel(v.economy(), v.governance(), v.crosswalk(), V.CODE_OVERRIDES), 7)


@query
def indicator_panel_pooled(v: Views) -> DataFrame:
    """Without the population column, and with one governance curve for all units."""
    economy = v.economy().drop("SP.POP.TOT")
    return rounded(
        monadic.indicator_panel(
            economy, v.governance(), v.crosswalk(), V.CODE_OVERRIDES, pooled=True, empty_population="zero"
        ),
        7,
    )


@query
def indicator_union(v: Views) -> DataFrame:
    """Batches with different columns stacked by name."""
    orders = v.table("orders")
    early = orders.where(F.year("o_orderdate") < 1998).select("o_orderkey", "o_totalprice", "o_orderstatus")
    late = orders.where(F.year("o_orderdate") >= 1998).select("o_orderkey", "o_orderpriority", "o_totalprice")
    stacked = tables.union_by_name([early, late], {"o_orderkey": "bigint", "o_comment": "string"})
    return rounded(stacked, 2)


def _coerced(v: Views, how: str) -> DataFrame:
    left = v.measures().select(F.when(F.col("u") != 4, F.col("u")).alias("COWcode"), F.col("y").alias("year"), "n")
    text_keys = v.unit_orders().select(
        F.when(F.col("u") == 6, "abc").when(F.col("u") == 2, "102").otherwise(F.col("u").cast("string")).alias("unit_text"),
        F.col("y").cast("double").alias("year"),
        "o_orderkey",
    )
    right = text_keys.groupBy("unit_text", "year").agg(F.max("o_orderkey").alias("last_order"))
    return joins.coerced_join(left, right, {"COWcode": "unit_text", "year": "year"}, how)


@query
def coerced_left_join(v: Views) -> DataFrame:
    return _coerced(v, "left")


@query
def coerced_right_join(v: Views) -> DataFrame:
    return _coerced(v, "right")


@query
def coerced_inner_join(v: Views) -> DataFrame:
    return _coerced(v, "inner")


@query
def coerced_full_join(v: Views) -> DataFrame:
    return _coerced(v, "full")


def _null_keyed(v: Views) -> tuple[DataFrame, DataFrame]:
    unit = F.when(F.col("c_nationkey") % 5 != 0, F.col("c_nationkey")).alias("unit")
    rows = v.table("customer").select("c_custkey", unit)
    key = F.col("n_nationkey")
    unit = F.when(key % 4 == 0, key + 100).when(key != 10, key).cast("int").alias("unit")
    return rows, v.table("nation").select(unit, "n_name")


@query
def null_safe_join(v: Views) -> DataFrame:
    return joins.key_join(*_null_keyed(v), ["unit"])


@query
def null_strict_join(v: Views) -> DataFrame:
    return joins.key_join(*_null_keyed(v), ["unit"], null_safe=False)


@query
def salted_join(v: Views) -> DataFrame:
    """The same enrichment with the hot key dealt to eight slots."""
    return joins.key_join(*_null_keyed(v), ["unit"], salt=8)


@query
def duplicate_keys(v: Views) -> DataFrame:
    return joins.duplicate_keys(v.links(), ["a", "b", "y"])


@query
def fan_out(v: Views) -> DataFrame:
    """How far raw disputes would multiply the pair table."""
    pairs = v.flows().select("a", "b", "y")
    return joins.fan_out(pairs, v.disputes(), {"a": "statea", "b": "stateb", "y": "year"})


def economics(v: Views) -> list[DataFrame]:
    named = v.named_orders()
    value = F.when(F.col("year") % 2 == 0, F.col("o_totalprice") / 1900)
    oil = named.select(F.col("name").alias("cty_name"), "year", "o_orderkey", value.alias("oil_gas_valuePOP_2014"))
    gini = named.select(F.col("name").alias("country"), "year", (F.col("o_totalprice") / 7 % 60).alias("gini_disp"))
    premium = v.history().select(F.col("countrycode").alias("iso_code"), "year", (F.col("gdppc") / 100).alias("black_market_exchange_rate"))
    return [
        monadic.gdp_history(v.history(), v.crosswalk(), V.CODE_OVERRIDES),
        monadic.indicator_panel(v.economy(), v.governance(), v.crosswalk(), V.CODE_OVERRIDES),
        monadic.resource_wealth(oil, V.NAME_PATTERNS, ["o_orderkey"], V.NAME_OVERRIDES),
        monadic.inequality_mean(gini, V.NAME_PATTERNS, V.NAME_OVERRIDES),
        monadic.premium_mean(premium, v.crosswalk(), V.CODE_OVERRIDES),
    ]


@query
def unify_indicators(v: Views) -> DataFrame:
    return rounded(monadic.unify_indicators(v.panel().select("COWcode", "year"), *economics(v)), 7)


def episodes(v: Views) -> DataFrame:
    """Episode ids per unit-year, present in some years only."""
    u, y, n = F.col("u"), F.col("y"), F.col("n")
    return v.measures().select(
        u.alias("country_id"),
        y.alias("year"),
        F.concat(F.lit("x"), u.cast("string")).alias("country_name"),
        F.when((n + u) % 3 == 0, paste_id(u, y)).alias("aut_ep_id"),
        F.when((n + u) % 4 == 0, paste_id(u, y)).alias("dem_ep_id"),
        (n % 2).cast("int").alias("aut_founding_elec"),
        (n % 3).cast("int").alias("reg_trans"),
        (n % 5).cast("int").alias("row_regtrans"),
    )


def scores(v: Views) -> DataFrame:
    panel = v.panel()
    return panel.select(
        F.col("COWcode").alias("country_id"),
        "year",
        "country_name",
        F.upper(F.substring("country_name", 1, 3)).alias("country_text_id"),
        "COWcode",
        *SCORES[:3],
        F.col("v2x_corr").alias("v2x_corr_codelow"),
        F.col("v2x_corr").alias("v3aut_old"),
        F.col("v2x_corr").alias("dem_share_sd"),
        F.col("v2x_corr").alias("e_boix"),
    )


@query
def base_panel(v: Views) -> DataFrame:
    return rounded(monadic.base_panel(scores(v), episodes(v), first_year=1996))


def complete_monad(v: Views) -> DataFrame:
    """All monadic modules in order, on the base panel."""
    v.land_links()
    panel = monadic.base_panel(scores(v), episodes(v)).withColumnRenamed("co_wcode", "COWcode")
    panel = monadic.dispute_monadic(panel, v.disputes())
    panel = with_bloc(v, panel)
    panel = stage(monadic.trade_dependence(panel, v.trade(), PARTNERS), "panel")
    panel = monadic.alliance_weighted(panel, v.alliances())
    panel = monadic.ideology_recode(panel, v.ideology())
    panel = monadic.unify_indicators(panel, *economics(v))
    panel = monadic.unified_index(panel)
    wave = F.col("year") % 3 == 0
    shares = v.panel().select("COWcode", "year", *[F.when(wave, F.col(c)).alias(c) for c in SHARES])
    yearly = monadic.share_series_yearly(shares, SHARES, start=V.FIRST_YEAR, end=V.LAST_YEAR)
    return monadic.merge_shares(panel, yearly)


@query
def monadic_master(v: Views) -> DataFrame:
    return rounded(complete_monad(v), 7)


@query
def unified_index(v: Views) -> DataFrame:
    panel = v.panel().select("COWcode", "year", "v2x_corr")
    panel = joins.key_join(panel, episodes(v).withColumnRenamed("country_id", "COWcode").drop("country_name"), ["COWcode", "year"])
    govern = monadic.indicator_panel(v.economy(), v.governance(), v.crosswalk(), V.CODE_OVERRIDES)
    panel = joins.key_join(panel, govern, ["COWcode", "year"])
    return rounded(monadic.unified_index(panel.withColumn("e_raw", F.lit(1))), 7)


# -- series ---------------------------------------------------------------------


def sparse_grid(v: Views) -> DataFrame:
    return grid.complete_grid(v.sparse_shares(), "COWcode", "year", V.FIRST_YEAR, V.LAST_YEAR)


@query
def grid_complete(v: Views) -> DataFrame:
    return rounded(sparse_grid(v))


@query
def interpolate_linear(v: Views) -> DataFrame:
    return rounded(series.interpolate(sparse_grid(v), "COWcode", "year", SHARES))


@query
def interpolate_ends(v: Views) -> DataFrame:
    return rounded(series.interpolate(sparse_grid(v), "COWcode", "year", SHARES, ends="constant"))


@query
def interpolate_pooled(v: Views) -> DataFrame:
    return rounded(series.interpolate_pooled(sparse_grid(v), "COWcode", "year", SHARES))


@query
def locf(v: Views) -> DataFrame:
    return rounded(series.carry_forward(sparse_grid(v), "COWcode", "year", SHARES))


@query
def locf_small_blocks(v: Views) -> DataFrame:
    """Carry-forward with blocks of four years: the path long series take."""
    return rounded(series.carry_forward(sparse_grid(v), "COWcode", "year", SHARES, step=4))


@query
def interpolate_ties(v: Views) -> DataFrame:
    """Several observations of a day count as their mean; days without one lie on the line."""
    days = v.table("orders").select(
        (F.col("o_custkey") % 50).alias("unit"), F.year("o_orderdate").alias("year"), (F.col("o_orderkey") % 97).cast("double").alias("x")
    )
    held = days.withColumn("x", F.when(F.col("year") % 2 == 1, F.col("x")))
    return rounded(series.interpolate(series.mean_of_ties(held, "unit", "year", ["x"]), "unit", "year", ["x"]))


@query
def share_series_yearly(v: Views) -> DataFrame:
    return rounded(monadic.share_series_yearly(v.sparse_shares(), SHARES, start=1994, end=2003))


@query
def share_series_anchored(v: Views) -> DataFrame:
    """The 1995 wave lies before the grid and still supports 1996 and 1997."""
    return rounded(monadic.share_series_yearly(v.sparse_shares(), SHARES, start=1996, end=2003, anchor=True))


# -- ranking and scaling --------------------------------------------------------


@query
def keep_first(v: Views) -> DataFrame:
    """First order per customer and year."""
    rows = v.table("orders").select("o_custkey", F.year("o_orderdate").alias("year"), "o_orderkey", "o_totalprice")
    return rounded(ranking.first_per_group(rows, ["o_custkey", "year"], ["o_orderkey"]), 2)


@query
def latest_per_group(v: Views) -> DataFrame:
    """Last order per nation and year; the day ties are settled by key."""
    rows = v.unit_orders().select("u", "y", "o_day", "o_orderkey")
    return ranking.latest_per_group(rows, ["u", "y"], "o_day", [F.col("o_orderkey").desc()])


@query
def zscore(v: Views) -> DataFrame:
    orders = v.table("orders").select("o_orderkey", "o_totalprice", F.lit(3.0).alias("constant"))
    return rounded(scaling.zscores(orders, {"o_totalprice": "z_price", "constant": "z_constant"}).drop("o_totalprice"))


@query
def above_mean(v: Views) -> DataFrame:
    return rounded(scaling.above_mean(v.table("orders").select("o_orderkey", "o_totalprice"), "o_totalprice"), 2)


@query
def grouped_quantiles(v: Views) -> DataFrame:
    return rounded(
        aggregates.exact_quantiles(v.table("lineitem"), ["l_returnflag"], "l_extendedprice", [0.0, 0.25, 0.5, 0.9, 1.0]), 4
    )


@query
def yearly_median(v: Views) -> DataFrame:
    orders = v.table("orders").select("o_orderkey", F.year("o_orderdate").alias("year"), "o_totalprice")
    return rounded(scaling.attach_medians(orders, ["year"], "o_totalprice", "median_price"), 4)


# -- pairs ------------------------------------------------------------------------


def spine(v: Views, collapse: str | None = None) -> DataFrame:
    v.land_links()
    trade = v.trade()
    overrides = {"NATION_13": None}
    codes = v.table("nation").select(F.col("n_name").alias("code"), F.col("n_nationkey").alias("unit"))
    return dyadic.dyad_spine(v.influence(), codes, v.disputes(), trade, overrides, collapse)


def profiled(v: Views) -> DataFrame:
    profile = dyadic.monad_profile(
        v.panel().withColumns({"mid_count_total": F.lit(1), "countrya": F.col("country_name")}).drop("country_name"), v.trade()
    )
    return dyadic.dyad_context(dyadic.monad_to_dyad(spine(v), stage(profile, "profile")))


def extreme(v: Views) -> DataFrame:
    columns = [*PAIR, "iso3a", "hihosta", "fatlev", "targeted_democracy", "hhi_import_b"]
    scored = [f"{c}_{side}" for c in ("v2x_libdem", "v2exl_legitideol") for side in ("a", "b")]
    return dyadic.ideology_extremity(v.contained(lambda: profiled(v).select(*columns, *scored), "dyads"))


def indexed(v: Views) -> DataFrame:
    return dyadic.revisionist_index(extreme(v), "z")


PAIR = ["COWcode_a", "COWcode_b", "year"]


@query
def dyad_spine(v: Views) -> DataFrame:
    return rounded(spine(v))


@query
def dyad_spine_collapsed(v: Views) -> DataFrame:
    return rounded(spine(v, "max"))


@query
def monad_to_dyad(v: Views) -> DataFrame:
    return rounded(profiled(v).drop("hhi_export_gap", "targeted_democracy", "islm_dist", "chrst_dist"))


@query
def dyad_context(v: Views) -> DataFrame:
    return rounded(profiled(v).select(*PAIR, "hhi_export_gap", "targeted_democracy", "islm_dist", "chrst_dist"))


@query
def all_pairs_dyads(v: Views) -> DataFrame:
    panel = v.panel().join(v.measures().select(F.col("u").alias("COWcode"), F.col("y").alias("year")), ["COWcode", "year"])
    return rounded(dyadic.all_pairs_dyads(panel, "COWcode", ["country_name"], ["v2x_libdem"]))


@query
def dyad_distance(v: Views) -> DataFrame:
    pairs = v.flows().select(F.col("a").alias("COWcode_a"), F.col("b").alias("COWcode_b"), F.col("y").alias("year"))
    return rounded(dyadic.dyad_distance(pairs, v.capitals(), before=2001), 3)


@query
def ideology_extremity(v: Views) -> DataFrame:
    return rounded(extreme(v).select(*PAIR, "global_med_ideol", "ideol_extremity_a", "ideol_extremity_b"))


@query
def index_raw(v: Views) -> DataFrame:
    index = dyadic.revisionist_index(extreme(v), "raw")
    return rounded(index.select(*PAIR, "dem_constraint_inv_a", "rev_potential_a", "rev_potential_b", "revisionism_distance"))


@query
def index_z(v: Views) -> DataFrame:
    columns = ["z_legit_a", "z_dem_a", "z_ext_a", "z_legit_b", "z_dem_b", "z_ext_b", "rev_potential_a", "rev_potential_b"]
    return rounded(indexed(v).select(*PAIR, *columns, "revisionism_distance"))


# -- leaders ----------------------------------------------------------------------


@query
def spells_to_unit_years(v: Views) -> DataFrame:
    held = spells.expand_spells(
        v.spells().withColumnsRenamed({"startdate": "start_date", "enddate": "end_date"}), "ccode", tie_break=["leadid"]
    )
    return held.select("ccode", "year", "leadid", "start_date", "end_date", "start_year", "end_year")


@query
def spells_to_unit_years_closed(v: Views) -> DataFrame:
    """Open and reversed spells run to the end of 2002."""
    held = spells.expand_spells(
        v.spells().withColumnsRenamed({"startdate": "start_date", "enddate": "end_date"}),
        "ccode",
        open_year=2002,
        close_open_spells=True,
        tie_break=["leadid"],
    )
    return held.select("ccode", "year", "leadid", "start_date", "end_date")


def leaders(v: Views) -> DataFrame:
    return stage(dyadic.leader_years(v.spells()), "leaders")


@query
def spell_tenure(v: Views) -> DataFrame:
    return leaders(v)


def led(v: Views) -> DataFrame:
    return dyadic.dyad_leaders(spine(v).select(*PAIR), leaders(v))


@query
def dyad_leaders(v: Views) -> DataFrame:
    return led(v)


@query
def leader_coverage(v: Views) -> DataFrame:
    return checks.leader_coverage(led(v))


@query
def leader_events(v: Views) -> DataFrame:
    return checks.leader_events(led(v))


@query
def leader_tenure_summary(v: Views) -> DataFrame:
    return rounded(checks.leader_tenure_summary(v.contained(lambda: led(v).select("leader_tenure_years_a", "leader_tenure_years_b"), "led")))


@query
def sample_rows(v: Views) -> DataFrame:
    return checks.sample_rows(led(v), unit=2, since=1999)


@query
def dyad_master(v: Views) -> DataFrame:
    """Spine, both profiles, context, standardised index and leaders in one plan."""
    master = dyadic.dyad_leaders(indexed(v), leaders(v))
    columns = ["hihosta", "fatlev", "targeted_democracy", "rev_potential_a", "rev_potential_b", "revisionism_distance"]
    more = ["leader_id_a", "leader_id_b", "leader_tenure_diff", "any_leader_new", "same_leader", "both_irregular_entry"]
    return rounded(master.select(*PAIR, *columns, *more))


# -- checks -----------------------------------------------------------------------


@query
def index_summary(v: Views) -> DataFrame:
    return rounded(checks.index_summary(stage(indexed(v).select(*checks.INDEX_COLUMNS), "index")))


@query
def missing_share(v: Views) -> DataFrame:
    return rounded(checks.missing_share(indexed(v), "rev_potential_a"))


@query
def regime_buckets(v: Views) -> DataFrame:
    return rounded(checks.regime_buckets(indexed(v)))


@query
def asymmetry(v: Views) -> DataFrame:
    return rounded(checks.asymmetry(indexed(v)))


@query
def corr_matrix(v: Views) -> DataFrame:
    return rounded(checks.leakage_correlations(indexed(v)))


@query
def corr_wide(v: Views) -> DataFrame:
    """Twenty measures of the items, with gaps, a constant and a near copy."""
    key = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    measures = {f"m{k}": F.when(key % 61 != k, F.col("l_quantity") * k + key % (k + 5)) for k in range(1, 17)}
    measures |= {"price": F.col("l_extendedprice"), "discount": F.col("l_discount"), "paid": F.col("l_extendedprice") * (1 - F.col("l_discount"))}
    rows = v.table("lineitem").select(*[c.cast("double").alias(name) for name, c in measures.items()], F.lit(0.1).alias("same"))
    return rounded(wide_correlations(rows, [*measures, "same"]))


@query
def dispersion(v: Views) -> DataFrame:
    return rounded(checks.component_dispersion(indexed(v)))


@query
def cond_corr(v: Views) -> DataFrame:
    return rounded(checks.conditional_correlation(stage(indexed(v).select("rev_potential_a", "hhi_import_b"), "index")))


@query
def distance_corr(v: Views) -> DataFrame:
    return rounded(checks.distance_correlation(indexed(v)))


@query
def top_distinct(v: Views) -> DataFrame:
    return rounded(checks.top_revisionists(indexed(v), year=1999))


def gappy_orders(v: Views) -> DataFrame:
    """Orders with the buyer's columns and with gaps of several sizes."""
    key = F.col("o_orderkey")
    orders = v.unit_orders()
    return orders.select(
        F.col("u").alias("COWcode"),
        F.col("y").alias("year"),
        F.when(key % 2 == 0, F.col("o_totalprice")).alias("half"),
        F.when(key % 4 != 0, F.col("o_totalprice")).alias("most"),
        F.when(key % 2 != 0, F.col("o_orderpriority")).alias("other_half"),
        F.lit(None).cast("string").alias("nothing"),
        F.col("o_orderstatus").alias("status"),
        F.when(key % 7 != 0, F.col("c_mktsegment")).alias("segment"),
    )


@query
def missing_profile(v: Views) -> DataFrame:
    return rounded(aggregates.missing_profile(gappy_orders(v), top=6))


@query
def coverage(v: Views) -> DataFrame:
    return aggregates.coverage(gappy_orders(v), ["most", "nothing", "status", "absent"])


@query
def freq_table(v: Views) -> DataFrame:
    return aggregates.frequency(gappy_orders(v), ["segment"])


@query
def freq_table_known(v: Views) -> DataFrame:
    return aggregates.frequency(gappy_orders(v), ["segment", "status"], include_null=False)


@query
def panel_extent(v: Views) -> DataFrame:
    return aggregates.panel_extent(gappy_orders(v), "COWcode", "year")


@query
def level_report(v: Views) -> DataFrame:
    typed = schema.as_category(gappy_orders(v), ["segment", "status", "year"])
    return schema.level_report(typed, ["segment", "status", "year", "absent"])


@query
def typed_features(v: Views) -> DataFrame:
    """Levels of categories: text kept, numbers truncated to integer labels, gaps as -1."""
    typed = schema.as_category(gappy_orders(v).withColumn("half", F.col("half") / 50000), ["half", "segment", "year"], fill_missing="-1")
    return schema.level_counts(typed, ["half", "segment", "year"])


@query
def contract_check(v: Views) -> DataFrame:
    pairs = v.disputes().withColumnsRenamed({"dyad_rolea": "w_a"}).drop("fatlev")
    return checks.schema_contract(pairs)


@query
def alias_rename(v: Views) -> DataFrame:
    renamed = schema.rename_aliases(v.disputes(), {"COWcode_a": ["statea", "ccode_a"], "COWcode_b": ["stateb"], "igos": ["igosa"]})
    return renamed.groupBy("COWcode_a", "COWcode_b").agg(F.count("*").alias("n"))


@query
def pattern_select(v: Views) -> DataFrame:
    items = schema.drop(v.table("lineitem"), schema.starts_with("l_ret", "L_LINES"), schema.contains("discount"), schema.ends_with("_tax"))
    picked = schema.keep(items, schema.any_of("l_orderkey", "nowhere"), schema.contains("linenumber"), schema.ends_with("price"))
    return rounded(schema.suffix_columns(picked, "_a", except_=["l_orderkey"]), 2)


@query
def clean_names(v: Views) -> DataFrame:
    messy = v.table("nation").select(
        F.col("n_nationkey").alias("COWcode"), F.col("n_name").alias("Country Name"), F.col("n_regionkey").alias("region (%)")
    )
    customers = v.table("customer").groupBy(F.col("c_nationkey").alias("COWcode")).agg(F.count("*").alias("nCustomers"))
    return schema.clean_names(joins.key_join(messy, customers, ["COWcode"]))


@query
def scalar_rules(v: Views) -> DataFrame:
    """Number parsing, ids with missing parts, half-even rounding and percent text on orders."""
    key = F.col("o_orderkey")
    text = F.when(key % 5 == 0, "abc").when(key % 5 == 1, "nan").when(key % 5 == 2, None).otherwise(key.cast("string"))
    gap = F.when(key % 3 != 0, F.col("o_custkey"))
    return v.table("orders").select(
        "o_orderkey",
        to_number(text).alias("number"),
        nan_to_null(F.when(key % 4 == 0, float("nan")).otherwise(F.col("o_totalprice"))).alias("price"),
        paste_id(key, gap).alias("pair_id"),
        paste_id(key, gap, missing="NA").alias("printed_id"),
        round_even((key % 1000) / 8, 2).alias("even"),
        percent_text((key % 1000) / 8).alias("percent"),
    )


# -- files ------------------------------------------------------------------------


def _scratch(v: Views, name: str) -> str:
    return scratch_path(v.spark, name)


@query
def csv_roundtrip(v: Views) -> DataFrame:
    """Written as text with NA for gaps, and read back with a schema."""
    path = _scratch(v, "csv")
    orders = gappy_orders(v).select("COWcode", "year", "most", "segment")
    tables.write_delimited(orders, path, sep="\t")
    back = tables.read_tab_separated(v.spark, path, "COWcode int, year int, most double, segment string")
    return rounded(back, 2)


@query
def typed_snapshot(v: Views) -> DataFrame:
    """Category columns survive a round trip: the rows read back, each with its level's stored count."""
    path = _scratch(v, "typed")
    tables.save_typed(schema.as_category(gappy_orders(v).drop("nothing"), ["segment", "status"]), path)
    rows = tables.load_typed(v.spark, path, ["segment", "status"]).select("COWcode", "year", "half", "segment", "status")
    levels = v.spark.read.parquet(f"{path}/levels").where("variable = 'segment'")
    return rounded(joins.key_join(rows, levels.select(F.col("level").alias("segment"), "n"), ["segment"]), 2)


def damaged_orders(v: Views) -> checked.Checked:
    """Orders landed as text, some lines with bad cells, some with too few or too many, and read with a quarantine."""
    path, key = _scratch(v, "damaged"), F.col("o_orderkey") % 50
    price = F.when(key.isin(0, 3), "bad").when(key == 4, "NA").when(key == 5, "").otherwise((F.col("o_orderkey") % 1000 / 8).cast("string"))
    day = F.when(key == 3, "never").otherwise(F.to_date("o_orderdate").cast("string"))
    cells = [F.col("o_orderkey").cast("string"), price, day]
    line = F.when(key == 1, F.concat_ws(",", *cells[:2])).when(key == 2, F.concat_ws(",", *cells, F.lit("more"))).otherwise(F.concat_ws(",", *cells))
    v.table("orders").select(line.alias("line")).write.text(path)
    return checked.read_checked(v.spark, path, "o_orderkey bigint, price double, day date", keep=True, header=False)


@query
def checked_rows(v: Views) -> DataFrame:
    """Lines with a bad cell stay, with NULL there; lines with a wrong number of cells do not."""
    return damaged_orders(v).rows


@query
def checked_quarantine(v: Views) -> DataFrame:
    """Every damaged line as it stands in its file, and why."""
    return damaged_orders(v).quarantine.select("line", F.array_join("problems", "; ").alias("problems"))


@query
def checked_counts(v: Views) -> DataFrame:
    """Lines, rejected lines and problems of all files."""
    counts = damaged_orders(v).counts
    return counts.agg(*[F.sum(c).alias(c) for c in ("n_lines", "n_rejected", "n_problems")])


@query
def first_in_source(v: Views) -> DataFrame:
    """Each customer's first order in the files' order: folders by year, and within a year from the last key to the first."""
    path = _scratch(v, "by_year")
    orders = v.table("orders").select("o_custkey", "o_orderkey", F.year("o_orderdate").alias("year"))
    orders.repartition("year").sortWithinPartitions("year", F.desc("o_orderkey")).write.partitionBy("year").parquet(path)
    return ranking.first_in_source(v.spark.read.schema(orders.schema).parquet(path), ["o_custkey"])


@query
def observed_counts(v: Views) -> DataFrame:
    """What dropping incomplete rows and a join leave out, reported by the run that does it."""
    complete, dropped = observed.drop_missing(gappy_orders(v), ["most", "segment"])
    rich = v.table("nation").select(F.col("n_nationkey").alias("COWcode"), "n_name").where("n_regionkey < 3")
    joined, matched = observed.observed_join(complete, rich, ["COWcode"])
    stage(joined, "observed")
    rows = [("dropped", n, x) for n, x in dropped.get.items()] + [("matched", n, x) for n, x in matched.get.items()]
    return schema.inline_table(v.spark, "step string, measure string, n bigint", rows)


@query
def read_from_tree(v: Views) -> DataFrame:
    """Files of one name in any folder below a root, others left alone."""
    root = _scratch(v, "tree")
    orders = v.table("orders").select("o_orderkey", "o_orderstatus", F.year("o_orderdate").alias("year"))
    orders.withColumn("of", F.col("year")).write.partitionBy("of").option("header", True).csv(root)
    orders.write.json(f"{root}/other")
    return tables.read_from_tree(v.spark, root, "part-*.csv", "o_orderkey bigint, o_orderstatus string, year int")


def _move_part(v: Views, folder: str, target: str) -> None:
    """The only part file of ``folder`` under another name."""
    paths = v.spark._jvm.org.apache.hadoop.fs.Path
    files = paths(folder).getFileSystem(v.spark._jsc.hadoopConfiguration())
    (part,) = [f.getPath() for f in files.globStatus(paths(f"{folder}/part-*"))]
    files.rename(part, paths(target))


def landed_batches(v: Views) -> tuple[DataFrame, DataFrame]:
    """Indicators landed under their dotted names: one batch lacks a column, one has a broken file, one has neither."""
    root = _scratch(v, "batches")
    economy = v.economy()
    economy.where("year < 1996").write.parquet(f"{root}/early")
    economy.where("year between 1996 and 1997").drop("SP.POP.TOT").write.parquet(f"{root}/ragged")
    nan = F.when(F.col("year") % 2 == 0, float("nan")).otherwise(F.col("`NY.GDP.PCAP.PP.KD`"))
    economy.where("year > 1997").withColumn("NY.GDP.PCAP.PP.KD", nan).coalesce(1).write.parquet(f"{root}/broken")
    economy.where("year > 1997").withColumn("NY.GDP.PCAP.PP.KD", nan).write.parquet(f"{root}/late")
    economy.select("iso2c").coalesce(1).write.text(f"{root}/text")
    _move_part(v, f"{root}/text", f"{root}/broken/part-damaged.parquet")
    v.table("nation").select("n_nationkey").write.parquet(f"{root}/foreign")
    wanted = {"iso2c": "string", "year": "int", "NY.GDP.PCAP.PP.KD": "double", "SP.POP.TOT": "double"}
    names = ["early", "ragged", "broken", "late", "foreign", "absent"]
    return tables.read_batches(v.spark, {n: f"{root}/{n}" for n in names}, wanted, fmt="parquet")


@query
def batch_rows(v: Views) -> DataFrame:
    rows, _ = landed_batches(v)
    return rounded(rows.withColumnsRenamed({"NY.GDP.PCAP.PP.KD": "gdp_pc", "SP.POP.TOT": "pop"}), 4)


@query
def batch_status(v: Views) -> DataFrame:
    _, status = landed_batches(v)
    return status.select("batch", "loaded", F.col("problem").isNotNull().alias("reported"))


@query
def saved_name_map(v: Views) -> DataFrame:
    """The stored map from original to clean names of an indicator table."""
    path = _scratch(v, "names")
    tables.save_name_map(v.economy(), path)
    return v.spark.read.parquet(path)


@query
def finite_values(v: Views) -> DataFrame:
    """Infinite and missing values become NULL."""
    key = F.col("o_orderkey")
    wild = F.when(key % 5 == 0, float("inf")).when(key % 5 == 1, float("-inf")).when(key % 5 == 2, float("nan")).when(key % 5 == 3, F.col("o_totalprice"))
    orders = v.table("orders").select("o_orderkey", wild.alias("wild"))
    return rounded(orders.select("o_orderkey", finite_or_null("wild").alias("value"), F.col("wild").isNull().alias("was_null")), 2)


@query
def codebook(v: Views) -> DataFrame:
    """All codebook sections as one table, and the typed panel exported and read back."""
    u, y, n = F.col("u"), F.col("y"), F.col("n")
    panel = v.measures().select(
        u.alias("COWcode"),
        y.alias("year"),
        F.when(n % 3 != 0, (n % 2).cast("int")).alias("is_aut_episode"),
        (n % 4).cast("int").alias("gli_leader_ideology_num"),
        F.when(u % 2 == 0, n / 7).alias("fraser_bmp_score"),
    )
    path = _scratch(v, "codebook")
    tables.save_typed(checks.typed_panel(panel), path)
    typed = tables.load_typed(v.spark, path, ["is_aut_episode", "gli_leader_ideology_num"])
    sections = checks.codebook(panel) | {"export": typed.groupBy("is_aut_episode").agg(F.count("*").alias("n"))}
    rows = [
        df.select(F.lit(name).alias("section"), F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}).alias("entry"))
        for name, df in sections.items()
    ]
    return reduce(DataFrame.unionByName, rows)


@query
def staged_replace(v: Views) -> DataFrame:
    """A table is read, changed and written over itself."""
    path = _scratch(v, "replace")
    tables.replace_table(v.table("customer").select("c_custkey", "c_acctbal"), path)
    tables.replace_table(v.spark.read.parquet(path).where("c_acctbal > 0"), path)
    return rounded(v.spark.read.parquet(path), 2)


# -- model preparation ------------------------------------------------------------


@query
def clean_sequences_frame(v: Views) -> DataFrame:
    key = F.col("o_orderkey")
    raw = v.unit_orders().select(
        F.when(key % 17 == 0, "abc").otherwise(F.col("u").cast("string")).alias("COWcode"),
        F.col("y").cast("double").alias("year"),
        F.when(key % 13 != 0, (key % 100) / 100).alias("v2x_libdem"),
        F.when(key % 5 != 0, F.col("o_totalprice") - 100000).alias("unified_gdp_pc"),
        (F.col("o_totalprice") / 3).alias("unified_pop"),
        F.when(key % 2 == 0, (key % 50) - 10.0).alias("resource_rents"),
        F.when(key % 3 == 0, (key % 7) / 2).alias("gini_disp"),
        F.when(key % 4 != 0, (key % 9) / 4).alias("mid_max_hostility"),
        F.when(key % 6 != 0, F.col("o_orderpriority")).alias("is_petro_state"),
        key.alias("o_orderkey"),
    )
    return rounded(prepare_sequences_frame(raw))


@query
def split_by_time(v: Views) -> DataFrame:
    labelled = time_split(v.daily(), "day")
    return labelled.groupBy("split", "day").agg(F.count("*").alias("n"))


@query
def fill_daily_steps(v: Views) -> DataFrame:
    return rounded(fill_steps(v.daily(), "user_id", "day", ["n_events", "value"]))


def samples(v: Views) -> DataFrame:
    filled = fill_steps(v.daily(), "user_id", "day", ["value"])
    return sequence_windows(filled, "user_id", "day", ["value"])


@query
def sequence_samples(v: Views) -> DataFrame:
    return samples(v).select("user_id", "cut", "encoder_length", "decoder_length")


@query
def sequence_window_steps(v: Views) -> DataFrame:
    return rounded(sequence_steps(samples(v), "user_id", "day"))


@query
def sample_index(v: Views) -> DataFrame:
    """Every sample of the days with events, gaps and late short encoders included."""
    return sequence_index(v.daily(), "user_id", "day")


@query
def sample_steps(v: Views) -> DataFrame:
    """The same samples with their values, as rows."""
    daily = v.daily()
    store = stage(sequence_store(daily, "user_id", "day", ["value"]), "store")
    return rounded(sequence_steps(materialise(sequence_index(daily, "user_id", "day"), store, "user_id", "day"), "user_id", "day"))


@query
def training_chain(v: Views) -> DataFrame:
    """Prepared, split, cut and normalised without a look at the holdout; the last windows validate."""
    daily = v.daily().select("user_id", "day", F.when(F.col("user_id") % 7 != 0, F.col("value")).alias("value"))
    return rounded(sequences.training_chain(daily, "user_id", "day", ["value"], "value"), 5)


@query
def latest_window(v: Views) -> DataFrame:
    return rounded(latest_window_per_unit(v.daily(), "user_id", "day", ["value"]))


@query
def normalize_groups(v: Views) -> DataFrame:
    orders = v.unit_orders().select("u", "o_orderkey", (F.col("o_totalprice") / 70000).alias("target"))
    return rounded(group_normalizer(orders, "u", "target"))


@query
def pinball_loss(v: Views) -> DataFrame:
    orders = v.table("orders").select((F.col("o_totalprice") / 1000).alias("target"), "o_orderkey")
    orders = orders.withColumns({f"p_{i}": 500 * F.lit(q) + F.col("o_orderkey") % 10 for i, q in enumerate(QUANTILES)})
    return rounded(quantile_loss(orders, "target", {q: f"p_{i}" for i, q in enumerate(QUANTILES)}), 7)


def imputable(v: Views) -> DataFrame:
    """Items with gaps in three linked measures."""
    key = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    base = F.col("l_extendedprice") / 700 + F.col("l_quantity") * 2
    return v.table("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(key % 5 != 0, base + F.col("l_discount") * 10).alias("income"),
        F.when(key % 7 != 0, base / 2 + F.col("l_tax") * 10).alias("wealth"),
        F.when(key % 11 != 0, F.col("l_quantity") + F.col("l_tax")).alias("rents"),
        "l_quantity",
        "l_extendedprice",
    )


ITEM = ["l_orderkey", "l_linenumber"]


@query
def impute_chained(v: Views) -> DataFrame:
    """Two targets and a predictor with gaps, some of them NaN, in two rounds."""
    rows = imputable(v).withColumn("income", F.when(F.col("l_linenumber") == 3, float("nan")).otherwise(F.col("income")))
    done = chained_imputation(rows, ["income", "wealth"], ["rents"], ITEM, rounds=2, sample=False, ridge=0.0)
    return rounded(done.filled.select(*ITEM, "income", "wealth", "rents"), 5)


@query
def impute_sampled_kept(v: Views) -> DataFrame:
    """Drawn values go into the gaps and nowhere else."""
    targets = ["income", "wealth", "rents"]
    before = imputable(v).withColumns({f"had_{c}": F.col(c).isNotNull() for c in targets})
    rows = chained_imputation(before, targets, ["l_quantity", "l_extendedprice"], ITEM).filled
    shown = [F.when(F.col(f"had_{c}"), F.col(c)).alias(c) for c in targets]
    filled = sum((F.col(c).isNotNull().cast("int") for c in targets), F.lit(0)).alias("filled")
    return rounded(rows.select(*ITEM, *shown, filled), 7)


@query
def impute_deterministic(v: Views) -> DataFrame:
    """One target on two complete predictors: ordinary least squares."""
    done = chained_imputation(imputable(v), ["income"], ["l_quantity", "l_extendedprice"], ITEM, sample=False, ridge=0.0)
    logs = refresh_logs(done.filled, {"log_income": "income"})
    return rounded(logs.select(*ITEM, "income", "log_income"), 7)


@query
def impute_sampled(v: Views) -> DataFrame:
    """Three targets with gaps, ten rounds, drawn residuals; observed values stay."""
    done = chained_imputation(imputable(v), ["income", "wealth", "rents"], ["l_quantity", "l_extendedprice"], ITEM)
    return rounded(done.filled.select(*ITEM, "income", "wealth", "rents"), 7)


@query
def impute_report(v: Views) -> DataFrame:
    done = chained_imputation(imputable(v), ["income", "wealth"], ["rents", "l_quantity"], ITEM, rounds=2, sample=False)
    return done.report
