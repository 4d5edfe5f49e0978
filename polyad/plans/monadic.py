"""The unit-year panel, one module per source.

Every module takes the panel and one source table and returns the panel with
new columns. Source rows are reduced to the panel key before the join, so each
large source is shuffled once, after map-side aggregation.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from polyad.functions.values import (
    any_event,
    concentration,
    count_where,
    fill_with,
    first_available,
    flag,
    known_flag,
    partner_sum,
    recode,
    safe_ln,
    sentinel_to_null,
    sum_of,
    weighted_sum,
)
from polyad.operators.crosswalk import map_codes, map_names
from polyad.operators.grid import complete_grid, trim
from polyad.operators.joins import coerced_join, interval_member, key_join, violations
from polyad.operators.ranking import first_per_group
from polyad.operators.schema import (
    all_of,
    any_of,
    clean_name_map,
    clean_names,
    column_or,
    contains,
    drop,
    ends_with,
    ensure_columns,
    keep,
    rename_if_present,
    starts_with,
)
from polyad.operators.series import interpolate, interpolate_pooled
from polyad.plans.constants import (
    BASE_DROP_PREFIXES,
    BASE_DROP_SUFFIXES,
    BASE_KEEP_PARTS,
    BASE_TAGS,
    ECONOMY_INDICATORS,
    GOVERNANCE_INDICATORS,
    IDEOLOGY_CODES,
    INEQUALITY_NAME_OVERRIDES,
    ISO2_OVERRIDES,
    ISO3_OVERRIDES,
    RESOURCE_NAME_OVERRIDES,
    SHARE_COLUMNS,
    TRADE_PARTNERS,
)

KEY = ["COWcode", "year"]


def base_panel(
    scores: DataFrame,
    episodes: DataFrame,
    on: Sequence[str] = ("country_id", "year"),
    tags: Sequence[str] = tuple(BASE_TAGS),
    first_year: int = 1946,
) -> DataFrame:
    """Scores joined to episodes, names cleaned, listed and patterned columns kept.

    On a name clash the scores' column stays. The unit id is kept as ``country_id``.
    """
    joined = key_join(scores, episodes, list(on), collisions="keep_left")
    wanted = [clean for original, clean in clean_name_map(joined.columns) if original in tags]
    panel = keep(clean_names(joined), all_of(*wanted), contains(*BASE_KEEP_PARTS))
    panel = drop(panel, starts_with(*BASE_DROP_PREFIXES), ends_with(*BASE_DROP_SUFFIXES))
    return panel.where(F.col("year") >= first_year).distinct()


def dispute_monadic(panel: DataFrame, disputes: DataFrame, first_year: int = 1946, last_year: int = 2020) -> DataFrame:
    """Dispute counts and severity per unit-year; years without disputes are peace."""
    clean = disputes.where(F.col("year").between(first_year, last_year)).select(
        F.col("statea").alias("COWcode"),
        "year",
        "dyad_rolea",
        sentinel_to_null("hihosta", -9).alias("hostility"),
        sentinel_to_null("fatlev", -9).alias("fatality"),
    )
    per_unit = clean.groupBy(*KEY).agg(
        F.count("*").alias("mid_count_total"),
        count_where(F.col("dyad_rolea") == 1).alias("mid_count_initiated"),
        count_where(F.col("dyad_rolea") == 3).alias("mid_count_targeted"),
        F.max("hostility").alias("mid_max_hostility"),
        any_event(F.col("fatality") >= 4).alias("mid_high_fatality_event"),
        F.max("fatality").alias("mid_max_fatality_cat"),
        count_where(F.col("fatality") > 0).alias("mid_count_fatal_disputes"),
    )
    peace = dict.fromkeys([c for c in per_unit.columns if c not in KEY], 0) | {"mid_max_hostility": 1}
    return key_join(panel, per_unit, KEY).withColumns({c: fill_with(c, v) for c, v in peace.items()})


def bloc_membership(
    panel: DataFrame,
    roster: DataFrame,
    region: tuple[int, int] = (20, 200),
    eligible_from: int = 2004,
) -> DataFrame:
    """Eligibility by region and year, membership by roster interval."""
    low, high = region
    inside = (F.col("COWcode") > low) & (F.col("COWcode") < high)
    panel = panel.withColumn("alba_possible", flag(inside & (F.col("year") >= eligible_from)))
    return interval_member(panel, roster, "COWcode", "year", into="alba_member")


def membership_violations(panel: DataFrame, region_end: int = 200, eligible_from: int = 2004) -> DataFrame:
    """Members or eligible units outside the region, or before the bloc existed; expected empty."""
    either = (F.col("alba_member") == 1) | (F.col("alba_possible") == 1)
    found = panel.select("COWcode", "year", "alba_member", "alba_possible")
    return violations(
        found,
        outside_region=(F.col("COWcode") >= region_end) & either,
        before_start=(F.col("year") < eligible_from) & either,
    )


def trade_dependence(
    panel: DataFrame,
    trade: DataFrame,
    partners: Mapping[str, Sequence[int]] = TRADE_PARTNERS,
    first_year: int = 1946,
    last_year: int = 2020,
) -> DataFrame:
    """Concentration and named-partner dependence; units without trade stay NULL."""
    exports, imports = "RED_export_importance", "RED_import_importance"

    def side(prefix: str, share: str) -> list[Column]:
        return [
            partner_sum(share, "importer_cow", codes).alias(f"{prefix}_dep_{name}") for name, codes in partners.items()
        ]

    per_unit = (
        trade.where(F.col("year").between(first_year, last_year))
        .groupBy(F.col("exporter_cow").alias("COWcode"), "year")
        .agg(
            concentration(exports).alias("trade_export_hhi"),
            *side("exp", exports),
            concentration(imports).alias("trade_import_hhi"),
            *side("imp", imports),
        )
    )
    return key_join(panel, per_unit, KEY)


def concentration_by(trade: DataFrame, unit: str, share: str, into: str) -> DataFrame:
    """Concentration index per unit-year for the chosen focal side."""
    return trade.groupBy(F.col(unit).alias("COWcode"), "year").agg(concentration(share).alias(into))


def alliance_weighted(panel: DataFrame, alliances: DataFrame, score: str = "v2x_libdem", first_year: int = 1946) -> DataFrame:
    """Pact counts, and pacts with partners scoring below 0.5; units without pacts get 0."""
    regimes = panel.select(
        F.col("COWcode").alias("stateB"), "year", flag(F.col(score) < 0.5).alias("autocratic_partner")
    )
    pacts = alliances.select("stateA", "stateB", "year", "defense", "offense", "nonagg", "consul")
    weighted = key_join(pacts.where(F.col("year") >= first_year), regimes, ["stateB", "year"])
    totals = []
    for pact in ("defense", "offense", "nonagg"):
        totals.append(sum_of(pact).alias(f"atop_{pact}_total"))
        totals.append(weighted_sum(pact, "autocratic_partner").alias(f"atop_{pact}_with_auto"))
    totals.append(sum_of("consul").alias("atop_consul_total"))
    per_unit = weighted.groupBy(F.col("stateA").alias("COWcode"), "year").agg(*totals)
    filled = {c: fill_with(c, 0) for c in per_unit.columns if c not in KEY}
    return key_join(panel, per_unit, KEY).withColumns(filled)


def ideology_recode(panel: DataFrame, ideology: DataFrame) -> DataFrame:
    """Leader and head-of-government labels as codes, plus three leader dummies."""
    labels = ideology.where(F.col("country_code_cow").isNotNull()).select(
        F.col("country_code_cow").alias("COWcode"),
        "year",
        F.col("leader_ideology").alias("leader_ideology_raw"),
        F.col("hog_ideology").alias("hog_ideology_raw"),
    )
    coded = labels.withColumns(
        {
            "gli_leader_ideology_num": recode("leader_ideology_raw", IDEOLOGY_CODES, default=0),
            "gli_hog_ideology_num": recode("hog_ideology_raw", IDEOLOGY_CODES, default=0),
            **{f"is_{kind}_leader": flag(F.col("leader_ideology_raw") == kind) for kind in ("leftist", "rightist", "centrist")},
        }
    )
    filled = {c: fill_with(c, 0) for c in coded.columns if c.startswith(("gli_", "is_"))}
    return key_join(panel, coded, KEY).withColumns(filled)


# -- economic and governance lookups ------------------------------------------


def gdp_history(
    history: DataFrame, crosswalk: DataFrame, overrides: Mapping[str, int | None] = ISO3_OVERRIDES
) -> DataFrame:
    """Mean income and population per unit-year; population comes in thousands."""
    coded = map_codes(history, "countrycode", crosswalk, overrides, into="COWcode")
    return (
        coded.where(F.col("COWcode").isNotNull())
        .groupBy(*KEY)
        .agg(F.avg("gdppc").alias("maddison_gdp_pc"), F.avg(F.col("pop") * 1000).alias("maddison_pop"))
    )


def indicator_panel(
    economy: DataFrame,
    governance: DataFrame,
    crosswalk: DataFrame,
    overrides: Mapping[str, int | None] = ISO2_OVERRIDES,
    pooled: bool = False,
    empty_population: str = "null",
) -> DataFrame:
    """Two indicator families joined, mapped to units, reduced, governance interpolated.

    Interpolation runs per unit with constant ends. ``pooled`` uses one yearly
    curve for all units instead. ``empty_population="zero"`` makes a unit-year
    without any population value 0, which then hides the historical fallback.
    """
    economy = rename_if_present(economy, ECONOMY_INDICATORS)
    economy = ensure_columns(economy, dict.fromkeys(ECONOMY_INDICATORS.values(), "double"))
    governance = rename_if_present(governance, GOVERNANCE_INDICATORS)
    governance = ensure_columns(governance, dict.fromkeys(GOVERNANCE_INDICATORS.values(), "double"))
    family = list(GOVERNANCE_INDICATORS.values())
    joined = key_join(economy, governance.select("iso2c", "year", *family), ["iso2c", "year"])
    coded = map_codes(joined, "iso2c", crosswalk, overrides, into="COWcode")
    reduced = (
        coded.where(F.col("COWcode").isNotNull())
        .groupBy(*KEY)
        .agg(
            F.avg("gdp_pc").alias("wdi_gdp_pc"),
            sum_of("pop", empty=empty_population).alias("wdi_pop"),
            F.avg("resource_rents").alias("resource_rents"),
            *[F.avg(c).alias(c) for c in family],
        )
    )
    if pooled:
        return interpolate_pooled(reduced, "COWcode", "year", family)
    return interpolate(reduced, "COWcode", "year", family, ends="constant")


def resource_wealth(
    resources: DataFrame,
    patterns: Sequence[tuple[str, int]],
    order: Sequence[Column | str],
    overrides: Mapping[str, int | None] = RESOURCE_NAME_OVERRIDES,
) -> DataFrame:
    """Oil and gas value with a >100 flag; the first row per unit-year under ``order``."""
    coded = map_names(resources, "cty_name", patterns, overrides, into="COWcode").where(F.col("COWcode").isNotNull())
    first = first_per_group(coded, KEY, order)
    value = F.col("oil_gas_valuePOP_2014")
    return first.select(*KEY, value.alias("oil_gas_pop"), known_flag(value > 100).alias("is_petro_state_ross"))


def inequality_mean(
    inequality: DataFrame,
    patterns: Sequence[tuple[str, int]],
    overrides: Mapping[str, int | None] = INEQUALITY_NAME_OVERRIDES,
) -> DataFrame:
    coded = map_names(inequality, "country", patterns, overrides, into="COWcode").where(F.col("COWcode").isNotNull())
    return coded.groupBy(*KEY).agg(F.avg("gini_disp").alias("gini_disp"))


def premium_mean(
    premiums: DataFrame, crosswalk: DataFrame, overrides: Mapping[str, int | None] = ISO3_OVERRIDES
) -> DataFrame:
    """Mean exchange premium; either spelling of the value column is accepted."""
    premiums = rename_if_present(premiums, {"black_market_exchange_rates": "black_market_exchange_rate"})
    coded = map_codes(premiums, "iso_code", crosswalk, overrides, into="COWcode").where(F.col("COWcode").isNotNull())
    return coded.groupBy(*KEY).agg(F.avg("black_market_exchange_rate").alias("fraser_bmp_score"))


def unify_indicators(panel: DataFrame, *lookups: DataFrame) -> DataFrame:
    """Join the economic lookups and settle one value per concept."""
    for lookup in lookups:
        panel = coerced_join(panel, lookup, KEY)
    panel = panel.withColumns(
        {
            "unified_gdp_pc": first_available("wdi_gdp_pc", "maddison_gdp_pc"),
            "unified_pop": first_available("wdi_pop", "maddison_pop"),
            "is_petro_state": first_available("is_petro_state_ross", known_flag(F.col("resource_rents") > 10)),
            "log_oil_gas_wealth": safe_ln(F.col("oil_gas_pop") + 1),
        }
    )
    return panel.withColumns({"log_gdp_pc": safe_ln("unified_gdp_pc"), "log_pop": safe_ln("unified_pop")})


def unified_index(panel: DataFrame) -> DataFrame:
    """Episode flags, one corruption measure, and removal of what they replace."""
    inverted = (F.lit(2.5) - F.col("corruption_control")) / 5
    panel = panel.withColumns(
        {
            "is_aut_episode": known_flag(F.col("aut_ep_id").isNotNull()),
            "is_dem_episode": known_flag(F.col("dem_ep_id").isNotNull()),
            "unified_corruption": first_available(column_or(panel, "v2x_corr"), inverted),
        }
    )
    helpers = ["maddison_gdp_pc", "maddison_pop", "wdi_gdp_pc", "wdi_pop", "is_petro_state_ross", "oil_gas_pop"]
    return drop(
        panel,
        any_of(*helpers, "corruption_control", "govt_effectiveness"),
        starts_with("e_", "aut_ep_", "dem_ep_"),
        contains("founding_elec"),
    )


def share_series_yearly(
    shares: DataFrame,
    columns: Sequence[str] = tuple(SHARE_COLUMNS),
    unit: str = "COWcode",
    start: int = 1946,
    end: int = 2016,
    anchor: bool = False,
) -> DataFrame:
    """Sparse shares on a yearly grid: interpolated, then carried forward.

    ``anchor`` lets observations before the grid support the first years.
    """
    series = shares.select(unit, "year", *columns)
    grid = complete_grid(series, unit, "year", start, end, anchor=anchor)
    return trim(interpolate(grid, unit, "year", columns, ends="carry"), "year", start, end)


def merge_shares(panel: DataFrame, shares: DataFrame | None) -> DataFrame:
    """Attach the share series when there is one."""
    return panel if shares is None else key_join(panel, shares, KEY)


def bloc_score_series(panel: DataFrame, score: str = "v2x_libdem") -> DataFrame:
    """Score series of member rows."""
    return panel.where(F.col("alba_member") == 1).select("country_name", "year", score)
