"""Directed pair-year tables: spine, both-side profiles, leaders, composite indices."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from polyad.functions.geo import haversine_km
from polyad.functions.values import flag, known_flag, sentinel_to_null, year_start
from polyad.operators.crosswalk import map_codes
from polyad.operators.grid import all_pairs
from polyad.operators.joins import enrich_both_sides, events_join, key_join
from polyad.operators.scaling import attach_attribute_medians, zscores
from polyad.operators.schema import drop, rename_aliases, starts_with
from polyad.operators.spells import expand_spells, spell_tenure
from polyad.plans.constants import LEADER_COLUMNS, MONAD_ALIASES
from polyad.plans.monadic import concentration_by
from polyad.session import stage

SIDES = {"_a": "COWcode_a", "_b": "COWcode_b"}
PAIR_KEY = ["year", "COWcode_a", "COWcode_b"]


def dyad_spine(
    influence: DataFrame,
    crosswalk: DataFrame,
    disputes: DataFrame,
    trade: DataFrame,
    overrides: Mapping[str, int | None] | None = None,
    collapse: str | None = None,
) -> DataFrame:
    """Pairs with both units known, plus their disputes and trade share.

    Several disputes of one pair-year give several rows; ``collapse="max"``
    first reduces them to one row with the worst values.
    """
    pairs = map_codes(influence, "iso3a", crosswalk, overrides, into="COWcode_a")
    pairs = map_codes(pairs, "iso3b", crosswalk, overrides, into="COWcode_b")
    pairs = pairs.where(F.col("COWcode_a").isNotNull() & F.col("COWcode_b").isNotNull())

    events = disputes.select("year", F.col("statea").alias("COWcode_a"), F.col("stateb").alias("COWcode_b"), "hihosta", "fatlev")
    if collapse == "max":
        events = events.groupBy(*PAIR_KEY).agg(
            *[F.max(sentinel_to_null(c, -9)).alias(c) for c in ("hihosta", "fatlev")]
        )
    shares = trade.select(
        "year",
        F.col("exporter_cow").alias("COWcode_a"),
        F.col("importer_cow").alias("COWcode_b"),
        "RED_export_importance",
    )
    # Staged: read twice below, and its size decides whether the events are shuffled at all.
    return events_join(stage(key_join(pairs, shares, PAIR_KEY), "pairs"), events, PAIR_KEY)


def monad_profile(
    monad: DataFrame,
    trade: DataFrame,
    leakage: Sequence[str] = ("mid_", "exp_dep_", "atop_"),
    aliases: Mapping[str, Sequence[str]] = MONAD_ALIASES,
) -> DataFrame:
    """Unit-year attributes fit for both sides: outcome columns out, concentration in, names settled."""
    clean = drop(monad, starts_with(*leakage), "trade_export_hhi", "trade_import_hhi")
    exports = concentration_by(trade, "exporter_cow", "RED_export_importance", "hhi_export")
    imports = concentration_by(trade, "importer_cow", "RED_import_importance", "hhi_import")
    key = ["COWcode", "year"]
    return rename_aliases(key_join(key_join(clean, exports, key), imports, key), aliases)


def monad_to_dyad(spine: DataFrame, profile: DataFrame, salt: int = 0) -> DataFrame:
    """Every pair row with the profile of both ends."""
    return enrich_both_sides(spine, profile, "COWcode", "year", SIDES, salt=salt)


def dyad_context(dyads: DataFrame) -> DataFrame:
    """Concentration gap, targeted-democracy flag and religious distances."""
    return dyads.withColumns(
        {
            "hhi_export_gap": F.col("hhi_export_a") - F.col("hhi_export_b"),
            "targeted_democracy": flag((F.col("v2x_libdem_b") > 0.5) & (F.col("v2x_libdem_a") < 0.3)),
            "islm_dist": F.abs(F.col("islmgenpct_a") - F.col("islmgenpct_b")),
            "chrst_dist": F.abs(F.col("chrstgenpct_a") - F.col("chrstgenpct_b")),
        }
    )


def all_pairs_dyads(panel: DataFrame, unit: str, ids: Sequence[str], attributes: Sequence[str]) -> DataFrame:
    """All ordered pairs of units per unit-year, with both sides' attributes of that year."""
    pairs = all_pairs(panel, unit, "year", attributes=ids)
    monad = panel.select(unit, "year", *attributes)
    return enrich_both_sides(pairs, monad, unit, "year", {"_a": f"{unit}_a", "_b": f"{unit}_b"})


def dyad_distance(
    dyads: DataFrame, capitals: DataFrame, unit: str = "COWcode", before: int = 2020
) -> DataFrame:
    """Capital distance in km on January 1 of each year.

    ``capitals`` has (unit, valid_from, valid_to, lat, lon). The place of each
    unit and date is settled first: of several capitals valid on a date, the one
    that became valid last. Pairs then look it up by unit and date, so no unit's
    rows meet in one task, and only the pairs asked for are measured.
    """
    dated = dyads.where(F.col("year") < before).withColumn("date", year_start("year"))
    ends = dated.select(F.col(f"{unit}_a").alias("__unit"), "date").unionByName(
        dated.select(F.col(f"{unit}_b").alias("__unit"), "date")
    )
    valid = (F.col("__unit") == F.col(unit)) & F.col("date").between(F.col("valid_from"), F.col("valid_to"))
    latest = F.max(F.struct("valid_from", "valid_to", "lat", "lon")).alias("place")
    places = ends.distinct().join(capitals, valid).groupBy("__unit", "date").agg(latest)
    places = stage(places.select("__unit", "date", "place.lat", "place.lon"), "places")
    for side in ("a", "b"):
        place = places.select(
            "date", F.col("__unit").alias(f"{unit}_{side}"), F.col("lat").alias(f"__lat_{side}"), F.col("lon").alias(f"__lon_{side}")
        )
        dated = key_join(dated, place, [f"{unit}_{side}", "date"], null_safe=False)
    km = haversine_km(F.col("__lat_a"), F.col("__lon_a"), F.col("__lat_b"), F.col("__lon_b"))
    return dated.select(*dyads.columns, "date", km.alias("dist_km"))


# -- leaders ------------------------------------------------------------------


def leader_years(
    spells: DataFrame,
    open_year: int = 2020,
    close_open_spells: bool = False,
    tie_break: Sequence[Column | str] = ("leadid",),
) -> DataFrame:
    """Leader in power on December 31 of each year, with tenure and age."""
    named = spells.select(
        F.col("ccode").alias("COWcode"),
        F.col("leader").alias("leader_name"),
        F.col("leadid").alias("leader_id"),
        F.col("startdate").alias("start_date"),
        F.col("enddate").alias("end_date"),
        F.col("entry").alias("entry_type"),
        F.col("exit").alias("exit_type"),
        "exitcode",
        F.col("posttenurefate").alias("post_tenure_fate"),
        "gender",
        F.col("yrborn").alias("year_born"),
        F.col("prevtimesinoffice").alias("previous_times"),
    )
    order = [F.col("leader_id") if column == "leadid" else column for column in tie_break]
    held = expand_spells(named, "COWcode", open_year=open_year, close_open_spells=close_open_spells, tie_break=order)
    tenure = spell_tenure(held, born="year_born").withColumnsRenamed(
        {c: f"leader_{c}" for c in ("tenure_years", "tenure_days", "first_year", "last_year", "age")}
    )
    return tenure.select("COWcode", "year", *LEADER_COLUMNS)


def dyad_leaders(dyads: DataFrame, leaders: DataFrame, salt: int = 0) -> DataFrame:
    """Leader columns on both sides, and the pair's leader variables."""
    both = enrich_both_sides(dyads, leaders, "COWcode", "year", SIDES, salt=salt)
    new_a, new_b = F.col("leader_first_year_a") == 1, F.col("leader_first_year_b") == 1
    irregular_a = known_flag(F.col("entry_type_a") == "Irregular")
    irregular_b = known_flag(F.col("entry_type_b") == "Irregular")
    return both.withColumns(
        {
            "leader_tenure_diff": F.abs(F.col("leader_tenure_years_a") - F.col("leader_tenure_years_b")),
            "both_leaders_new": flag(new_a & new_b),
            "any_leader_new": flag(new_a | new_b),
            "leader_change_a": F.col("leader_first_year_a"),
            "leader_change_b": F.col("leader_first_year_b"),
            "same_leader": known_flag(F.col("leader_id_a") == F.col("leader_id_b")),
            "both_female_leaders": flag((F.col("gender_a") == "F") & (F.col("gender_b") == "F")),
            "leader_age_diff": F.abs(F.col("leader_age_a") - F.col("leader_age_b")),
            "irregular_entry_a": irregular_a,
            "irregular_entry_b": irregular_b,
            "both_irregular_entry": irregular_a * irregular_b,
        }
    )


# -- composite indices --------------------------------------------------------


def ideology_extremity(dyads: DataFrame, score: str = "v2exl_legitideol") -> DataFrame:
    """Distance of both sides from the yearly median of side a's score."""
    dyads = attach_attribute_medians(dyads, ["year"], f"{score}_a", "global_med_ideol")
    return dyads.withColumns(
        {f"ideol_extremity_{s}": F.abs(F.col(f"{score}_{s}") - F.col("global_med_ideol")) for s in ("a", "b")}
    )


def revisionist_index(dyads: DataFrame, variant: str = "z", score: str = "v2exl_legitideol", regime: str = "v2x_libdem") -> DataFrame:
    """Mean of ideology, extremity and missing democratic constraint, and the pair's gap.

    ``variant="raw"`` averages the values themselves, ``"z"`` their whole-table
    z-scores per side. Needs :func:`ideology_extremity` columns.
    """
    if variant not in ("raw", "z"):
        raise ValueError(f"unknown variant {variant!r}")
    dyads = dyads.withColumns({f"dem_constraint_inv_{s}": 1 - F.col(f"{regime}_{s}") for s in ("a", "b")})
    parts = {s: [f"{score}_{s}", f"dem_constraint_inv_{s}", f"ideol_extremity_{s}"] for s in ("a", "b")}
    if variant == "z":
        labels = ("legit", "dem", "ext")
        dyads = zscores(dyads, {c: f"z_{label}_{s}" for s in parts for label, c in zip(labels, parts[s], strict=True)})
        parts = {s: [f"z_{label}_{s}" for label in labels] for s in parts}
    dyads = dyads.withColumns(
        {f"rev_potential_{s}": (F.col(x) + F.col(y) + F.col(z)) / 3 for s, (x, y, z) in parts.items()}
    )
    return dyads.withColumn("revisionism_distance", F.abs(F.col("rev_potential_a") - F.col("rev_potential_b")))
