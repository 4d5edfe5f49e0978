"""Ready-made questions about a finished panel or pair table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polyad.functions.values import correlation, count_where, ifelse
from polyad.operators.aggregates import (
    correlation_matrix,
    coverage,
    dispersion,
    frequency,
    group_summary,
    missing_profile,
    panel_extent,
    six_number,
)
from polyad.operators.joins import merge_coverage
from polyad.operators.ranking import top_distinct
from polyad.operators.scaling import above_mean
from polyad.operators.schema import as_category, contract_report, level_report
from polyad.plans.constants import (
    BINARY_VARIABLES,
    DYAD_ALIASES,
    DYAD_CORE_COLUMNS,
    DYAD_OPTIONAL_COLUMNS,
    ORDINAL_VARIABLES,
)

INDEX_COLUMNS = ("rev_potential_a", "rev_potential_b", "revisionism_distance")


# -- pair table ---------------------------------------------------------------


def index_summary(dyads: DataFrame) -> DataFrame:
    return six_number(dyads, INDEX_COLUMNS)


def missing_share(df: DataFrame, column: str) -> DataFrame:
    """Percentage of rows without a value."""
    return df.agg(F.try_divide(F.count_if(F.col(column).isNull()) * 100.0, F.count("*")).alias("missing_percent"))


def regime_buckets(dyads: DataFrame, regime: str = "v2x_libdem_a", index: str = "rev_potential_a") -> DataFrame:
    """Index by regime type; rows without a regime score form their own group."""
    bucket = ifelse(
        F.col(regime) > 0.7, "Democracy", ifelse(F.col(regime) < 0.3, "Autocracy", "Mixed")
    )
    return group_summary(dyads.withColumn("regime_cat", bucket), ["regime_cat"], index)


def asymmetry(dyads: DataFrame) -> DataFrame:
    """Average and largest index gap of autocracies facing democracies."""
    facing = dyads.where((F.col("v2x_libdem_a") < 0.3) & (F.col("v2x_libdem_b") > 0.7))
    return facing.agg(F.avg("revisionism_distance").alias("avg_gap"), F.max("revisionism_distance").alias("max_gap"))


def leakage_correlations(dyads: DataFrame) -> DataFrame:
    return correlation_matrix(dyads, ["rev_potential_a", "v2x_libdem_a", "v2exl_legitideol_a", "ideol_extremity_a"])


def component_dispersion(dyads: DataFrame) -> DataFrame:
    return dispersion(dyads, ["v2exl_legitideol_a", "dem_constraint_inv_a", "ideol_extremity_a"])


def conditional_correlation(dyads: DataFrame, index: str = "rev_potential_a", other: str = "hhi_import_b") -> DataFrame:
    """Correlation with the partner's vulnerability among rows above the index mean."""
    return above_mean(dyads.select(index, other), index).agg(correlation(index, other).alias("correlation"))


def top_revisionists(dyads: DataFrame, year: int = 2022, k: int = 10, label: str = "iso3a") -> DataFrame:
    return top_distinct(dyads.where(F.col("year") == year), [label, "rev_potential_a"], "rev_potential_a", k)


def distance_correlation(dyads: DataFrame) -> DataFrame:
    """Index gap against regime gap."""
    gaps = dyads.withColumn("dem_dist", F.abs(F.col("v2x_libdem_a") - F.col("v2x_libdem_b")))
    return correlation_matrix(gaps, ["revisionism_distance", "dem_dist"])


# -- leader merge -------------------------------------------------------------


def leader_coverage(dyads: DataFrame) -> DataFrame:
    return merge_coverage(dyads, "leader_id_a", "leader_id_b")


def leader_events(dyads: DataFrame) -> DataFrame:
    """Rows with a new leader, and with an irregular entry, per side."""
    columns = ("leader_change_a", "leader_change_b", "irregular_entry_a", "irregular_entry_b")
    return dyads.agg(*[count_where(F.col(c) == 1).alias(c) for c in columns])


def leader_tenure_summary(dyads: DataFrame) -> DataFrame:
    return six_number(dyads, ["leader_tenure_years_a", "leader_tenure_years_b"])


def sample_rows(dyads: DataFrame, unit: int, since: int, k: int = 10) -> DataFrame:
    """The first k rows of one sender, by year and partner."""
    shown = ["year", "COWcode_a", "COWcode_b", "leader_name_a", "leader_tenure_years_a", "leader_name_b", "leader_tenure_years_b"]
    rows = dyads.where((F.col("COWcode_a") == unit) & (F.col("year") >= since)).select(*shown)
    return rows.orderBy(*[F.col(c).asc_nulls_last() for c in shown]).limit(k)


# -- codebook -----------------------------------------------------------------


def typed_panel(panel: DataFrame) -> DataFrame:
    """The panel with its binary and ordinal variables as categories."""
    return as_category(panel, [*BINARY_VARIABLES, *ORDINAL_VARIABLES])


def codebook(
    panel: DataFrame,
    unit: str = "COWcode",
    watched: Sequence[str] = ("fraser_bmp_score", "unified_corruption"),
    tabulated: Sequence[str] = ("is_aut_episode", "is_dem_episode", "gli_leader_ideology_num"),
) -> dict[str, DataFrame]:
    """All codebook sections, each a small table."""
    typed = typed_panel(panel)
    sections = {
        "extent": panel_extent(panel, unit, "year"),
        "levels": level_report(typed, [*BINARY_VARIABLES, *ORDINAL_VARIABLES]),
        "coverage": coverage(panel, watched),
        "missing": missing_profile(panel),
    }
    return sections | {f"table_{c}": frequency(typed, [c]) for c in tabulated if c in panel.columns}


def schema_contract(dyads: DataFrame) -> DataFrame:
    """Which contract columns exist before and after the alias rename."""
    contracts = {"core": DYAD_CORE_COLUMNS, "optional": DYAD_OPTIONAL_COLUMNS}
    return contract_report(dyads, contracts, DYAD_ALIASES)
