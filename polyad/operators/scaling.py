"""Whole-table and per-group statistics written back to rows.

Whole-table statistics are scalar subqueries: one reduced row, never a window
over the unpartitioned table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from polyad.operators.aggregates import medians
from polyad.operators.joins import key_join
from polyad.session import stage


def table_statistics(df: DataFrame, columns: Sequence[str]) -> Column:
    """Struct column with ``mean_c`` and ``sd_c`` of the whole table."""
    stats = []
    for c in columns:
        stats += [F.avg(c).alias(f"mean_{c}"), F.stddev_samp(c).alias(f"sd_{c}")]
    return df.agg(F.struct(*stats)).scalar()


def zscores(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Standardise ``columns`` (source name to result name); sd 0 gives NULL.

    ``df`` is read twice, once for the statistics.
    """
    stats = F.col("__stats")
    scored = {
        into: F.try_divide(F.col(c) - stats[f"mean_{c}"], stats[f"sd_{c}"]) for c, into in columns.items()
    }
    return df.withColumn("__stats", table_statistics(df, list(columns))).withColumns(scored).drop("__stats")


def above_mean(df: DataFrame, column: str) -> DataFrame:
    """Rows whose value exceeds the mean of the whole table."""
    mean = df.agg(F.avg(column)).scalar()
    return df.where(F.col(column) > mean)


def attach_medians(df: DataFrame, by: Sequence[str], value: str, into: str) -> DataFrame:
    """Write each group's exact median back to its rows.

    ``df`` is read three times. The medians are staged, so that the join back
    broadcasts them when they are few and shuffles when they are not.
    """
    return key_join(df, stage(medians(df, by, value, into), "medians"), list(by))


def attach_attribute_medians(df: DataFrame, by: Sequence[str], value: str, into: str) -> DataFrame:
    """:func:`attach_medians` for an attribute that many rows share, such as a unit's score in a table of pairs.

    Rows are counted per distinct value first, in the map tasks. A group's distinct
    values, as many as there are units, then meet in one buffer. ``df`` is read twice.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("__n"))
    found = counts.groupBy(*by).agg(F.percentile(F.col(value).cast("double"), 0.5, F.col("__n")).alias(into))
    return key_join(df, stage(found, "medians"), list(by))
