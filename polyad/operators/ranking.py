"""One row per group, chosen by an explicit total order.

``row_number() == 1`` lets Spark prune each group inside every map task before
the shuffle (window group limit), so a hot group sends one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from polyad.functions.values import as_column
from polyad.sources.ordered import with_source_order


def first_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Keep the first row of each group under ``order``."""
    ordered = Window.partitionBy(*[as_column(k) for k in keys]).orderBy(*[as_column(o) for o in order])
    return df.withColumn("__rank", F.row_number().over(ordered)).where(F.col("__rank") == 1).drop("__rank")


def first_in_source(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keep the row of each group that comes first in the files; ``df`` is a scan, see :func:`with_source_order`."""
    return first_per_group(with_source_order(df, "__source"), keys, ["__source"]).drop("__source")


def latest_per_group(df: DataFrame, keys: Sequence[str], start: str, tie_break: Sequence[Column | str]) -> DataFrame:
    """Keep the row that started last; ties are settled by ``tie_break``."""
    return first_per_group(df, keys, [as_column(start).desc_nulls_last(), *tie_break])


def top_distinct(df: DataFrame, columns: Sequence[str], by: str, k: int) -> DataFrame:
    """The k largest distinct rows, as a sorted report; other columns settle ties."""
    ties = [as_column(c).asc() for c in columns if c != by]
    return df.select(*[as_column(c) for c in columns]).distinct().orderBy(as_column(by).desc_nulls_last(), *ties).limit(k)
