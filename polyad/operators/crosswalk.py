"""Mapping source codes and names to one unit code."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from polyad.operators.joins import key_join
from polyad.session import stage


def override(source: Column, overrides: Mapping[str, Any], otherwise: Column, dtype: str) -> Column:
    """Overrides come first, and may map to NULL on purpose."""
    if not overrides:
        return otherwise
    branches = iter(overrides.items())
    key, value = next(branches)
    expr = F.when(source == F.lit(key), F.lit(value).cast(dtype))
    for key, value in branches:
        expr = expr.when(source == F.lit(key), F.lit(value).cast(dtype))
    return expr.otherwise(otherwise)


def map_codes(
    df: DataFrame,
    code: str,
    crosswalk: DataFrame,
    overrides: Mapping[str, Any] | None = None,
    into: str = "unit",
    crosswalk_code: str = "code",
    crosswalk_unit: str = "unit",
) -> DataFrame:
    """Exact code lookup; an override beats the table, also when it says NULL."""
    dtype = crosswalk.schema[crosswalk_unit].dataType.simpleString()
    lookup = crosswalk.select(F.col(crosswalk_code).alias("__code"), F.col(crosswalk_unit).alias("__unit"))
    joined = key_join(df, lookup, {code: "__code"}, "left", null_safe=False)
    return joined.withColumn(into, override(F.col(code), overrides or {}, F.col("__unit"), dtype)).drop("__unit")


def match_names(
    df: DataFrame,
    name: str,
    patterns: Sequence[tuple[str, int]],
    overrides: Mapping[str, int | None] | None = None,
) -> DataFrame:
    """One row per distinct name: (name, unit, n_matches, status).

    ``patterns`` is the code list's (regular expression, unit) pairs; each one
    becomes a precompiled predicate on the distinct names, so no name-by-pattern
    join is made. A name that fits several units is ambiguous and gets NULL.
    """
    # The text to match is an aggregate's result: later filters on the unit cannot
    # be pushed below it, where the patterns would run on every raw row.
    names = df.select(name).where(F.col(name).isNotNull()).groupBy(name).agg(F.max(name).alias("text"))
    hits = F.array_distinct(
        F.array_compact(F.array(*[F.when(F.col("text").rlike(regex), F.lit(unit)) for regex, unit in patterns]))
    )
    known = list(overrides or {})
    overridden = F.col(name).isin(known) if known else F.lit(False)
    only = F.when(F.size("hits") == 1, F.element_at("hits", 1))
    return names.select(name, hits.cast("array<int>").alias("hits")).select(
        name,
        override(F.col(name), overrides or {}, only, "int").alias("unit"),
        F.size("hits").alias("n_matches"),
        F.when(overridden, "override")
        .when(F.size("hits") == 0, "unmatched")
        .when(F.size("hits") > 1, "ambiguous")
        .otherwise("matched")
        .alias("status"),
    )


def map_names(
    df: DataFrame,
    name: str,
    patterns: Sequence[tuple[str, int]],
    overrides: Mapping[str, int | None] | None = None,
    into: str = "unit",
) -> DataFrame:
    """Attach the unit found by :func:`match_names` to every row.

    The matched names are staged: the join back then knows their size, and the
    patterns run once.
    """
    found = stage(match_names(df, name, patterns, overrides).select(name, "unit"), "names")
    lookup = found.select(F.col(name).alias("__name"), F.col("unit").alias(into))
    return key_join(df, lookup, {name: "__name"}, "left", null_safe=False)
