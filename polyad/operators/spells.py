"""Spells with a start and an end date, turned into unit-years."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from polyad.functions.values import flag, year_end
from polyad.operators.ranking import latest_per_group


def expand_spells(
    spells: DataFrame,
    unit: str = "unit",
    start: str = "start_date",
    end: str = "end_date",
    open_year: int = 2020,
    close_open_spells: bool = False,
    tie_break: Sequence[Column | str] = (),
) -> DataFrame:
    """One row per unit and year: the spell that holds on December 31.

    A spell without an end, or with an end year before its start year, is given
    the end year ``open_year``. Its end date is left alone, so the December 31
    rule still drops it; ``close_open_spells`` also moves the date to the end of
    ``open_year``. Of several spells the latest start wins.
    """
    start_year, raw_end = F.year(start), F.year(end)
    is_open = raw_end.isNull() | (raw_end < start_year)
    spells = spells.withColumns({"start_year": start_year, "end_year": F.when(is_open, open_year).otherwise(raw_end)})
    if close_open_spells:
        spells = spells.withColumn(end, F.when(is_open, F.make_date(F.lit(open_year), F.lit(12), F.lit(31))).otherwise(F.col(end)))
    years = spells.withColumn("year", F.explode(F.sequence("start_year", "end_year")))
    held = years.withColumn("dec31", year_end("year")).where(F.col("dec31").between(F.col(start), F.col(end)))
    return latest_per_group(held, [unit, "year"], start, tie_break)


def spell_tenure(unit_years: DataFrame, start: str = "start_date", born: str | None = None) -> DataFrame:
    """Tenure in years and days, first and last year flags, and age."""
    tenure = {
        "tenure_years": F.col("year") - F.col("start_year") + 1,
        "tenure_days": F.datediff("dec31", start),
        "first_year": flag(F.col("year") == F.col("start_year")),
        "last_year": flag(F.col("year") == F.col("end_year")),
    }
    if born is not None:
        tenure["age"] = F.col("year") - F.col(born)
    return unit_years.withColumns(tenure)
