"""Complete unit-time grids and pair tables."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polyad.functions.values import paste_id
from polyad.operators.joins import key_join


PAIRS_IN_A_CELL = 4_000_000


def unit_grid(units: DataFrame, unit: str, time: str, start: int, end: int) -> DataFrame:
    """Every distinct unit at every time from ``start`` to ``end``."""
    times = F.sequence(F.lit(start), F.lit(end))
    return units.select(unit).where(F.col(unit).isNotNull()).distinct().select(unit, F.explode(times).alias(time))


def complete_grid(
    df: DataFrame, unit: str, time: str, start: int, end: int, anchor: bool = False
) -> DataFrame:
    """Put ``df`` on a full grid.

    ``anchor`` also keeps observations off the grid, so that they can support
    interpolation before the result is trimmed with :func:`trim`.
    """
    grid = unit_grid(df, unit, time, start, end)
    if anchor:
        grid = grid.unionByName(df.where(F.col(unit).isNotNull() & ~F.col(time).between(start, end)).select(unit, time))
    return key_join(grid, df, [unit, time], "left", null_safe=False)


def trim(df: DataFrame, time: str, start: int, end: int) -> DataFrame:
    return df.where(F.col(time).between(start, end))


def fill_time_gaps(df: DataFrame, unit: str, time: str, step: int = 4096) -> DataFrame:
    """Put each unit on every time between its first and last one.

    The range of a unit is first cut into blocks of ``step`` times which are
    spread over tasks before they are unrolled, so one long unit is not unrolled
    by one task.
    """
    reach = df.groupBy(unit).agg(F.min(time).alias("lo"), F.max(time).alias("hi"))
    blocks = reach.select(
        unit, "hi", F.explode(F.expr(f"sequence(lo, hi, cast({step} as {df.schema[time].dataType.simpleString()}))")).alias("from")
    )
    spread = blocks.repartition(F.col(unit), F.col("from"))
    steps = spread.select(unit, F.explode(F.sequence(F.col("from"), F.least(F.col("hi"), F.col("from") + (step - 1)))).alias(time))
    return key_join(steps, df, [unit, time], "left", null_safe=False)


def all_pairs(
    unit_times: DataFrame,
    unit: str = "unit",
    time: str = "year",
    attributes: Sequence[str] = (),
    candidates: DataFrame | None = None,
    cell: int = PAIRS_IN_A_CELL,
) -> DataFrame:
    """Every (unit, time) facing every other distinct unit: the directed pair table.

    Without ``candidates`` the output is quadratic in the number of units by
    definition. Rows then meet in equal cells joined by equality; there are as
    many as the numbers of rows ask for, each of about ``cell`` pairs, so that the
    work is spread evenly and neither side has to fit on one machine. With
    ``candidates``, a table of (unit_a, unit_b), only those pairs are built.
    The partner's own time is not looked at, so a partner may be absent then.
    """
    left = unit_times.select(unit, time, *attributes).distinct()
    right = unit_times.select(unit, *attributes).distinct()
    if candidates is not None:
        senders = left.select(F.col(unit).alias(f"{unit}_a"), F.col(time), *[F.col(c).alias(f"{c}_a") for c in attributes])
        receivers = right.select(F.col(unit).alias(f"{unit}_b"), *[F.col(c).alias(f"{c}_b") for c in attributes])
        wanted = candidates.select(f"{unit}_a", f"{unit}_b").distinct()
        pairs = key_join(key_join(senders, wanted, [f"{unit}_a"], "inner", null_safe=False), receivers, [f"{unit}_b"], "inner", null_safe=False)
        return _with_pair_ids(pairs, unit, time)
    sizes = unit_times.agg(F.approx_count_distinct(F.struct(unit, time)).alias("rows"), F.approx_count_distinct(unit).alias("units")).first()
    left_parts = right_parts = max(2, math.ceil(math.sqrt(sizes["rows"] * sizes["units"] / cell)))

    def part(parts: int, column: str):
        return F.pmod(F.xxhash64(column), F.lit(parts)).cast("int")

    senders = left.select(
        F.col(unit).alias(f"{unit}_a"),
        F.col(time),
        *[F.col(c).alias(f"{c}_a") for c in attributes],
        F.pmod(F.xxhash64(unit, time), F.lit(left_parts)).cast("int").alias("row_part"),
        F.explode(F.sequence(F.lit(0), F.lit(right_parts - 1))).alias("col_part"),
    )
    receivers = right.select(
        F.col(unit).alias(f"{unit}_b"),
        *[F.col(c).alias(f"{c}_b") for c in attributes],
        part(right_parts, unit).alias("col_part"),
        F.explode(F.sequence(F.lit(0), F.lit(left_parts - 1))).alias("row_part"),
    )
    return _with_pair_ids(senders.join(receivers, ["row_part", "col_part"]).drop("row_part", "col_part"), unit, time)


def _with_pair_ids(pairs: DataFrame, unit: str, time: str) -> DataFrame:
    a, b = f"{unit}_a", f"{unit}_b"
    return pairs.where(F.col(a) != F.col(b)).withColumns(
        {"dyad_id": paste_id(a, b), "dyad_year_id": paste_id(a, b, time)}
    )
