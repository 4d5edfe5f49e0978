"""Filling gaps in per-unit series.

Rows are cut into blocks of ``step`` time values. Windows run inside
(unit, block), so no task ever holds a whole long unit. What a block needs from
its neighbours is put into it as one extra row at either edge before the only
large shuffle, and removed afterwards. Times must be unique within a unit, which
is checked; :func:`mean_of_ties` makes them so.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from polyad.operators.joins import key_join

STEP = 4096
_BEFORE, _ROW, _AFTER = 0, 1, 2


def mean_of_ties(df: DataFrame, unit: str, time: str, columns: Sequence[str]) -> DataFrame:
    """One row per unit and time: the mean of the values observed then."""
    return df.groupBy(unit, time).agg(*[F.avg(c).alias(c) for c in columns])


def _edges(rows: DataFrame, unit: str, time: str, columns: Sequence[str], ahead: bool) -> DataFrame:
    """One extra row per block edge: the nearest observation on the other side of it."""
    seen = {c: F.when(F.col(c).isNotNull(), F.col(time)) for c in columns}
    ends = []
    for c in columns:
        ends += [F.max(seen[c]).alias(f"last_t_{c}"), F.max_by(c, seen[c]).alias(f"last_v_{c}")]
        if ahead:
            ends += [F.min(seen[c]).alias(f"first_t_{c}"), F.min_by(c, seen[c]).alias(f"first_v_{c}")]
    summary = rows.groupBy(unit, "__block").agg(*ends)

    earlier = Window.partitionBy(unit).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy(unit).orderBy(F.col("__block").desc()).rowsBetween(Window.unboundedPreceding, -1)

    def edge(place: int, side: str, over) -> DataFrame:
        found = {
            f"__obs_{c}": F.struct(
                F.last(f"{side}_t_{c}", ignorenulls=True).over(over).alias("t"),
                F.last(f"{side}_v_{c}", ignorenulls=True).over(over).alias("v"),
            )
            for c in columns
        }
        carried = summary.select(unit, "__block", F.lit(place).alias("__place"), *[e.alias(n) for n, e in found.items()])
        known = {n: F.when(F.col(f"{n}.t").isNotNull(), F.col(n)) for n in found}
        return carried.withColumns(known).where(F.coalesce(*found).isNotNull())

    before = edge(_BEFORE, "last", earlier)
    return before.unionByName(edge(_AFTER, "first", later)) if ahead else before


def _with_neighbours(df: DataFrame, unit: str, time: str, columns: Sequence[str], step: int, ahead: bool) -> DataFrame:
    """Add ``__prev_c`` (and ``__next_c``): nearest observation at or before (after) each row."""
    rows = df.withColumn("__block", F.floor(F.col(time) / F.lit(step)).cast("bigint"))
    observed = {
        f"__obs_{c}": F.when(F.col(c).isNotNull(), F.struct(F.col(time).alias("t"), F.col(c).alias("v"))) for c in columns
    }
    padded = rows.withColumns({"__place": F.lit(_ROW), **observed}).unionByName(
        _edges(rows, unit, time, columns, ahead), allowMissingColumns=True
    )
    inside = Window.partitionBy(unit, "__block")
    forward = inside.orderBy("__place", time)
    backward = inside.orderBy(F.col("__place").desc(), F.col(time).desc())
    near = {f"__prev_{c}": F.last(f"__obs_{c}", ignorenulls=True).over(forward) for c in columns}
    if ahead:
        near |= {f"__next_{c}": F.last(f"__obs_{c}", ignorenulls=True).over(backward) for c in columns}
    row = F.col("__place") == _ROW
    near["__tie"] = F.lag(F.when(row, F.col(time))).over(forward) == F.col(time)
    message = F.concat(F.lit(f"{time} repeats within a {unit}: "), F.col(time).cast("string"))
    kept = F.when(row & F.col("__tie"), F.raise_error(message).cast("boolean")).otherwise(row)
    return padded.withColumns(near).where(kept).drop("__block", "__place", "__tie", *observed)


def _strip(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*[f"__{side}_{c}" for side in ("prev", "next") for c in columns])


def carry_forward(df: DataFrame, unit: str, time: str, columns: Sequence[str], step: int = STEP) -> DataFrame:
    """Last observation carried forward; leading gaps stay NULL."""
    near = _with_neighbours(df, unit, time, columns, step, ahead=False)
    return _strip(near.withColumns({c: F.col(f"__prev_{c}.v") for c in columns}), columns)


def interpolate(
    df: DataFrame,
    unit: str,
    time: str,
    columns: Sequence[str],
    ends: str = "null",
    step: int = STEP,
) -> DataFrame:
    """Linear interpolation between observed values; observed values never change.

    ``ends`` says what happens outside the observed range: ``"null"`` leaves the
    gap, ``"constant"`` repeats the nearest value on both ends, ``"carry"``
    repeats only the last value forward.
    """
    if ends not in ("null", "constant", "carry"):
        raise ValueError(f"unknown ends rule {ends!r}")
    near = _with_neighbours(df, unit, time, columns, step, ahead=True)
    filled = {}
    for c in columns:
        prev, nxt = F.col(f"__prev_{c}"), F.col(f"__next_{c}")
        span = nxt["t"] - prev["t"]
        line = prev["v"] + (nxt["v"] - prev["v"]) * (F.col(time) - prev["t"]) / F.nullif(span, F.lit(0))
        outside = {"null": [], "carry": [prev["v"]], "constant": [prev["v"], nxt["v"]]}[ends]
        filled[c] = F.coalesce(F.col(c).cast("double"), line, *outside)
    return _strip(near.withColumns(filled), columns)


def interpolate_pooled(df: DataFrame, unit: str, time: str, columns: Sequence[str]) -> DataFrame:
    """One curve for all units: yearly means, interpolated, constant at both ends.

    Every row takes the curve's value at its time, observed rows included.
    """
    means = df.groupBy(time).agg(*[F.avg(c).alias(c) for c in columns])
    curve = interpolate(means.withColumn("__pool", F.lit(0)), "__pool", time, columns, ends="constant")
    renamed = curve.select(time, *[F.col(c).alias(f"__curve_{c}") for c in columns])
    joined = key_join(df, renamed, [time], "left")
    return joined.withColumns({c: F.col(f"__curve_{c}") for c in columns}).drop(*[f"__curve_{c}" for c in columns])
