"""Joins of points in time with intervals, by equality on cells of a ladder.

An interval goes to the rung of the ladder whose cells are just longer than itself, so it
lies in at most two cells; a point looks its cell up on every rung in use. The join is
an equality on (keys, rung, cell) with ``between`` as the residual, so nothing is unrolled
a unit of time at a time: days, seconds and fractions cost what years cost, and a long
interval costs what a short one does. Intervals with an open end (NULL), and those longer
than the ladder, have a rung of their own with a single cell.

Both ends belong to the interval; one that ends before it starts holds nothing. A point
without a time or with a NULL key is in no interval.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from polyad.functions.values import as_column

BASE, RUNGS = 16, 14  # cells of rung k are BASE ** k units of time long
OPEN = -1
_RUNG, _CELL, _KEY, _FROM, _TO = "__rung", "__cell", "__key_{}", "__from", "__to"
_AT, _KNOWN, _POINT_CELL = "__at", "__known", "__point_cell"  # of points; unlike any name of the intervals' side


def _axis(value: Column, kind: T.DataType) -> Column:
    """A number that grows with time: days for dates, seconds for timestamps."""
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_seconds(value).cast("double")
    if isinstance(kind, T.TimestampNTZType):  # not by the session's zone, in which hours may repeat
        return F.unix_date(value.cast("date")) * 86400.0 + F.hour(value) * 3600 + F.minute(value) * 60 + F.second(value)
    if isinstance(kind, T.NumericType):
        return value.cast("double")
    raise TypeError(f"no times: {kind.simpleString()}")


def _cell(axis: Column, rung: int) -> Column:
    return F.floor(axis / float(BASE**rung)) if rung != OPEN else F.lit(0).cast("long")


def on_ladder(intervals: DataFrame, start: str, end: str) -> DataFrame:
    """``intervals`` with the rung and the cells of each, a row for each cell; empty ones are left out."""
    low, high = as_column(start), as_column(end)
    kind = intervals.schema[start].dataType
    a, b = _axis(low, kind), _axis(high, intervals.schema[end].dataType)
    closed = low.isNotNull() & high.isNotNull()
    rung = reduce(lambda rest, k: F.when(b - a < float(BASE**k), k).otherwise(rest), reversed(range(RUNGS)), F.lit(OPEN))
    held = intervals.where(~closed | (low <= high)).withColumns({_RUNG: F.when(closed, rung).otherwise(OPEN), _FROM: a, _TO: b})
    cells = F.lit(None).cast("array<long>")
    for k in range(RUNGS):
        cells = F.when(F.col(_RUNG) == k, F.array_distinct(F.array(_cell(F.col(_FROM), k), _cell(F.col(_TO), k)))).otherwise(cells)
    cells = F.coalesce(cells, F.array(F.lit(0).cast("long")))
    return held.withColumn(_CELL, F.explode(cells)).drop(_FROM, _TO)


def rungs_in_use(laddered: DataFrame) -> list[int]:
    """At most RUNGS + 1 numbers."""
    return sorted(r[0] for r in laddered.select(_RUNG).distinct().collect())


def _inside(time: Column, start: str, end: str) -> Column:
    low, high = as_column(start), as_column(end)
    return (low.isNull() | (low <= time)) & (high.isNull() | (time <= high)) & time.isNotNull()


def interval_join(points: DataFrame, intervals: DataFrame, on: Sequence[str], time: str, start: str, end: str, how: str = "inner") -> DataFrame:
    """Every point with every interval of its keys that it lies in: the points' columns, then the intervals' others.

    ``how="left"`` keeps points in no interval, with NULLs. ``intervals`` is read twice: stage it if it is costly.
    """
    if how not in ("inner", "left"):
        raise ValueError("interval joins are inner or left joins")
    payload = [c for c in intervals.columns if c not in on]
    clash = [c for c in payload if c in points.columns]
    if clash:
        raise ValueError(f"columns on both sides of the join: {clash}")
    laddered = on_ladder(intervals, start, end)
    rungs = rungs_in_use(laddered)
    right = laddered.select(*[as_column(k).alias(_KEY.format(i)) for i, k in enumerate(on)], *[as_column(c) for c in payload], F.col(_RUNG).alias("__right" + _RUNG), F.col(_CELL).alias("__right" + _CELL))
    axis = _axis(as_column(time), points.schema[time].dataType)
    asked = [F.struct(F.lit(k).alias(_RUNG), _cell(axis, k).alias(_CELL)) for k in rungs]
    left = points.where(as_column(time).isNotNull()).select("*", F.inline(F.array(*asked) if asked else F.expr(f"cast(array() AS array<struct<{_RUNG}:int,{_CELL}:bigint>>)")))
    same = [as_column(k) == F.col(_KEY.format(i)) for i, k in enumerate(on)]
    same += [F.col(c) == F.col("__right" + c) for c in (_RUNG, _CELL)]
    found = left.join(right, reduce(lambda a, b: a & b, same) & _inside(as_column(time), start, end), "inner")
    found = found.select(*[as_column(c) for c in [*points.columns, *payload]])
    if how == "inner":
        return found
    alone = covered(points, intervals, on, time, start, end, "__inside").where(F.col("__inside") == 0).drop("__inside")
    return found.unionByName(alone, allowMissingColumns=True)


def covered(points: DataFrame, intervals: DataFrame, on: Sequence[str], time: str, start: str, end: str, into: str = "member") -> DataFrame:
    """0/1: does the point lie in one of its keys' intervals? Rows are never multiplied, however many intervals hold them.

    One existence test for each rung in use. Rows with a NULL key are dealt out by a hash of the row.
    """
    laddered = on_ladder(intervals.select(*[as_column(c) for c in [*on, start, end]]), start, end)
    axis = _axis(as_column(time), points.schema[time].dataType)
    keys = {_KEY.format(i): _dealt(points, k) for i, k in enumerate(on)}
    known = reduce(lambda a, b: a & b, [as_column(k).isNotNull() for k in on])
    out, tests = points.withColumns(keys | {_AT: as_column(time), _KNOWN: known}), F.lit(False)
    for rung in rungs_in_use(laddered):
        own = out.withColumn(_POINT_CELL, _cell(axis, rung))
        side = laddered.where(F.col(_RUNG) == rung)
        side = side.toDF(*[f"__in_{i}" for i in range(len(side.columns))])
        at = dict(zip(laddered.columns, side.columns, strict=True))
        same = [F.col(at[k]) == F.col(_KEY.format(i)).outer() for i, k in enumerate(on)] + [F.col(at[_CELL]) == F.col(_POINT_CELL).outer()]
        met = side.where(reduce(lambda a, b: a & b, same) & _inside(F.col(_AT).outer(), at[start], at[end]) & F.col(_KNOWN).outer())
        out = own.select("*", met.exists().alias(f"__rung_{rung}")).drop(_POINT_CELL)
        tests = tests | F.col(f"__rung_{rung}")
    return out.select(*[as_column(c) for c in points.columns], F.when(tests, 1).otherwise(0).alias(into))


def _dealt(points: DataFrame, key: str) -> Column:
    """The key; for a NULL key some value by the row's hash, which a further condition keeps from meeting anything."""
    field = points.schema[key]
    if not field.nullable:
        return as_column(key)
    hashed = [as_column(f.name) for f in points.schema.fields if not isinstance(f.dataType, T.MapType | T.VariantType)]
    some = F.pmod(F.xxhash64(*hashed), F.lit(1 << 14))
    if isinstance(field.dataType, T.IntegerType | T.LongType | T.StringType | T.DoubleType):
        return F.coalesce(as_column(key), some.cast(field.dataType))
    return as_column(key)
