"""Enrichment joins with stated key, null and cardinality rules.

No function forces a broadcast: Spark broadcasts a side when its measured size
is under ``spark.sql.autoBroadcastJoinThreshold`` and shuffles otherwise, and
adaptive execution splits hot partitions of the large side. ``salt`` spreads a
hot key by hand where adaptive execution cannot.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from polyad.functions.values import as_column
from polyad.operators.intervals import covered
from polyad.operators.schema import suffix_columns

Keys = Sequence[str] | Mapping[str, str]

_RIGHT_KEY = "__right_key_{}"
_SALT = "__salt"


def key_pairs(on: Keys) -> list[tuple[str, str]]:
    return list(on.items()) if isinstance(on, Mapping) else [(k, k) for k in on]


def key_join(
    left: DataFrame,
    right: DataFrame,
    on: Keys,
    how: str = "left",
    null_safe: bool = True,
    collisions: str = "error",
    salt: int = 0,
    null_slots: int = 0,
) -> DataFrame:
    """Equi join that returns the left columns, then the right non-key columns.

    ``on`` lists shared key names, or maps left names to right names. With
    ``null_safe`` a NULL key matches a NULL key. Non-key names found on both
    sides raise, unless ``collisions="keep_left"`` drops the right ones.
    ``salt=n`` (inner and left joins) deals each left row to one of n slots by a
    hash of its values and copies the right side to all n. ``null_slots=n`` does so for
    left rows with a NULL key alone, and only right rows with one are copied: for
    tables where NULL keys are many and adaptive execution cannot split them.
    """
    pairs = key_pairs(on)
    right_keys = [r for _, r in pairs]
    payload = [c for c in right.columns if c not in right_keys]
    clash = [c for c in payload if c in left.columns]
    if clash and collisions != "keep_left":
        raise ValueError(f"columns on both sides of the join: {clash}")
    payload = [c for c in payload if c not in clash]

    right = right.select(
        *[as_column(r).alias(_RIGHT_KEY.format(i)) for i, r in enumerate(right_keys)], *[as_column(c) for c in payload]
    )
    left_columns = left.columns
    conditions: list[Column] = []
    for i, (name, _) in enumerate(pairs):
        l_key, r_key = as_column(name), F.col(_RIGHT_KEY.format(i))
        conditions.append(l_key.eqNullSafe(r_key) if null_safe else l_key == r_key)
    if salt:
        if how not in ("left", "inner"):
            raise ValueError("salted joins are left or inner joins")
        slot = F.pmod(F.xxhash64(*[as_column(c) for c in left_columns]), F.lit(salt)).cast("int")
        left = left.withColumn(_SALT, slot)
        right = right.withColumn("__right" + _SALT, F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
        conditions.append(F.col(_SALT) == F.col("__right" + _SALT))

    elif null_slots:
        if how not in ("left", "inner"):
            raise ValueError("NULL keys are dealt to slots in left or inner joins")
        left, right, same_slot = _spread_nulls(left, right, [l for l, _ in pairs], len(pairs), null_safe, null_slots)
        conditions += same_slot

    joined = left.join(right, reduce(lambda a, b: a & b, conditions), how)
    keys = {name: as_column(name) for name, _ in pairs}
    if how in ("right", "full", "outer"):
        keys = {name: F.coalesce(as_column(name), _RIGHT_KEY.format(i)).alias(name) for i, (name, _) in enumerate(pairs)}
    if how in ("left_anti", "left_semi", "anti", "semi"):
        return joined
    return joined.select(*[keys.get(c, as_column(c)) for c in left_columns], *[as_column(c) for c in payload])


def _spread_nulls(
    left: DataFrame, right: DataFrame, keys: Sequence[str], count: int, null_safe: bool, slots: int
) -> tuple[DataFrame, DataFrame, list[Column]]:
    """Deal left rows with a NULL key to slots, so that they do not meet in one task."""
    nullable = {f.name for f in left.schema.fields if f.nullable}
    loose = [as_column(k).isNull() for k in keys if k in nullable]
    if not loose:
        return left, right, []
    hashed = [f.name for f in left.schema.fields if not isinstance(f.dataType, T.MapType)]
    slot = F.pmod(F.xxhash64(*[as_column(c) for c in hashed]), F.lit(slots)).cast("int")
    left = left.withColumn(_SALT, F.when(reduce(lambda a, b: a | b, loose), slot).otherwise(0))
    one, all_slots = F.array(F.lit(0)), F.sequence(F.lit(0), F.lit(slots - 1))
    if null_safe:
        none = reduce(lambda a, b: a | b, [F.col(_RIGHT_KEY.format(i)).isNull() for i in range(count)])
        right = right.withColumn("__right" + _SALT, F.explode(F.when(none, all_slots).otherwise(one)))
    else:
        right = right.withColumn("__right" + _SALT, F.lit(0))
    return left, right, [F.col(_SALT) == F.col("__right" + _SALT)]


def events_join(left: DataFrame, events: DataFrame, on: Keys) -> DataFrame:
    """Left join of unique rows to many events each; NULL keys match.

    A plain left join keeps the event side whole per key. Here the events are
    the streamed side of an inner join, whose hot keys can be split (or which
    needs no shuffle when ``left`` is small), and left rows without an event are
    added from the reduced set of event keys. Both inputs are read twice.
    """
    pairs = key_pairs(on)
    to_left = {r: l for l, r in pairs}
    keys = [l for l, _ in pairs]
    payload = [c for c in events.columns if c not in to_left]
    renamed = events.select(*[as_column(r).alias(l) for r, l in to_left.items()], *[as_column(c) for c in payload])
    matched = key_join(renamed, left, keys, "inner")
    alone = key_join(left, renamed.select(*[as_column(k) for k in keys]).distinct(), keys, "left_anti")
    return matched.select(*[as_column(c) for c in [*left.columns, *payload]]).unionByName(alone, allowMissingColumns=True)


def coerce_keys(left: DataFrame, right: DataFrame, on: Keys) -> DataFrame:
    """Cast the right keys to the left key types; values that do not parse become NULL."""
    left_types = {f.name: f.dataType for f in left.schema.fields}
    right_types = {f.name: f.dataType for f in right.schema.fields}
    casts = {}
    for l_name, r_name in key_pairs(on):
        target = left_types[l_name]
        if right_types[r_name] == target:
            continue
        column = as_column(r_name)
        if isinstance(right_types[r_name], T.StringType) and isinstance(target, T.IntegralType):
            column = column.try_cast("double")
        casts[r_name] = column.try_cast(target)
    return right.withColumns(casts) if casts else right


def coerced_join(left: DataFrame, right: DataFrame, on: Keys, how: str = "left", **options) -> DataFrame:
    """:func:`key_join` after :func:`coerce_keys`."""
    return key_join(left, coerce_keys(left, right, on), on, how, **options)


def enrich_both_sides(
    pairs: DataFrame,
    monad: DataFrame,
    unit: str = "unit",
    time: str = "year",
    sides: Mapping[str, str] | None = None,
    null_safe: bool = True,
    salt: int = 0,
) -> DataFrame:
    """Attach the same unit-time table to both ends of every pair row.

    ``sides`` maps a suffix to the pair column that holds that side's unit.
    """
    for suffix, column in (sides or {"_a": "unit_a", "_b": "unit_b"}).items():
        side = suffix_columns(monad, suffix, except_=(unit, time))
        pairs = key_join(pairs, side, {column: unit, time: time}, "left", null_safe=null_safe, salt=salt)
    return pairs


def interval_member(
    panel: DataFrame,
    roster: DataFrame,
    unit: str,
    time: str,
    start: str = "start_year",
    end: str = "end_year",
    into: str = "member",
) -> DataFrame:
    """0/1 flag: is the unit inside one of its roster intervals at that time?

    Several intervals of one unit never multiply panel rows, and open ends (NULL or
    a far year) cost no more than others: see :mod:`polyad.operators.intervals`.
    """
    return covered(panel, roster, [unit], time, start, end, into)


# -- cardinality --------------------------------------------------------------


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row counts; empty when unique."""
    return df.groupBy(*[as_column(k) for k in keys]).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def fan_out(left: DataFrame, right: DataFrame, on: Keys) -> DataFrame:
    """One row: how many left rows a join would match, and how far it would multiply them."""
    pairs = key_pairs(on)
    matches = right.groupBy(*[as_column(r).alias(l) for l, r in pairs]).agg(F.count("*").alias("matches"))
    counted = key_join(left.select(*[as_column(l) for l, _ in pairs]), matches, [l for l, _ in pairs])
    return counted.agg(
        F.count("*").alias("left_rows"),
        F.count("matches").alias("matched_rows"),
        F.sum(F.coalesce("matches", F.lit(1))).alias("joined_rows"),
        F.max("matches").alias("max_matches"),
    )


def violations(df: DataFrame, **rules: Column) -> DataFrame:
    """Rows that break a rule, once per broken rule, labelled with its name."""
    broken = F.filter(
        F.array(*[F.when(condition, F.lit(name)) for name, condition in rules.items()]), lambda r: r.isNotNull()
    )
    return df.select("*", F.explode(broken).alias("rule"))


def require_empty(df: DataFrame, message: str) -> None:
    """Raise when a check returns a row."""
    found = df.take(1)
    if found:
        raise AssertionError(f"{message}: {found[0]}")


def merge_coverage(df: DataFrame, marker_a: str, marker_b: str) -> DataFrame:
    """How many rows found a partner on side a, on side b, and on both."""
    a, b = as_column(marker_a).isNotNull(), as_column(marker_b).isNotNull()
    return df.agg(
        F.count("*").alias("total"),
        F.count_if(a).alias("matched_a"),
        F.count_if(b).alias("matched_b"),
        F.count_if(a & b).alias("matched_both"),
    )
