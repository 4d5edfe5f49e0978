"""Column helpers that fix one meaning for missing values.

Missing is always NULL. NaN never leaves the ingest helpers, an unknown
condition never picks a branch of :func:`ifelse`, and every aggregate states
what it returns for an empty input.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quoted(name: str) -> str:
    """A column name as Spark reads it whole, dots included."""
    return "`" + name.replace("`", "``") + "`"


def as_column(value: Column | str) -> Column:
    return F.col(quoted(value)) if isinstance(value, str) else value


def literal(value: Any) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


# -- conditions ---------------------------------------------------------------


def ifelse(condition: Column, yes: Any, no: Any) -> Column:
    """Two-way choice that stays NULL when the condition is unknown."""
    return F.when(condition, literal(yes)).when(~condition, literal(no))


def flag(condition: Column) -> Column:
    """0/1 flag, NULL when the condition is unknown."""
    return ifelse(condition, 1, 0)


def known_flag(condition: Column) -> Column:
    """0/1 flag that counts an unknown condition as 0."""
    return F.when(condition, 1).otherwise(0)


def cases(*branches: tuple[Column, Any], default: Any = None) -> Column:
    """First true branch wins; an unknown condition is not a match."""
    (condition, value), *rest = branches
    expr = F.when(condition, literal(value))
    for condition, value in rest:
        expr = expr.when(condition, literal(value))
    return expr.otherwise(literal(default))


def recode(column: Column | str, mapping: Mapping[Any, Any], default: Any = None) -> Column:
    """Value lookup; labels outside ``mapping`` (and NULL) get ``default``."""
    source = as_column(column)
    return cases(*((source == F.lit(old), new) for old, new in mapping.items()), default=default)


# -- missing values -----------------------------------------------------------


def first_available(*columns: Column | str) -> Column:
    return F.coalesce(*(as_column(c) for c in columns))


def fill_with(column: Column | str, value: Any) -> Column:
    return F.coalesce(as_column(column), literal(value))


def sentinel_to_null(column: Column | str, *sentinels: Any) -> Column:
    result = as_column(column)
    for sentinel in sentinels:
        result = F.nullif(result, F.lit(sentinel))
    return result


def nan_to_null(column: Column | str) -> Column:
    return F.nanvl(as_column(column), F.lit(None).cast("double"))


def finite_or_null(column: Column | str) -> Column:
    source = nan_to_null(column)
    return F.when(F.abs(source) != F.lit(float("inf")), source)


def to_number(column: Column | str, dtype: str = "double") -> Column:
    """Parse to a number; text that is not a number, and NaN, become NULL."""
    number = as_column(column).try_cast("double")
    parsed = F.when(~F.isnan(number), number)
    return parsed if dtype == "double" else parsed.try_cast(dtype)


# -- numbers ------------------------------------------------------------------


def safe_ln(column: Column | str) -> Column:
    x = as_column(column)
    return F.when(x > 0, F.ln(x))


def safe_ln1p(column: Column | str) -> Column:
    x = as_column(column)
    return F.when(x > -1, F.log1p(x))


def clip_lower(column: Column | str, lower: float = 0.0) -> Column:
    """Raise values below ``lower``; NULL stays NULL."""
    x = as_column(column)
    return F.when(x < lower, F.lit(lower)).otherwise(x)


def round_even(column: Column, digits: int) -> Column:
    return F.bround(column, digits)


def percent_text(column: Column, digits: int = 2) -> Column:
    """Half-even rounded percentage as text, without trailing zeros."""
    text = F.bround(column, digits).cast(T.DecimalType(9, digits)).cast("string")
    text = F.regexp_replace(F.regexp_replace(text, r"(\.[0-9]*?)0+$", "$1"), r"\.$", "")
    return F.concat(text, F.lit("%"))


def paste_id(*columns: Column | str, sep: str = "_", missing: str | None = None) -> Column:
    """Join values into a text id.

    ``missing=None`` makes the id NULL when a part is NULL, so that broken ids
    never collide; a text is printed in place of the missing part.
    """
    parts = [as_column(c).cast("string") for c in columns]
    if missing is not None:
        parts = [F.coalesce(p, F.lit(missing)) for p in parts]
    glued: list[Column] = []
    for part in parts:
        glued += [F.lit(sep), part] if glued else [part]
    return F.concat(*glued)


# -- dates --------------------------------------------------------------------


def year_start(year: Column | str) -> Column:
    return F.make_date(as_column(year), F.lit(1), F.lit(1))


def year_end(year: Column | str) -> Column:
    return F.make_date(as_column(year), F.lit(12), F.lit(31))


# -- aggregates with a stated empty value ------------------------------------


def sum_of(column: Column | str, empty: str = "zero") -> Column:
    """Sum without missing values; of nothing it is 0 or NULL."""
    if empty not in ("zero", "null"):
        raise ValueError(f"empty must be 'zero' or 'null', not {empty!r}")
    total = F.sum(as_column(column))
    return F.coalesce(total, F.lit(0)) if empty == "zero" else total


def count_where(condition: Column) -> Column:
    return F.count_if(condition)


def any_event(condition: Column) -> Column:
    """1 when the condition held at least once, else 0 (also for an empty group)."""
    return F.coalesce(F.max(flag(condition)), F.lit(0))


def concentration(share: Column | str, scale: float = 100.0) -> Column:
    """Sum of squared shares; shares run from 0 to ``scale``."""
    x = as_column(share) / F.lit(scale)
    return sum_of(x * x)


def partner_sum(value: Column | str, partner: Column | str, codes: Iterable[Any]) -> Column:
    """Sum of ``value`` over rows whose partner is one of ``codes``."""
    return sum_of(F.when(as_column(partner).isin(list(codes)), as_column(value)))


def weighted_sum(value: Column | str, weight: Column | str) -> Column:
    return sum_of(as_column(value) * as_column(weight))


def correlation(a: Column | str, b: Column | str) -> Column:
    """Pearson correlation over rows where both are known; NULL when one does not vary."""
    x, y = as_column(a), as_column(b)
    both = x.isNotNull() & y.isNotNull()
    x, y = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))
