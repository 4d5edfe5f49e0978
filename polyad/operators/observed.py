"""Counts that come from the run itself, not from a second scan.

Each function returns a table that reports while it is computed, and the report: an
``Observation``, whose ``get`` waits for the first action on the table and gives its counts.
An action that stops early (``limit``, ``take``) reports what it has seen.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from polyad.functions.values import as_column
from polyad.operators.joins import Keys, key_join

_FOUND = "__found"


def drop_missing(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, Observation]:
    """Rows without a NULL in ``columns``; reports ``n_rows``, ``n_dropped`` and ``missing_<column>``."""
    seen = Observation("dropped rows")
    missing = {c: as_column(c).isNull() for c in columns}
    either = reduce(lambda a, b: a | b, missing.values(), F.lit(False))
    counts = [F.count_if(m).alias(f"missing_{c}") for c, m in missing.items()]
    return df.observe(seen, F.count(F.lit(1)).alias("n_rows"), F.count_if(either).alias("n_dropped"), *counts).where(~either), seen


def observed_join(left: DataFrame, right: DataFrame, on: Keys, **options) -> tuple[DataFrame, Observation]:
    """:func:`key_join` from the left; reports ``n_rows`` and ``n_matched`` of the result."""
    seen = Observation("join coverage")
    joined = key_join(left, right.withColumn(_FOUND, F.lit(True)), on, "left", **options)
    joined = joined.observe(seen, F.count(F.lit(1)).alias("n_rows"), F.count(_FOUND).alias("n_matched"))
    return joined.drop(_FOUND), seen


def observed_coverage(df: DataFrame, marker_a: str, marker_b: str) -> tuple[DataFrame, Observation]:
    """``df`` itself; reports how many rows found a partner on side a, on side b, and on both."""
    seen = Observation("coverage of both sides")
    a, b = as_column(marker_a).isNotNull(), as_column(marker_b).isNotNull()
    counts = {"total": F.count(F.lit(1)), "matched_a": F.count_if(a), "matched_b": F.count_if(b), "matched_both": F.count_if(a & b)}
    return df.observe(seen, *[x.alias(n) for n, x in counts.items()]), seen
