"""Delimited files read with a quarantine: no cell becomes NULL unseen."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from polyad.functions.values import as_column, nan_to_null
from polyad.session import stage
from polyad.sources.ordered import with_source_order
from polyad.sources.tables import MISSING_TEXT

_LINE, _WHERE, _PROBLEMS = "__line", "__where", "__problems"


class Checked(NamedTuple):
    """``rows``: typed; ``quarantine``: ``file, block, row, line, problems``; ``counts``: ``file, n_lines, n_rejected, n_problems``."""

    rows: DataFrame
    quarantine: DataFrame
    counts: DataFrame


def read_checked(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str, sep: str = ",", keep: bool = False, **options
) -> Checked:
    """CSV in which every line is either whole or in quarantine, with its file, its place there and the reasons.

    Cells are read as text and cast once: a cell that holds text and does not parse as
    its column's type is a problem ``column: text``; a line with too few or too many cells is
    ``cells``. ``NA``, empty cells and NaN are missing, which is no problem. With ``keep``,
    lines with bad cells are in ``rows`` as well, with NULL there; lines with a wrong number of cells never are.
    The files are read once, into a stage table.
    """
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in wanted] + [T.StructField(_LINE, T.StringType())])
    reader = spark.read.schema(text).options(**{"header": True, "sep": sep, "nullValue": MISSING_TEXT, "mode": "PERMISSIVE"} | options)
    raw = with_source_order(reader.option("columnNameOfCorruptRecord", _LINE).csv(path), _WHERE)

    problems = [F.when(F.col(_LINE).isNotNull(), F.lit("cells"))]
    typed = []
    for field in wanted:
        cell = as_column(field.name)
        value = cell if isinstance(field.dataType, T.StringType) else F.trim(cell).try_cast(field.dataType)
        bad = cell.isNotNull() & (F.trim(cell) != "") & value.isNull() & F.col(_LINE).isNull()
        problems.append(F.when(bad, F.concat(F.lit(f"{field.name}: "), cell)))
        number = isinstance(field.dataType, T.DoubleType | T.FloatType)
        typed.append((nan_to_null(value) if number else value).alias(field.name))
    found = F.filter(F.array(*problems), lambda p: p.isNotNull())
    cells = F.concat_ws(sep, *[F.coalesce(as_column(f.name), F.lit("")) for f in wanted])
    line = F.when(F.size(found) > 0, F.coalesce(_LINE, cells))
    read = stage(raw.select(*typed, F.col(_WHERE), line.alias(_LINE), found.alias(_PROBLEMS)), "checked")

    good = F.size(_PROBLEMS) == 0
    rows = read.where(good | ~F.array_contains(_PROBLEMS, "cells") if keep else good).select(*[as_column(f.name) for f in wanted])
    quarantine = read.where(~good).select(f"{_WHERE}.file", f"{_WHERE}.block", f"{_WHERE}.row", F.col(_LINE).alias("line"), F.col(_PROBLEMS).alias("problems"))
    counts = read.groupBy(f"{_WHERE}.file").agg(F.count("*").alias("n_lines"), F.count_if(~good).alias("n_rejected"), F.sum(F.size(_PROBLEMS)).alias("n_problems"))
    return Checked(rows, quarantine, counts)
