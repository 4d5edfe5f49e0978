"""Helpers shared by the text operators."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def remainder(key: str, modulus: int) -> Column:
    """crc32 of a key's text modulo ``modulus``; -1 for a NULL key, which therefore is never held out."""
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string")), F.lit(modulus)), F.lit(-1))


def map_batches(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """``function`` takes the rows of a partition, one tuple at a time, and yields column lists.

    A partition streams through: no more than an Arrow batch and the function's own buffer is held.
    """
    fields = df.sparkSession.createDataFrame([], schema).schema
    arrow = _arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in function(rows(batches)):
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, arrow.types, strict=True)], schema=arrow)

    return df.mapInArrow(tidy(run, function.__module__), fields)


def tidy(function: Callable, owner: str | None = None) -> Callable:
    """A task's function that hands freed memory back at its end, as a Python worker goes on to other tasks and stages.

    What the tasks of another owner, which is the function's module unless named, keep in the worker goes at its start.
    """
    owner = owner or function.__module__

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _take_over(owner)
        try:
            yield from function(batches)
        finally:
            _hand_back()

    return run


def _hand_back() -> None:
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only the GNU library has it
        ctypes.CDLL(None).malloc_trim(0)


def rows(batches: Iterator[pa.RecordBatch], step: int = 256) -> Iterator[tuple]:
    """Rows of Arrow batches; only ``step`` rows at a time become Python objects."""
    for batch in batches:
        for start in range(0, batch.num_rows, step):
            part = batch.slice(start, step)
            yield from zip(*(column.to_pylist() for column in part.columns), strict=True)


def by_size(batches: Iterator[pa.RecordBatch], column: str, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of Arrow batches with about ``most`` bytes of one string column each, or a single longer row."""
    import pyarrow.compute as pc

    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def blocks(source: Iterator[tuple], text_at: int, most_chars: int = 4_000_000, most_rows: int = 2000) -> Iterator[list[tuple]]:
    """Rows in lists that close once they hold ``most_chars`` of text or ``most_rows`` rows."""
    held, size = [], 0
    for row in source:
        held.append(row)
        size += len(row[text_at] or "")
        if size >= most_chars or len(held) >= most_rows:
            yield held
            held, size = [], 0
    if held:
        yield held


def columns(held: list[tuple]) -> list[list]:
    return [list(c) for c in zip(*held, strict=True)]


def worker_memory(name: str, make: Callable[[], object]) -> object:
    """An object that outlives a task in its Python worker, such as a loaded vocabulary or a bounded memo table.

    It only saves time: a worker that has lost it makes it again. It goes when a task of another module begins.
    """
    held = _memory()
    if name not in held:
        held[name] = make()
    return held[name]


def _memory() -> dict[str, object]:
    home = sys.modules.setdefault("_polyad_llm_memory", types.ModuleType("_polyad_llm_memory"))
    return home.__dict__.setdefault("held", {})


def _take_over(owner: str) -> None:
    held, home = _memory(), sys.modules["_polyad_llm_memory"].__dict__
    if held and home.get("owner") != owner:
        held.clear()
        gc.collect()
        _hand_back()
    home["owner"] = owner


def _arrow_schema(fields) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(fields)
