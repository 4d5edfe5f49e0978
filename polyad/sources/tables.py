"""Readers and writers with explicit schemas and one rule for missing text."""

from __future__ import annotations

import io
import uuid
from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from polyad.functions.values import as_column, nan_to_null, to_number
from polyad.operators.schema import category_columns, clean_name_map, inline_table, level_counts, name_map_table
from polyad.session import stage

MISSING_TEXT = "NA"


def _nan_free(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    doubles = {f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType | T.FloatType)} - set(keep)
    if not doubles:
        return df
    return df.select(*[(nan_to_null(c) if c in doubles else as_column(c)).alias(c) for c in df.columns])


# -- readers ------------------------------------------------------------------


def read_delimited(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str, sep: str = ",", **options) -> DataFrame:
    """CSV with a header; ``NA``, empty cells and NaN are NULL."""
    reader = spark.read.schema(schema).options(header=True, sep=sep, nullValue=MISSING_TEXT, **options)
    return _nan_free(reader.csv(path))


def read_tab_separated(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str, **options) -> DataFrame:
    return read_delimited(spark, path, schema, sep="\t", **options)


def read_landed(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, keep_nan: Sequence[str] = ()
) -> DataFrame:
    """A table landed as Parquet; NaN becomes NULL.

    Filters on number columns do not reach the scan through that rule. Name the
    columns that hold no NaN, or shall keep it, in ``keep_nan`` and they do. A
    given schema saves the footer read.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    return _nan_free(reader.parquet(path), keep_nan)


def read_from_tree(spark: SparkSession, root: str, file_name: str, schema: T.StructType | str, sep: str = ",") -> DataFrame:
    """Read the files called ``file_name`` anywhere below ``root``."""
    return read_delimited(spark, root, schema, sep, recursiveFileLookup=True, pathGlobFilter=file_name)


def read_batches(
    spark: SparkSession, batches: Mapping[str, str], wanted: Mapping[str, str], fmt: str = "csv"
) -> tuple[DataFrame, DataFrame]:
    """Union of separately landed batches, and a status row per batch.

    Columns are matched by name, absent ones are NULL, values are parsed to the
    wanted types. Each batch is read whole into a stage table before it counts as
    loaded, so a batch of which any file breaks is absent as a whole and reported.
    """
    parts, status = [], []
    for name, path in batches.items():
        try:
            reader = spark.read.options(header=True, nullValue=MISSING_TEXT) if fmt == "csv" else spark.read
            raw = reader.option("ignoreCorruptFiles", False).option("ignoreMissingFiles", False).format(fmt).load(path)
            present = [c for c in wanted if c in raw.columns]
            if not present:
                raise ValueError("no wanted column found")
            parts.append(stage(raw.select(F.lit(name).alias("batch"), *[_typed(c, wanted[c]) for c in present]), "batch"))
        except (PySparkException, Py4JJavaError, ValueError) as error:
            status.append((name, False, type(error).__name__ + ": " + str(error).splitlines()[0]))
            continue
        status.append((name, True, None))
    report = inline_table(spark, "batch string, loaded boolean, problem string", status)
    if not parts:
        empty = ", ".join(["batch string", *[f"`{c}` {t}" for c, t in wanted.items()]])
        return spark.createDataFrame([], empty), report
    return union_by_name(parts, wanted), report


def _typed(name: str, dtype: str):
    numeric = dtype in ("double", "float", "int", "bigint")
    return (to_number(name, dtype) if numeric else as_column(name).try_cast(dtype)).alias(name)


def union_by_name(parts: Sequence[DataFrame], wanted: Mapping[str, str] | None = None) -> DataFrame:
    """Stack tables by column name; absent columns become NULL."""
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part, allowMissingColumns=True)
    if wanted:
        first = first.withColumns({c: F.lit(None).cast(t) for c, t in wanted.items() if c not in first.columns})
    return first


def stata_to_parquet(spark: SparkSession, source: str, target: str, schema: str, rows_per_chunk: int = 50_000) -> None:
    """Convert Stata files to one Parquet table, each file in its own task, chunk by chunk."""
    names = [f.name for f in T.StructType.fromDDL(schema).fields]

    def convert(files: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in files:
            for content in batch["content"]:
                with pd.read_stata(io.BytesIO(content), chunksize=rows_per_chunk, convert_categoricals=False) as chunks:
                    for chunk in chunks:
                        yield chunk.reindex(columns=names).replace({"": None})

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.dta").load(source).select("content")
    _nan_free(files.mapInPandas(convert, schema)).write.mode("overwrite").parquet(target)


# -- writers ------------------------------------------------------------------


def write_delimited(df: DataFrame, path: str, sep: str = ",") -> None:
    df.write.mode("overwrite").options(header=True, sep=sep, nullValue=MISSING_TEXT).csv(path)


def replace_table(df: DataFrame, path: str, fmt: str = "parquet", **options) -> None:
    """Overwrite a table that ``df`` itself may read from.

    The result is written beside the target first and swapped in afterwards, so
    the old files are there while they are read. The swap is two renames: a
    reader that opens the table between them finds none, and on an object store
    each rename copies. Use it with one writer and no readers at that moment.
    """
    spark = df.sparkSession
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    staging = jvm.org.apache.hadoop.fs.Path(f"{path}.staging-{uuid.uuid4().hex}")
    previous = jvm.org.apache.hadoop.fs.Path(f"{path}.previous-{uuid.uuid4().hex}")
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())

    writer = df.write.format(fmt).options(**options)
    if fmt == "csv":
        writer = writer.options(header=True, nullValue=MISSING_TEXT)
    writer.save(staging.toString())
    had_target = files.exists(target)
    if had_target and not files.rename(target, previous):
        raise OSError(f"cannot set aside {path}")
    if not files.rename(staging, target):
        if had_target:
            files.rename(previous, target)
        raise OSError(f"cannot put the new table at {path}")
    if had_target:
        files.delete(previous, True)


def save_name_map(df: DataFrame, path: str) -> None:
    """Persist the original-to-clean column names of ``df``."""
    name_map_table(df.sparkSession, clean_name_map(df.columns)).write.mode("overwrite").parquet(path)


def save_typed(df: DataFrame, path: str) -> None:
    """Snapshot that keeps category columns, with a level table beside the rows."""
    df.write.mode("overwrite").parquet(f"{path}/rows")
    categories = category_columns(df)
    if categories:
        level_counts(df, categories).write.mode("overwrite").parquet(f"{path}/levels")


def load_typed(spark: SparkSession, path: str, expect_categories: Sequence[str] = ()) -> DataFrame:
    """Read a snapshot back and check that its categories survived."""
    df = spark.read.parquet(f"{path}/rows")
    lost = [c for c in expect_categories if c not in category_columns(df)]
    if lost:
        raise ValueError(f"columns lost their category type: {lost}")
    return df
