"""The order of rows in their files, as a column that survives shuffles.

A table has no order of its own once it is repartitioned. What a script means by
"the first row" is the file's order, so it is noted at the scan, where it is known.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ORDER = "source_order"


def _file_fields(df: DataFrame) -> list[str]:
    """What is known of the files that ``df`` scans; nothing if it is no scan."""
    try:
        return df.select("_metadata").schema["_metadata"].dataType.names
    except AnalysisException:
        return []


def has_files(df: DataFrame) -> bool:
    """Does ``df`` come straight from the scan of files, so that a row's place in them is known?"""
    return bool(_file_fields(df))


def with_source_order(df: DataFrame, into: str = ORDER) -> DataFrame:
    """``df`` with (file, block, row) in ``into``; files are ordered by their path.

    ``df`` must be a scan, possibly filtered or projected. Parquet knows a row's number in
    its file. Other formats know the block of the file that a task reads: numbers given by the
    task ascend within the block, and blocks ascend within the file, so the order is the file's
    (rows of a filtered scan keep theirs). The numbers themselves may differ between runs then;
    the order does not.
    """
    fields = _file_fields(df)
    if not fields:
        raise ValueError("rows have a source order only where files are scanned")
    numbered = "row_index" in fields
    block = F.lit(0).cast("long") if numbered else F.col("_metadata.file_block_start")
    row = F.col("_metadata.row_index") if numbered else F.monotonically_increasing_id()
    return df.withColumn(into, F.struct(F.col("_metadata.file_path").alias("file"), block.alias("block"), row.alias("row")))


def source_place(df: DataFrame) -> list[Column] | None:
    """Two numbers that name a row of a Parquet scan, the same in every reading; None for other tables.

    The file is known by 64 bits of its path.
    """
    if "row_index" not in _file_fields(df):
        return None
    return [F.xxhash64("_metadata.file_path"), F.col("_metadata.row_index")]
