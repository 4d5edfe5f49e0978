"""Session settings and stage tables in the shared folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and benchmarks; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("polyad")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")  # no call-site lookup per column
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "256k")  # keep all local cores busy
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .getOrCreate()
    )


def checkpoint_folder(spark: SparkSession) -> str:
    """Folder for stage tables, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of this machine: executors of
    a cluster could neither see it nor recover from it.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="polyad-")
        context.setCheckpointDir(folder)
    elif context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


class Stages:
    """The stage tables of a :func:`stages` block, and what of it shall outlive it."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.places: list = []

    def keep(self, df: DataFrame, name: str = "kept") -> DataFrame:
        """Write ``df`` as a stage table that belongs to the block around this one, or to the application."""
        around = _OPEN[: _OPEN.index(self)]
        return _written(df, scratch_path(self.spark, name, around[-1:]))


_OPEN: list[Stages] = []
_MARK = "_polyad_stage"  # the attribute by which a stage table's frame knows its files


def stage(df: DataFrame, name: str = "stage", last_use_of: Sequence[DataFrame] = ()) -> DataFrame:
    """Write ``df`` as a Parquet stage table in the shared folder and read it back.

    Use it between the steps of a long build whose result is read several times
    (both sides of a pair, a statistic and the rows it is written back to). The
    files outlive any executor, and later steps start from a scan whose size is
    known. They belong to the innermost :func:`stages` block and go at its end, or
    when the application ends. Stage tables whose last reader this is are named in
    ``last_use_of``, and go as soon as it is written.
    """
    staged = _written(df, scratch_path(df.sparkSession, name))
    release(*last_use_of)
    return staged


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    staged = df.sparkSession.read.schema(df.schema).parquet(path)
    setattr(staged, _MARK, path)
    return staged


def release(*frames: DataFrame) -> None:
    """Delete stage tables that nothing reads any more: what was built from them must have been written.

    Frames that are no stage tables (or were released before) are left alone.
    """
    for frame in frames:
        path = frame.__dict__.pop(_MARK, None)
        if path is None:
            continue
        place = _place(frame.sparkSession, path)
        _files(frame.sparkSession, place).delete(place, True)
        _files(frame.sparkSession, place).cancelDeleteOnExit(place)
        for held in _OPEN:
            held.places = [p for p in held.places if not p.equals(place)]


def scratch_path(spark: SparkSession, name: str, owner: Sequence[Stages] | None = None) -> str:
    """A new path in the shared folder, deleted at the end of the innermost :func:`stages` block or of the application."""
    path = f"{checkpoint_folder(spark)}/{name}-{uuid.uuid4().hex}"
    place = _place(spark, path)
    _files(spark, place).deleteOnExit(place)
    for held in _OPEN[-1:] if owner is None else owner:
        held.places.append(place)
    return path


def _place(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, place):
    return place.getFileSystem(spark._jsc.hadoopConfiguration())


@contextmanager
def stages(spark: SparkSession) -> Iterator[Stages]:
    """Stage tables written inside are deleted at the end, but for those written by ``keep``.

    A table that was built from stage tables cannot be read once they are gone.
    So the result of a block is written inside, or handed out by ``keep``::

        with stages(spark) as inside:
            result = inside.keep(build(...))
    """
    held = Stages(spark)
    _OPEN.append(held)
    try:
        yield held
    finally:
        _OPEN.remove(held)
        for place in held.places:
            _files(spark, place).delete(place, True)
            _files(spark, place).cancelDeleteOnExit(place)
