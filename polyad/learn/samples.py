"""An index of all samples, and the samples themselves only where they are asked for.

A sample is a unit, a first time and a length. The index holds nothing else, so it can
be counted, split, shuffled and drawn from without moving a single value. The
values lie once, in blocks of consecutive steps, and a sample is a slice of one block.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from polyad.functions.values import as_column
from polyad.learn.sequences import STEP, fill_steps
from polyad.operators.joins import key_join

BLOCK = 128


def _block(time: Column, step: int) -> Column:
    return F.floor(time / step).cast("bigint")


def sequence_index(
    df: DataFrame, unit: str, time: str, encoder: tuple[int, int] = (10, 20), decoder: tuple[int, int] = (1, 5), step: int = STEP
) -> DataFrame:
    """Every sample of a panel with gaps: (unit, start, length, encoder_length, decoder_length, cut).

    There is one sample from each observed time on, as long as it can be, and one up to
    each observed time that none of these ends at; both begin and end at observed times.
    What is longer than the shortest encoder goes to the decoder, up to its
    greatest length, and the rest to the encoder. Times are whole numbers, unique in a unit;
    rows without unit or time take no part.

    Rows near the edge of a block of ``step`` times are copied to the neighbour, so a long
    unit is spread over many tasks.
    """
    longest, shortest = encoder[1] + decoder[1], encoder[0] + decoder[0]
    if step < longest:
        raise ValueError("step must cover a whole sample")
    at = F.col("__time")
    rows = df.select(as_column(unit).alias("__unit"), as_column(time).cast("bigint").alias("__time")).dropna()
    near = F.sequence(_block(at - (longest - 1), step), _block(at + (longest - 1), step))
    ordered = Window.partitionBy("__unit", "__block").orderBy("__time")
    seen = rows.withColumn("__block", F.explode(near)).withColumns(
        {
            "__last": F.max("__time").over(ordered.rangeBetween(0, longest - 1)),
            "__first": F.min("__time").over(ordered.rangeBetween(1 - longest, 0)),
            "__next": F.min("__time").over(ordered.rangeBetween(1, longest - 1)),
        }
    )
    # The longest sample up to here also is the longest from its first time on, unless that reaches the next time.
    late = F.col("__next") <= F.col("__first") + (longest - 1)
    from_here = F.struct(at.alias("start"), (F.col("__last") - at + 1).cast("int").alias("length"))
    up_to_here = F.when(late, F.struct(F.col("__first").alias("start"), (at - F.col("__first") + 1).cast("int").alias("length")))
    own = seen.where(F.col("__block") == _block(at, step))
    found = own.select(F.col("__unit"), F.inline(F.array_compact(F.array(from_here, up_to_here)))).where(F.col("length") >= shortest)
    decoded = F.least(F.lit(decoder[1]), F.col("length") - encoder[0])
    kind = df.schema[time].dataType
    return found.select(
        F.col("__unit").alias(unit),
        F.col("start").cast(kind).alias("start"),
        "length",
        (F.col("length") - decoded).alias("encoder_length"),
        decoded.alias("decoder_length"),
        (F.col("start") + F.col("length") - decoded).cast(kind).alias("cut"),
    )


def sequence_store(
    df: DataFrame, unit: str, time: str, columns: Sequence[str], longest: int = 25, block: int = BLOCK, step: int = STEP
) -> DataFrame:
    """The steps of every unit, gaps filled, in blocks: (unit, block, steps).

    A block holds ``block`` times and the ``longest`` - 1 after them, which are all that is
    held twice, so every sample lies in the block of its start. Stage it
    when samples are taken from it more than once.
    """
    if block < longest:
        raise ValueError("a block must cover a whole sample")
    filled = fill_steps(df.dropna(subset=[unit, time]), unit, time, columns, step)
    blocks = F.sequence(_block(as_column(time) - (longest - 1), block), _block(as_column(time), block))
    values = F.struct(as_column(time), *[as_column(c) for c in columns])
    dealt = filled.select(as_column(unit), F.explode(blocks).alias("block"), values.alias("step"))
    return dealt.groupBy(as_column(unit), "block").agg(F.array_sort(F.collect_list("step")).alias("steps"))


def materialise(index: DataFrame, store: DataFrame, unit: str, time: str, block: int = BLOCK) -> DataFrame:
    """The samples of ``index`` (all or any of its rows), in the shape of :func:`sequence_windows`."""
    asked = index.withColumn("block", _block(F.col("start"), block))
    found = key_join(asked, store, [unit, "block"], "inner", null_safe=False)
    place = (F.col("start") - F.element_at("steps", 1)[time] + 1).cast("int")
    return found.select(
        as_column(unit),
        "cut",
        F.slice("steps", place, F.col("encoder_length")).alias("encoder"),
        F.slice("steps", place + F.col("encoder_length"), F.col("decoder_length")).alias("decoder"),
        "encoder_length",
        "decoder_length",
    )
