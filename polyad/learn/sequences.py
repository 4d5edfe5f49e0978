"""From a panel to model-ready sequence samples."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from polyad.functions.values import clip_lower, fill_with, safe_ln1p, to_number
from polyad.operators.grid import fill_time_gaps
from polyad.operators.joins import key_join
from polyad.operators.schema import as_category
from polyad.operators.series import carry_forward
from polyad.plans.constants import SEQUENCE_CATEGORIES, SEQUENCE_CLIPPED, SEQUENCE_LOGS, SEQUENCE_REALS
from polyad.session import stage

STEP = 4096


def prepare_sequences_frame(
    df: DataFrame,
    unit: str = "COWcode",
    time: str = "year",
    target: str = "v2x_libdem",
    clipped: Sequence[str] = tuple(SEQUENCE_CLIPPED),
    logs: Mapping[str, str] = SEQUENCE_LOGS,
    reals: Sequence[str] = tuple(SEQUENCE_REALS),
    categories: Sequence[str] = tuple(SEQUENCE_CATEGORIES),
) -> DataFrame:
    """Numeric keys, no row without key or target, clipped and filled reals, text categories."""
    present = set(df.columns)
    df = df.withColumns({unit: to_number(unit), time: to_number(time)}).dropna(subset=[unit, time, target])
    df = df.withColumns({c: clip_lower(c) for c in clipped if c in present})
    df = df.withColumns({into: safe_ln1p(c) for into, c in logs.items() if c in present})
    df = df.withColumns({c: fill_with(c, 0.0) for c in reals if c in df.columns})
    df = as_category(df, categories, fill_missing="-1")
    return df.withColumns(
        {unit: F.col(unit).cast("bigint").cast("string"), time: F.col(time).cast("int"), "time_idx": F.col(time).cast("int")}
    )


def time_split(df: DataFrame, time: str = "time_idx", horizon: int = 5) -> DataFrame:
    """Label rows ``train`` up to the last time minus ``horizon``, ``holdout`` after."""
    cutoff = df.agg(F.max(time)).scalar() - F.lit(horizon)
    return df.withColumn("split", F.when(F.col(time) <= cutoff, "train").otherwise("holdout"))


def fill_steps(df: DataFrame, unit: str, time: str, columns: Sequence[str], step: int = STEP) -> DataFrame:
    """Every time between a unit's first and last one; gaps repeat the last value."""
    return carry_forward(fill_time_gaps(df.select(unit, time, *columns), unit, time, step), unit, time, columns, step)


def sequence_windows(
    df: DataFrame,
    unit: str,
    time: str,
    columns: Sequence[str],
    encoder: tuple[int, int] = (10, 20),
    decoder: tuple[int, int] = (1, 5),
    step: int = STEP,
) -> DataFrame:
    """One sample per cut: steps before it as encoder, steps from it on as decoder.

    Rows are dealt to blocks of ``step`` times; the few rows near a block's edge
    are copied to the neighbour that needs them, so a long unit is spread over
    many tasks and every sample is complete within one block.
    """
    (enc_min, enc_max), (dec_min, dec_max) = encoder, decoder
    if step < enc_max + dec_max:
        raise ValueError("step must cover a whole window")

    def block(offset: int):
        return F.floor((F.col(time) + offset) / step).cast("bigint")

    dealt = df.select(unit, time, *columns).withColumn(
        "__block", F.explode(F.sequence(block(1 - dec_max), block(enc_max)))
    )
    ordered = Window.partitionBy(unit, "__block").orderBy(time)
    steps = F.struct(F.col(time), *[F.col(c) for c in columns])
    windows = dealt.withColumns(
        {
            "encoder": F.collect_list(steps).over(ordered.rangeBetween(-enc_max, -1)),
            "decoder": F.collect_list(steps).over(ordered.rangeBetween(0, dec_max - 1)),
        }
    )
    own = windows.where(F.col("__block") == block(0))
    return own.where((F.size("encoder") >= enc_min) & (F.size("decoder") >= dec_min)).select(
        unit,
        F.col(time).alias("cut"),
        "encoder",
        "decoder",
        F.size("encoder").alias("encoder_length"),
        F.size("decoder").alias("decoder_length"),
    )


def sequence_steps(samples: DataFrame, unit: str, time: str, max_encoder: int = 20) -> DataFrame:
    """Samples as rows, one per step, with relative time (in encoder lengths) and role."""

    def part(name: str):
        return F.transform(name, lambda s: F.struct(F.lit(name).alias("role"), s.alias("step")))

    rows = samples.select(unit, "cut", "encoder_length", F.inline(F.concat(part("encoder"), part("decoder"))))
    return rows.select(
        unit,
        "cut",
        "encoder_length",
        "role",
        "step.*",
        ((F.col(f"step.{time}") - F.col("cut")) / max_encoder).alias("relative_time_idx"),
    )


def latest_window_per_unit(
    df: DataFrame,
    unit: str,
    time: str,
    columns: Sequence[str],
    min_rows: int = 20,
    encoder: tuple[int, int] = (10, 20),
    decoder: int = 5,
    units: Sequence | None = None,
    step: int = STEP,
) -> DataFrame:
    """The last encoder and decoder steps of every unit with enough steps, gaps filled.

    A unit needs ``min_rows`` steps from its first to its last time, and the
    shortest encoder before the decoder.
    """
    if units is not None:
        df = df.where(F.col(unit).isin(list(units)))
    least = max(min_rows, encoder[0] + decoder)
    reach = df.groupBy(unit).agg(F.max(time).alias("__last"), F.min(time).alias("__first"))
    reach = stage(reach.where(F.col("__last") - F.col("__first") + 1 >= least).select(unit, "__last"), "reach")
    filled = fill_steps(df, unit, time, columns, step)
    recent = key_join(filled, reach, [unit], "inner", null_safe=False)
    first_decoded = F.col("__last") - (decoder - 1)
    return recent.where(F.col(time) >= first_decoded - encoder[1]).select(
        unit,
        time,
        *columns,
        F.when(F.col(time) >= first_decoded, "decoder").otherwise("encoder").alias("role"),
        (F.col(time) - first_decoded).alias("relative_step"),
    )


def _inverse_softplus(target: str, floor: float) -> Column:
    """ln(exp(y) - 1), computed as y + ln(1 - exp(-y)), which does not overflow."""
    y = F.greatest(F.col(target), F.lit(floor))
    return F.when(F.col(target).isNotNull(), y + F.ln(-F.expm1(-y)))


def fit_normalizer(df: DataFrame, group: str, target: str, floor: float = 1e-8) -> DataFrame:
    """Per group, centre and scale of the target's inverse softplus."""
    value = _inverse_softplus(target, floor)
    stats = df.groupBy(group).agg(F.avg(value).alias("target_center"), F.stddev_samp(value).alias("target_scale"))
    return stage(stats, "scales")


def group_normalizer(
    df: DataFrame, group: str, target: str, floor: float = 1e-8, fitted: DataFrame | None = None
) -> DataFrame:
    """The target's inverse softplus, centred and scaled per group.

    Centres and scales come from ``fitted`` (see :func:`fit_normalizer`), or from ``df`` itself.
    """
    stats = fit_normalizer(df, group, target, floor) if fitted is None else fitted
    scaled = key_join(df.withColumn("target_softplus_inv", _inverse_softplus(target, floor)), stats, [group])
    return scaled.withColumn(
        "target_normalized",
        F.try_divide(F.col("target_softplus_inv") - F.col("target_center"), F.col("target_scale")),
    )


def training_chain(
    df: DataFrame,
    unit: str,
    time: str,
    columns: Sequence[str],
    target: str,
    horizon: int = 5,
    encoder: tuple[int, int] = (10, 20),
    decoder: tuple[int, int] = (1, 5),
    min_rows: int = 20,
    step: int = STEP,
) -> DataFrame:
    """Training and validation samples as rows, one per step, without a look ahead.

    Training windows are cut from rows up to the last time minus ``horizon`` only,
    and the normaliser is fitted on those rows. The validation set is the last
    window of every unit. Gaps are filled first, within either part.
    """
    train = time_split(df, time, horizon).where(F.col("split") == "train")
    filled = stage(fill_steps(train, unit, time, columns, step), "steps")
    windows = sequence_windows(filled, unit, time, columns, encoder, decoder, step)
    fitted = fit_normalizer(filled, unit, target)
    shown = [unit, "part", "cut", "role", time, *columns, "relative_time_idx"]
    learned = sequence_steps(windows, unit, time, encoder[1]).withColumn("part", F.lit("train"))
    last = latest_window_per_unit(df, unit, time, columns, min_rows, encoder, decoder[1], step=step)
    checked = last.select(
        "*",
        F.lit("validation").alias("part"),
        (F.col(time) - F.col("relative_step")).alias("cut"),
        (F.col("relative_step") / encoder[1]).alias("relative_time_idx"),
    )
    rows = learned.select(*shown).unionByName(checked.select(*shown))
    return group_normalizer(rows, unit, target, fitted=fitted)
