"""Summaries of a table: profiles, frequencies, correlations, exact quantiles.

All of them reduce inside map tasks first; none gathers a group's rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from polyad.functions.values import as_column, correlation, percent_text, round_even
from polyad.operators.joins import key_join
from polyad.session import stage

SKETCH_ACCURACY = 10_000
BRACKET = 10 / SKETCH_ACCURACY
CELLS = 1024


def exact_quantiles(df: DataFrame, by: Sequence[str], value: str, probs: Sequence[float]) -> DataFrame:
    """Exact interpolated quantiles per group: (by..., prob, quantile).

    A first pass sketches a narrow bracket around each quantile. A second pass
    counts what lies below the bracket and keeps only the distinct values inside
    it. Those are counted per cell of equal width, and only the cells that hold a
    wanted rank are sorted. So a group that holds most rows is never gathered:
    its last step sorts a thin slice of a thin slice. The bracket is ten times
    the sketch's error bound and holds two ranks on either side, so in a group of
    few rows it is the whole range. Should a rank ever fall outside, the groups
    concerned are done again with their whole range.
    """
    by = list(by)
    key = [*by, "prob"]
    data = df.select(*by, F.col(value).cast("double").alias("v")).where(F.col("v").isNotNull())
    edges = [edge for p in probs for edge in (max(p - BRACKET, 0.0), min(p + BRACKET, 1.0))]
    sketch = data.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.percentile_approx("v", edges, SKETCH_ACCURACY).alias("edge"),
        F.min("v").alias("least"),
        F.max("v").alias("most"),
    )
    small = F.col("n") * BRACKET <= 2
    brackets = [
        F.struct(
            F.lit(p).alias("prob"),
            F.when(small | F.lit(p <= BRACKET), F.col("least")).otherwise(F.col("edge")[2 * i]).alias("lo"),
            F.when(small | F.lit(p >= 1 - BRACKET), F.col("most")).otherwise(F.col("edge")[2 * i + 1]).alias("hi"),
            ((F.col("n") - 1) * F.lit(p)).alias("rank"),
        )
        for i, p in enumerate(probs)
    ]
    # Written once: read by several joins, whose plans then know how small it is.
    sketch = stage(sketch.select(*by, F.array(*brackets).alias("brackets"), "least", "most"), "sketch")

    found = _pick_quantiles(data, sketch, by)
    found = stage(found, "quantiles")  # a row for each group and probability
    missed = found.where(F.col("lower").isNull() | F.col("upper").isNull())
    if not missed.isEmpty():
        again = missed.select(*by).distinct()
        whole = F.transform("brackets", lambda b: F.struct(b["prob"].alias("prob"), F.col("least").alias("lo"), F.col("most").alias("hi"), b["rank"].alias("rank")))
        wide = (key_join(sketch, again, by, "inner") if by else sketch).select(*by, whole.alias("brackets"), "least", "most")
        redone = _pick_quantiles(key_join(data, again, by, "inner") if by else data, wide, by)
        kept = key_join(found, again, by, "left_anti") if by else found.limit(0)
        found = kept.unionByName(redone)
    exact = F.col("lower") + (F.col("upper") - F.col("lower")) * F.col("w")
    return found.select(*key, exact.alias("quantile"))


def _pick_quantiles(data: DataFrame, sketch: DataFrame, by: list[str]) -> DataFrame:
    """(by..., prob, w, lower, upper): the values at the two ranks around each quantile, if the brackets hold them."""
    key = [*by, "prob"]
    sketch = sketch.select(*by, "brackets")
    joined = key_join(data, sketch, by) if by else data.withColumn("brackets", sketch.scalar())
    counts = (
        joined.select(*by, "v", F.inline("brackets"))
        .where(F.col("v") <= F.col("hi"))
        .select(*by, "prob", "lo", "hi", F.when(F.col("v") >= F.col("lo"), F.col("v")).alias("inside"))
        .groupBy(*key, "lo", "hi", "inside")
        .agg(F.count("*").alias("c"))
    )
    width = (F.col("hi") - F.col("lo")) / CELLS
    cell = F.when(F.col("inside").isNull(), -1).otherwise(
        F.coalesce(F.least(F.floor(F.try_divide(F.col("inside") - F.col("lo"), width)), F.lit(CELLS - 1)), F.lit(0))
    )
    counts = counts.select(*key, cell.cast("int").alias("cell"), "inside", "c")

    def upto(total: str, keys: Sequence[str], order: str) -> Column:
        return F.sum(total).over(Window.partitionBy(*keys).orderBy(order))

    def holds(position: Column, count: str) -> Column:
        return (F.col("upto") > position) & (F.col("upto") - F.col(count) <= position)

    ranks = sketch.select(*by, F.inline("brackets")).select(
        *key, "rank", F.floor("rank").alias("below"), F.ceil("rank").alias("above")
    )
    cells = counts.groupBy(*key, "cell").agg(F.sum("c").alias("m")).withColumn("upto", upto("m", key, "cell"))
    wanted = key_join(cells, ranks, key, "inner").where(
        holds(F.col("below"), "m") | holds(F.col("above"), "m")
    )
    starts = wanted.select(*key, "cell", (F.col("upto") - F.col("m")).alias("start"), "rank", "below", "above")
    sliced = key_join(counts, starts, [*key, "cell"], "inner")
    ranked = sliced.withColumn("upto", F.col("start") + upto("c", [*key, "cell"], "inside"))

    def value_at(position: str) -> Column:
        return F.max(F.when(holds(F.col(position), "c"), F.col("inside")))

    return ranked.groupBy(*key).agg(
        F.max(F.col("rank") - F.col("below")).alias("w"), value_at("below").alias("lower"), value_at("above").alias("upper")
    )


def medians(df: DataFrame, by: Sequence[str], value: str, into: str) -> DataFrame:
    """Exact median per group."""
    return exact_quantiles(df, by, value, [0.5]).select(*by, F.col("quantile").alias(into))


def _long(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    pairs = [F.struct(F.lit(c).alias("variable"), F.col(c).cast("double").alias("value")) for c in columns]
    return df.select(F.inline(F.array(*pairs)))


def six_number(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Minimum, quartiles, mean, maximum and number missing, one row per column."""
    values = _long(df, columns)
    simple = values.groupBy("variable").agg(
        F.min("value").alias("min"),
        F.avg("value").alias("mean"),
        F.max("value").alias("max"),
        F.count_if(F.col("value").isNull()).alias("n_missing"),
    )
    quartiles = exact_quantiles(values, ["variable"], "value", [0.25, 0.5, 0.75])
    wide = quartiles.groupBy("variable").agg(
        *[
            F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(name)
            for p, name in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))
        ]
    )
    return key_join(simple, wide, ["variable"]).select("variable", "min", "q1", "median", "mean", "q3", "max", "n_missing")


def frequency(df: DataFrame, columns: Sequence[str], include_null: bool = True) -> DataFrame:
    """Counts per level; the NULL level is optional."""
    counted = df.select(*[as_column(c) for c in columns])
    if not include_null:
        counted = counted.where(reduce(lambda a, b: a & b, [as_column(c).isNotNull() for c in columns]))
    return counted.groupBy(*[as_column(c) for c in columns]).agg(F.count("*").alias("n"))


def missing_profile(df: DataFrame, top: int = 20) -> DataFrame:
    """The columns with the largest share of missing values, in one pass.

    Ties keep the column order of ``df``.
    """
    shares = df.agg(
        F.array(
            *[
                F.struct(
                    F.lit(i).alias("position"),
                    F.lit(c).alias("variable"),
                    F.try_divide(F.count_if(as_column(c).isNull()) * 100.0, F.count("*")).alias("share"),
                )
                for i, c in enumerate(df.columns)
            ]
        ).alias("shares")
    )
    ranked = shares.select(F.inline("shares")).orderBy(F.col("share").desc(), "position").limit(top)
    return ranked.select("variable", "share", percent_text(F.col("share")).alias("missing_percent"))


def coverage(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Found?, missing count and covered percentage per requested column."""
    present = set(df.columns)

    def row(name: str) -> Column:
        found = name in present
        missing = F.count_if(as_column(name).isNull()) if found else F.lit(None).cast("bigint")
        return F.struct(F.lit(name).alias("variable"), F.lit(found).alias("found"), missing.alias("missing"))

    counted = df.agg(F.count("*").alias("total"), F.array(*[row(c) for c in columns]).alias("rows"))
    percent = round_even((1 - F.try_divide(F.col("missing"), F.col("total"))) * 100, 1)
    return counted.select("total", F.inline("rows")).select(
        "variable", "found", "missing", percent.alias("coverage_percent")
    )


def panel_extent(df: DataFrame, unit: str, time: str) -> DataFrame:
    return df.agg(
        F.count("*").alias("n_rows"),
        F.count_distinct(as_column(unit)).alias("n_units"),
        F.min(as_column(time)).alias("first_time"),
        F.max(as_column(time)).alias("last_time"),
    )


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Correlations over the rows without any missing value: (row, column, r)."""
    complete = df.select(*columns).dropna()
    pairs = complete.agg(
        F.array(
            *[
                F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), correlation(a, b).alias("r"))
                for a, b in combinations(columns, 2)
            ]
        ).alias("pairs"),
        F.array(
            *[
                F.struct(F.lit(c).alias("a"), F.lit(c).alias("b"), F.when(F.var_samp(c) > 0, F.lit(1.0)).alias("r"))
                for c in columns
            ]
        ).alias("diagonal"),
    )
    mirrored = F.transform("pairs", lambda p: F.struct(p["b"].alias("a"), p["a"].alias("b"), p["r"].alias("r")))
    return pairs.select(F.inline(F.concat("pairs", mirrored, "diagonal"))).select(
        F.col("a").alias("row_variable"), F.col("b").alias("column_variable"), F.col("r").alias("correlation")
    )


def dispersion(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Sample standard deviation and range per column."""
    values = df.agg(
        F.array(
            *[
                F.struct(F.lit(c).alias("variable"), F.stddev_samp(as_column(c)).alias("sd"), (F.max(as_column(c)) - F.min(as_column(c))).alias("range"))
                for c in columns
            ]
        ).alias("rows")
    )
    return values.select(F.inline("rows"))


def group_summary(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Mean, sample sd and row count per group; NULL is a group of its own."""
    return df.groupBy(*[as_column(c) for c in by]).agg(F.avg(as_column(value)).alias("mean"), F.stddev_samp(as_column(value)).alias("sd"), F.count("*").alias("n"))
