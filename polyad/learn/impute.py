"""Chained-equation imputation from one pass of sufficient statistics.

Every value the chain fills in is a linear function of the values observed in
the same row, and that function is the same for all rows with the same pattern
of gaps. So Spark sums products once per pattern; the rounds then run on those
small matrices; and one projection fills the rows. If a table has more patterns than
the driver can hold sums for, the rounds run over the table instead: a pass for
every fit, whose state is one matrix of the columns' products.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from polyad.functions.values import as_column, nan_to_null, safe_ln1p
from polyad.operators.schema import inline_table
from polyad.session import stage

PATTERN_CELLS = 4_000_000  # numbers in the sums of all patterns that the driver takes


@dataclass
class Imputation:
    """Filled table, and how many values were filled per target."""

    filled: DataFrame
    report: DataFrame


def _noise(row_id: Sequence[str], column: str, seed: int) -> Column:
    """Standard normal draw that depends on the row's values only (Box-Muller on two hashes)."""

    def uniform(salt: str) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.lit(column), F.lit(salt), *row_id), 11)
        return (bits.cast("double") + 0.5) / F.lit(float(2**53))

    return F.sqrt(-2 * F.ln(uniform("radius"))) * F.cos(2 * np.pi * uniform("angle"))


def _regress(
    gram: np.ndarray, features: list[int], target: int, ridge: float | None, draw: np.random.Generator | None = None
) -> tuple[np.ndarray, float]:
    """Linear fit of ``target`` on 1 and ``features`` from summed products.

    Returns the coefficients (intercept first) and the residual standard
    deviation. ``ridge=None`` estimates the shrinkage by evidence maximisation;
    a number is used as it is. With ``draw``, the coefficients are drawn from
    their posterior instead of being its mean.
    """
    n = gram[0, 0]
    mean = gram[0] / n
    centred = gram - n * np.outer(mean, mean)
    xx = centred[np.ix_(features, features)]
    xy = centred[features, target]
    yy = centred[target, target]
    values, vectors = np.linalg.eigh(xx)
    values = np.clip(values, 0.0, None)
    rotated = vectors.T @ xy

    def solve(penalty: float) -> tuple[np.ndarray, float]:
        scale = values + penalty
        safe = np.where(scale > 1e-12 * max(values.max(initial=0.0), 1.0), scale, np.inf)
        weights = vectors @ (rotated / safe)
        error = yy - 2 * weights @ xy + weights @ xx @ weights
        return weights, max(float(error), 0.0)

    if ridge is not None:
        weights, error = solve(ridge)
        noise, penalty = error / n, ridge
    else:
        tiny = 1e-6
        alpha, lam = n / max(yy, 1e-300), 1.0
        weights = np.zeros(len(features))
        for _ in range(300):
            previous = weights
            weights, error = solve(lam / alpha)
            effective = float(np.sum(alpha * values / (lam + alpha * values)))
            lam = (effective + 2 * tiny) / (float(weights @ weights) + 2 * tiny)
            alpha = (n - effective + 2 * tiny) / (error + 2 * tiny)
            if np.abs(previous - weights).sum() < 1e-3:
                break
        weights, _ = solve(lam / alpha)
        noise, penalty = 1.0 / alpha, lam / alpha
    shift = 0.0
    if draw is not None:
        scale = values + penalty
        safe = np.where(scale > 1e-12 * max(values.max(initial=0.0), 1.0), scale, np.inf)
        weights = weights + vectors @ (draw.standard_normal(len(features)) * np.sqrt(noise / safe))
        shift = float(draw.standard_normal() * np.sqrt(noise / n))
    intercept = mean[target] - weights @ mean[features] + shift
    return np.concatenate([[intercept], weights]), float(np.sqrt(noise))


def _run_rounds(
    grams: dict[int, np.ndarray], gaps: list[int], width: int, rounds: int, sample: bool, ridge: float | None, seed: int = 0
) -> tuple[dict[int, np.ndarray], dict[int, np.ndarray]]:
    """Chain the regressions on per-pattern product sums.

    A pattern is a bit set over ``gaps`` (column numbers, fewest gaps first). For
    each pattern the result is a map from the observed row (1 first, gaps as 0)
    to the completed row, and the factor that turns independent normals into the
    chain's correlated residuals.
    """
    size = width + 1
    draw = np.random.default_rng(seed) if sample else None
    maps = {p: np.eye(size) for p in grams}
    spread = {p: np.zeros((size, 0)) for p in grams}
    for p in grams:
        for bit, column in enumerate(gaps):
            if p >> bit & 1:
                maps[p][column] = 0.0

    def moments(p: int) -> np.ndarray:
        return maps[p] @ grams[p] @ maps[p].T + grams[p][0, 0] * (spread[p] @ spread[p].T)

    for _ in range(rounds):
        for bit, column in enumerate(gaps):
            features = [c for c in range(1, size) if c != column]
            total = sum((moments(p) for p in grams if not p >> bit & 1), np.zeros((size, size)))
            coefficients, residual = _regress(total, features, column, ridge, draw)
            for p in grams:
                if p >> bit & 1:
                    maps[p][column] = coefficients[0] * maps[p][0] + coefficients[1:] @ maps[p][features]
                    if sample:
                        own = np.zeros((size, 1))
                        own[column] = residual
                        carried = spread[p].copy()
                        carried[column] = coefficients[1:] @ spread[p][features]
                        spread[p] = _compact(np.hstack([carried, own]))
    return maps, spread


def _compact(factor: np.ndarray) -> np.ndarray:
    """A factor with the same covariance and no more columns than rows."""
    if factor.shape[1] <= factor.shape[0]:
        return factor
    values, vectors = np.linalg.eigh(factor @ factor.T)
    return vectors * np.sqrt(np.clip(values, 0.0, None))


def chained_imputation(
    df: DataFrame,
    targets: Sequence[str],
    predictors: Sequence[str],
    row_id: Sequence[str],
    rounds: int = 10,
    seed: int = 42,
    sample: bool = True,
    ridge: float | None = None,
) -> Imputation:
    """Fill the gaps of ``targets`` by chained regressions on all other columns.

    Predictors with gaps take part in the chain but keep their gaps in the
    result. NaN counts as a gap. Columns are standardised first. ``sample`` draws
    the coefficients once per fit and residual noise per row, from a hash of
    ``row_id``, so results do not depend on partitioning.
    """
    columns = [*targets, *predictors]
    x = {c: nan_to_null(as_column(c).cast("double")) for c in columns}
    facts = df.agg(
        F.count("*").alias("n"),
        *[F.count(x[c]).alias(f"n_{c}") for c in columns],
        *[F.avg(x[c]).alias(f"mean_{c}") for c in columns],
        *[F.stddev_pop(x[c]).alias(f"sd_{c}") for c in columns],
    ).first()
    empty = [c for c in columns if not facts[f"n_{c}"]]
    if empty:
        raise ValueError(f"columns without any value: {empty}")
    holes = {c: facts["n"] - facts[f"n_{c}"] for c in columns}
    order = sorted((c for c in columns if holes[c]), key=lambda c: (holes[c], columns.index(c)))
    report = inline_table(df.sparkSession, "variable string, filled bigint", [(c, holes[c]) for c in targets])
    if not order:
        return Imputation(df, report)

    centre = {c: float(facts[f"mean_{c}"]) for c in columns}
    scale = {c: float(facts[f"sd_{c}"]) or 1.0 for c in columns}
    z = [F.lit(1.0)] + [F.coalesce((x[c] - centre[c]) / scale[c], F.lit(0.0)) for c in columns]
    pattern = F.concat(*[F.when(x[c].isNull(), "1").otherwise("0") for c in reversed(order)])  # binary digits

    cells = [(i, j) for i in range(len(z)) for j in range(i, len(z))]
    standard = df.select(pattern.alias("__pattern"), *[e.alias(f"__z{i}") for i, e in enumerate(z)])
    sums = standard.groupBy("__pattern").agg(
        *[F.sum(F.col(f"__z{i}") * F.col(f"__z{j}")).alias(f"s_{i}_{j}") for i, j in cells]
    )
    most = max(1, PATTERN_CELLS // len(z) ** 2)
    found = sums.limit(most + 1).collect()
    if len(found) > most:
        return Imputation(_by_passes(df, columns, targets, order, x, centre, scale, rounds, sample, ridge, row_id, seed), report)
    grams: dict[int, np.ndarray] = {}
    for row in found:
        gram = np.zeros((len(z), len(z)))
        for i, j in cells:
            gram[i, j] = gram[j, i] = row[f"s_{i}_{j}"]
        grams[int(row["__pattern"], 2)] = gram

    gap_numbers = [columns.index(c) + 1 for c in order]
    maps, spread = _run_rounds(grams, gap_numbers, len(columns), rounds, sample, ridge, seed)
    return Imputation(_apply(df, columns, targets, order, x, z, pattern, maps, spread, centre, scale, row_id, seed), report)


def _by_passes(df, columns, targets, order, x, centre, scale, rounds, sample, ridge, row_id, seed) -> DataFrame:
    """The same chain over the table: one pass of sums for every fit, and one stage table a round."""
    draw = np.random.default_rng(seed) if sample else None
    size = len(columns) + 1
    place = {c: i + 1 for i, c in enumerate(columns)}
    standard = {f"__v{place[c]}": F.coalesce((x[c] - centre[c]) / scale[c], F.lit(0.0)) for c in columns}
    gaps = {f"__gap{place[c]}": x[c].isNull() for c in order}
    frame = df.withColumns(standard | gaps)
    cells = [(i, j) for i in range(size) for j in range(i, size)]
    value = lambda i: F.lit(1.0) if i == 0 else F.col(f"__v{i}")
    for turn in range(rounds):
        for c in order:
            target = place[c]
            known = frame.where(~F.col(f"__gap{target}"))
            sums = known.agg(*[F.sum(value(i) * value(j)).alias(f"s_{i}_{j}") for i, j in cells]).first()
            gram = np.zeros((size, size))
            for i, j in cells:
                gram[i, j] = gram[j, i] = sums[f"s_{i}_{j}"]
            features = [i for i in range(1, size) if i != target]
            weights, residual = _regress(gram, features, target, ridge, draw)
            fitted = sum((float(w) * value(i) for w, i in zip(weights[1:], features, strict=True)), F.lit(float(weights[0])))
            if sample:
                fitted = fitted + residual * _noise(row_id, f"{c} {turn}", seed)
            frame = frame.withColumn(f"__v{target}", F.when(F.col(f"__gap{target}"), fitted).otherwise(value(target)))
        frame = stage(frame, "round")
    filled = {c: F.coalesce(x[c], F.lit(centre[c]) + F.lit(scale[c]) * value(place[c])) for c in targets if c in order}
    return frame.withColumns(filled).select(*df.columns)


def _apply(df, columns, targets, order, x, z, pattern, maps, spread, centre, scale, row_id, seed) -> DataFrame:
    """Fill target gaps with the row's linear map, looked up by gap pattern."""
    wanted = [c for c in targets if c in order]
    depth = max((s.shape[1] for s in spread.values()), default=0)
    rows = []
    for p, matrix in maps.items():
        factor = np.zeros((matrix.shape[0], depth))
        factor[:, : spread[p].shape[1]] = spread[p]
        weights = np.hstack([matrix, factor])
        rows.append([f"{p:0{len(order)}b}", *[weights[columns.index(c) + 1].tolist() for c in wanted]])
    schema = ", ".join(["__pattern string", *[f"__w_{i} array<double>" for i in range(len(wanted))]])
    lookup = inline_table(df.sparkSession, schema, rows)

    basis = F.array(*z, *[_noise(row_id, f"noise {k}", seed) for k in range(depth)])
    keyed = df.withColumns({"__pattern": pattern, "__basis": F.when(pattern.contains("1"), basis)})
    joined = keyed.join(lookup, "__pattern", "left")

    def dot(weights: str) -> Column:
        products = F.zip_with(F.col(weights), F.col("__basis"), lambda a, b: a * b)
        return F.aggregate(products, F.lit(0.0), lambda total, v: total + v)

    filled = {
        c: F.coalesce(x[c], F.lit(centre[c]) + F.lit(scale[c]) * dot(f"__w_{i}"))
        for i, c in enumerate(wanted)
    }
    return joined.withColumns(filled).select(*df.columns)


def refresh_logs(df: DataFrame, logs: dict[str, str]) -> DataFrame:
    """Recompute ln(1 + x) columns (result name to source name) after imputation."""
    return df.withColumns({into: safe_ln1p(source) for into, source in logs.items() if source in df.columns})
