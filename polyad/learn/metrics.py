"""Losses over a table of predictions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The seven predicted quantiles.
QUANTILES = [0.02, 0.1, 0.25, 0.5, 0.75, 0.9, 0.98]


def quantile_loss(df: DataFrame, target: str, predictions: Mapping[float, str]) -> DataFrame:
    """Mean pinball loss, one row per predicted quantile."""

    def loss(q: float, column: str):
        error = F.col(target) - F.col(column)
        return F.avg(F.when(error.isNotNull(), F.greatest((q - 1) * error, q * error)))

    losses = df.agg(
        F.array(
            *[F.struct(F.lit(q).alias("quantile"), loss(q, c).alias("loss")) for q, c in predictions.items()]
        ).alias("losses")
    )
    return losses.select(F.inline("losses"))
