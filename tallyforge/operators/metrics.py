"""Prediction metrics, each one aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def regression_metrics(df: DataFrame, prediction: str, label: str, by: tuple[str, ...] = ()) -> DataFrame:
    """``rmse``, ``mae`` and ``r2`` (squared correlation; NULL for a constant prediction).

    Rows without a prediction or without a label count in none of them.
    """
    known = F.col(prediction).isNotNull() & F.col(label).isNotNull()
    p, y = F.when(known, F.col(prediction).cast("double")), F.when(known, F.col(label).cast("double"))
    error = p - y
    shared = F.covar_pop(p, y)
    return df.groupBy(*by).agg(
        F.sqrt(F.avg(F.pow(error, F.lit(2.0)))).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        F.try_divide(shared * shared, F.var_pop(p) * F.var_pop(y)).alias("r2"),
    )


def binary_metrics(
    df: DataFrame, probability: str, label: str, by: tuple[str, ...] = (), clip: float = 1e-15
) -> DataFrame:
    """``logloss`` with probabilities clipped away from 0 and 1, and ``error`` at threshold 0.5."""
    y = F.col(label).cast("double")
    p = F.least(F.greatest(F.col(probability), F.lit(clip)), F.lit(1.0 - clip))
    wrong = ((F.col(probability) > 0.5).cast("int") != F.col(label)).cast("double")
    return df.groupBy(*by).agg(
        (-F.avg(y * F.log(p) + (1.0 - y) * F.log(1.0 - p))).alias("logloss"), F.avg(wrong).alias("error")
    )


def best_row(df: DataFrame, metric: str, tie_break: str, mode: str = "min") -> DataFrame:
    """The row with the smallest or largest metric; the tie break decides between equals."""
    order = F.col(metric).asc_nulls_last() if mode == "min" else F.col(metric).desc_nulls_last()
    return df.orderBy(order, tie_break).limit(1)
