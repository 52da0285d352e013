"""Cross-validated error over a penalty path, from one pass over the rows.

Counts, means and covariances per fold are enough: those of the other folds fit the path, those of the
held-out fold give its squared error. The whole curve costs one aggregation instead of one fit per fold
and penalty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.hashing import fold_number
from tallyforge.operators.moments import elastic_net, merge, moments, stack

CURVE_SCHEMA = "lam double, fold int, n bigint, mse double"


def _scales(cov: np.ndarray, p: int, standardize: bool) -> tuple[np.ndarray, float]:
    sx = np.sqrt(np.maximum(np.diag(cov)[:p], 0.0)) if standardize else np.ones(p)
    sy = float(np.sqrt(max(cov[p, p], 0.0)))
    return np.where(sx > 0, sx, 1.0), sy if sy > 0 else 1.0


def coefficients(cov: np.ndarray, alpha: float, lambdas: np.ndarray, standardize: bool) -> np.ndarray:
    """Coefficients for a falling penalty path, each started from the one before.

    ``cov`` holds the features and, last, the label. The L2 weight is taken relative to the sd of the
    label, as in :func:`tallyforge.operators.models.fit_elastic_net`.
    """
    p = cov.shape[0] - 1
    sx, sy = _scales(cov, p, standardize)
    gram, target = cov[:p, :p] / np.outer(sx, sx), cov[:p, p] / sx
    path, b = [], np.zeros(p)
    for lam in lambdas:
        b = elastic_net(gram, target, lam * alpha, lam * (1.0 - alpha) / sy, b)
        path.append(b / sx)
    return np.array(path).reshape(len(lambdas), p)


def fold_errors(
    df: DataFrame, features: tuple[str, ...], label: str, key: str, alpha: float, folds: int = 10, points: int = 100,
    smallest: float = 1e-4, standardize: bool = True, seed: int | str = 42,
) -> DataFrame:
    """Squared error of every held-out fold at every penalty: ``lam, fold, n, mse``.

    The path falls geometrically from the penalty at which all coefficients are zero.
    """
    p = len(features)
    per_fold = moments(df.withColumn("_fold", fold_number(key, folds, seed)), (*features, label), ("_fold",))

    def errors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(batches), ignore_index=True)
        if pdf.empty:
            return
        n = pdf["n"].to_numpy(float)
        mean, cov = stack(pdf["mean"], p + 1), stack(pdf["cov"], (p + 1) ** 2).reshape(-1, p + 1, p + 1)
        _, _, whole = merge(n, mean, cov)
        sx, _ = _scales(whole, p, standardize)
        top = np.abs(whole[:p, p] / sx).max() / max(alpha, 1e-3)
        lambdas = np.geomspace(top, top * smallest, points) if top > 0 else np.zeros(1)
        for i, fold in enumerate(pdf["_fold"]):
            rest = np.arange(len(pdf)) != i
            if not rest.any():
                continue
            _, center, spread = merge(n[rest], mean[rest], cov[rest])
            b = coefficients(spread, alpha, lambdas, standardize)
            off = (mean[i, p] - center[p]) - b @ (mean[i, :p] - center[:p])
            mse = cov[i, p, p] + off**2 - 2.0 * b @ cov[i, :p, p] + np.einsum("lj,jk,lk->l", b, cov[i, :p, :p], b)
            yield pd.DataFrame({"lam": lambdas, "fold": fold, "n": int(n[i]), "mse": mse})

    # One row of moments per fold: a number of rows fixed by the caller, not by the data.
    return per_fold.repartition(1).mapInPandas(errors, CURVE_SCHEMA)


def error_curve(errors: DataFrame) -> DataFrame:
    """Weighted mean error and its standard error per penalty: ``lam, cvm, cvsd``."""
    n, mse = F.col("n"), F.col("mse")
    sums = errors.groupBy("lam").agg(
        F.sum(n).alias("w"), F.sum(n * mse).alias("s"), F.sum(n * mse * mse).alias("s2"), F.count(F.lit(1)).alias("k")
    )
    mean = F.col("s") / F.col("w")
    spread = F.greatest(F.col("s2") / F.col("w") - mean * mean, F.lit(0.0))
    return sums.select("lam", mean.alias("cvm"), F.sqrt(F.try_divide(spread, F.col("k") - 1)).alias("cvsd"))


def one_se_rule(curve: DataFrame) -> DataFrame:
    """The penalty with the least error, and the largest one within one standard error of it."""
    least = curve.agg(F.min(F.struct("cvm", (-F.col("lam")).alias("minus"), "cvsd")).alias("b")).select(
        F.struct(F.col("b.cvm").alias("cvm"), (-F.col("b.minus")).alias("lam"), F.col("b.cvsd").alias("cvsd"))
    )
    marked = curve.withColumn("_b", least.scalar()).where(F.col("cvm") <= F.col("_b.cvm") + F.col("_b.cvsd"))
    return marked.agg(F.max(F.col("_b.lam")).alias("lambda_min"), F.max("lam").alias("lambda_1se"))


def choose_lambda(
    df: DataFrame, features: tuple[str, ...], label: str, key: str, alpha: float, folds: int = 10
) -> float:
    """The one-standard-error penalty for a fit without standardising, as a number.

    Fits use their given penalty unless this one is passed to them.
    """
    errors = fold_errors(df, features, label, key, alpha, folds, standardize=False)
    return one_se_rule(error_curve(errors)).first()["lambda_1se"]
