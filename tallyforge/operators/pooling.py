"""Partial pooling of group effects with known standard errors (normal hierarchical model).

Effects ``y`` with standard errors ``sigma`` scatter around a common mean ``mu`` with spread ``tau``.
Given tau everything is closed form, so the posterior is a sum over a grid of tau instead of a sampler.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


#: Groups summed at a time.
BATCH = 8_192


def _grid(tau_max: float, points: int) -> Column:
    step = tau_max / points
    return F.transform(F.sequence(F.lit(1), F.lit(points)), lambda i: (i - 0.5) * F.lit(step))


def tau_posterior(
    groups: DataFrame, tau_max: float, points: int = 200, log_prior: Callable[[Column], Column] | None = None
) -> DataFrame:
    """Per grid value of tau: weight ``p``, and mean ``m`` and variance ``v`` of mu given tau.

    Every group adds its terms to all grid values before the shuffle, which then moves at most
    ``points`` rows per task. The prior of mu is flat, that of tau is flat unless ``log_prior`` is given.
    """
    center = groups.agg(F.avg("y").alias("c")).scalar()
    tau = F.col("tau")
    spread = groups.select((F.col("y") - center).alias("d"), "sigma", F.explode(_grid(tau_max, points)).alias("tau"))
    w = 1.0 / (F.col("sigma") * F.col("sigma") + tau * tau)
    d = F.col("d")
    sums = spread.groupBy("tau").agg(
        F.sum(w).alias("sw"), F.sum(w * d).alias("swd"), F.sum(w * d * d).alias("swd2"), F.sum(F.log(w)).alias("slw")
    )
    shift = F.col("swd") / F.col("sw")
    log_p = (
        -0.5 * F.log("sw") + 0.5 * F.col("slw") - 0.5 * (F.col("swd2") - shift * shift * F.col("sw"))
    )
    if log_prior is not None:
        log_p = log_p + log_prior(tau)
    # One row per grid value reaches these windows, whatever the number of groups.
    grid = Window.partitionBy()
    rows = sums.select("tau", (shift + center).alias("m"), (1.0 / F.col("sw")).alias("v"), log_p.alias("lp"))
    raw = rows.withColumn("q", F.exp(F.col("lp") - F.max("lp").over(grid)))
    return raw.select("tau", "m", "v", (F.col("q") / F.sum("q").over(grid)).alias("p"))


def check_grid(posterior: DataFrame, most: float = 1e-3) -> None:
    """Raises when the largest spread of the grid still has weight: the grid then cuts the posterior off."""
    last = posterior.agg(F.max_by("p", "tau").alias("p")).first()["p"]
    if last is not None and last > most:
        raise ValueError(f"the largest spread has weight {last:.2g}: take a larger tau_max")


def pooled_effects(groups: DataFrame, posterior: DataFrame) -> DataFrame:
    """Posterior mean and sd of every group effect: ``id, y, sigma, theta_mean, theta_sd``.

    The posterior has one row per grid value, a number the caller has fixed, and travels with the tasks; each group's sums
    over it are taken where its row lies, many groups at once and without a shuffle.
    """
    tau2, m, v, p = np.array([(r["tau"] ** 2, r["m"], r["v"], r["p"]) for r in posterior.select("tau", "m", "v", "p").collect()], float).reshape(-1, 4).T

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH):
                batch = whole.slice(at, BATCH)
                y, sigma = (batch.column(i).cast(pa.float64()).to_numpy(zero_copy_only=False)[:, None] for i in (1, 2))
                keep = tau2 / (tau2 + sigma * sigma)
                e = keep * (y - m) + m - y
                within = keep * sigma * sigma + (1.0 - keep) ** 2 * v
                first, second = (p * e).sum(axis=1), (p * (within + e * e)).sum(axis=1)
                mean, sd = y[:, 0] + first, np.sqrt(second - first * first)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(mean, mask=np.isnan(mean)), pa.array(sd, mask=np.isnan(sd))], names)

    kind = groups.schema["id"].dataType.simpleString()
    names = ["id", "y", "sigma", "theta_mean", "theta_sd"]
    rows = groups.select("id", F.col("y").cast("double").alias("y"), F.col("sigma").cast("double").alias("sigma"))
    return rows.mapInArrow(add, f"id {kind}, y double, sigma double, theta_mean double, theta_sd double")


def pooled_hyper(posterior: DataFrame) -> DataFrame:
    """Posterior mean and sd of mu and tau."""
    p, m, tau = F.col("p"), F.col("m"), F.col("tau")
    sums = posterior.agg(
        F.sum(p * m).alias("mu_mean"),
        F.sum(p * tau).alias("tau_mean"),
        F.sum(p * (F.col("v") + m * m)).alias("mu2"),
        F.sum(p * tau * tau).alias("tau2"),
    )
    return sums.select(
        "mu_mean",
        F.sqrt(F.col("mu2") - F.col("mu_mean") * F.col("mu_mean")).alias("mu_sd"),
        "tau_mean",
        F.sqrt(F.col("tau2") - F.col("tau_mean") * F.col("tau_mean")).alias("tau_sd"),
    )
