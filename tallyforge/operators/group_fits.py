"""Many independent fits and tasks: one linear model per group, Arrow task maps, batch ratios."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tallyforge.functions.columns import as_label
from tallyforge.operators.moments import moments, stack


def fit_per_group(
    df: DataFrame, key: str, features: tuple[str, ...], label: str, ridge: float = 0.0
) -> DataFrame:
    """One least-squares (or ridge) model per group: ``key, n, intercept``, one column per feature.

    Only one row of moments per group reaches Python, where a whole Arrow batch of normal equations is
    solved at once. Groups whose equations are singular get NULL coefficients.
    """
    p = len(features)
    key_type = df.schema[key].dataType.simpleString()
    schema = f"`{key}` {key_type}, n bigint, intercept double, " + ", ".join(f"`{f}` double" for f in features)

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            mean = stack(pdf["mean"], p + 1)
            cov = stack(pdf["cov"], (p + 1) ** 2).reshape(-1, p + 1, p + 1)
            gram = cov[:, :p, :p] + (ridge / pdf["n"].to_numpy(float))[:, None, None] * np.eye(p)
            scale = np.maximum(np.abs(gram).max(axis=(1, 2)), 1e-300) if len(pdf) else np.ones(0)
            fine = np.linalg.matrix_rank(gram / scale[:, None, None], tol=1e-10) == p
            coef = np.full((len(pdf), p), np.nan)
            coef[fine] = np.linalg.solve(gram[fine], cov[fine, :p, p][..., None])[..., 0]
            out = pd.DataFrame({key: pdf[key], "n": pdf["n"]})
            out["intercept"] = mean[:, p] - (coef * mean[:, :p]).sum(axis=1)
            for j, name in enumerate(features):
                out[name] = coef[:, j]
            yield out.astype(object).where(out.notna(), None)

    return moments(df, (*features, label), (key,)).mapInPandas(solve, schema)


def task_map(df: DataFrame, task: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """Run the same function on every Arrow batch of every partition and gather its result rows.

    Results that belong together are combined by a following ``groupBy``, not on the driver. A task must
    not depend on which rows share its batch.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                yield task(pdf)

    return df.mapInPandas(run, schema)


def group_stream(
    df: DataFrame, key: str, start: Callable[[Any], Any], step: Callable[[Any, pa.RecordBatch], Any], finish: Callable[[Any, Any], dict], schema: str,
    batch: int = 10_000, order: tuple[str, ...] = (),
) -> DataFrame:
    """One task per group whose rows stream past in batches, with a state that is carried from one to the next.

    ``start(key)`` makes the state, ``step(state, rows)`` returns the next one for at most ``batch`` rows of the group, by ``order``
    if it is given, and ``finish(key, state)`` a row of the result. A task holds a batch and one state at a time, so a group of any size is
    bounded in memory; a null key is a group. Groups share tasks; the rows of a key pass through one.
    """
    keys = F.col(f"`{key}`")
    dealt = df.repartition(keys).sortWithinPartitions(keys, *order)
    at = df.columns.index(key)
    out = df.sparkSession.createDataFrame([], schema).schema
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, rows = None, None, []
        for whole in batches:
            codes = pc.dictionary_encode(whole.column(at), null_encoding="encode").indices.to_numpy(zero_copy_only=False)
            edges = np.r_[0, np.flatnonzero(codes[1:] != codes[:-1]) + 1, len(codes)]
            for low, high in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                if low == high:
                    continue
                value = whole.column(at)[low].as_py()
                if now is None or now[0] != value:
                    if now is not None:
                        rows.append(finish(now[0], state))
                    now, state = (value,), start(value)
                for i in range(low, high, batch):
                    state = step(state, whole.slice(i, min(batch, high - i)))
                if len(rows) >= batch:
                    yield pa.RecordBatch.from_pylist(rows, arrow)
                    rows = []
        if now is not None:
            rows.append(finish(now[0], state))
        if rows:
            yield pa.RecordBatch.from_pylist(rows, arrow)

    return dealt.mapInArrow(run, out)


def linear_scorer(intercept: float, coefficients: tuple[float, ...]) -> Callable[..., Column]:
    """A scoring function that carries its fitted numbers; takes one column per coefficient."""

    @F.pandas_udf("double")
    def score(*columns: pd.Series) -> pd.Series:
        total = pd.Series(intercept, index=columns[0].index, dtype=float)
        for value, c in zip(columns, coefficients):
            total = total + c * value
        return total

    return score


def batch_hits(df: DataFrame, batch: Column, hit: Column) -> DataFrame:
    """Hits and rows per batch."""
    return df.groupBy(batch.alias("batch")).agg(
        F.coalesce(F.sum(as_label(hit)), F.lit(0)).cast("bigint").alias("hits"), F.count(F.lit(1)).alias("n")
    )


def batch_ratio(batches: DataFrame, scale: float = 4.0) -> DataFrame:
    """Totals over batches, the scaled ratio of hits and its standard error."""
    total = batches.agg(
        F.count(F.lit(1)).alias("batches"), F.sum("hits").alias("hits"), F.sum("n").alias("n")
    ).withColumn("_p", F.try_divide("hits", "n"))
    return total.select(
        "batches",
        "hits",
        "n",
        (F.lit(scale) * F.col("_p")).alias("estimate"),
        (F.lit(scale) * F.sqrt(F.try_divide(F.col("_p") * (1.0 - F.col("_p")), F.col("n")))).alias("se"),
    )
