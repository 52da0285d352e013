"""Means and co-moments per group, and the small solvers that need nothing else.

A least-squares, ridge or elastic-net fit depends on the rows only through counts, means and
covariances. These are built-in mergeable aggregates, so one pass with map-side combination serves any
number of fits, and a group that holds a large share of the rows never meets in one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def moments(df: DataFrame, columns: tuple[str, ...], by: tuple[str, ...] = ()) -> DataFrame:
    """``n``, ``mean`` (one value per column) and ``cov`` (row-major, divided by n) per group.

    Rows with a NULL in one of the columns are left out.
    """
    typed = df.select(*by, *[F.col(c).cast("double").alias(f"_m{i}") for i, c in enumerate(columns)]).dropna(
        subset=[f"_m{i}" for i in range(len(columns))]
    )
    size = range(len(columns))
    pairs = [
        F.covar_pop(f"_m{i}", f"_m{j}").alias(f"_c{i}_{j}") for i, j in combinations_with_replacement(size, 2)
    ]
    means = [F.avg(f"_m{i}").alias(f"_a{i}") for i in size]
    wide = typed.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *means, *pairs)
    cells = [F.col(f"_c{min(i, j)}_{max(i, j)}") for i in size for j in size]
    return wide.select(
        *by, "n", F.array(*[F.col(f"_a{i}") for i in size]).alias("mean"), F.array(*cells).alias("cov")
    )


#: Columns of a block of second moments, and tasks whose blocks are added up first.
BLOCK, MERGED = 64, 64


def block_moments(df: DataFrame, columns: tuple[str, ...], block: int = BLOCK) -> tuple[int, np.ndarray, np.ndarray]:
    """``n``, means and covariances (divided by n) of thousands of columns, as arrays on the driver.

    Second moments are formed and added up by pairs of column blocks, so no row and no shuffled value grows with the square of
    the number of columns; what reaches the driver does, 8 bytes a pair. Rows with a NULL or NaN in one of the columns are left out.
    """
    p = len(columns)
    values = [F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double")) for c in columns]
    rows = df.select(F.array(*values).alias("x")).where(~F.exists("x", lambda v: v.isNull()))

    def matrix(batch: pa.RecordBatch) -> np.ndarray:
        return batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, p)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(p)
        for batch in batches:
            n, total = n + batch.num_rows, total + matrix(batch).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(p + 1)), pa.array(np.r_[total, n])], ["i", "s"])

    first = np.zeros(p + 1)
    for r in rows.mapInArrow(sums, "i long, s double").groupBy("i").agg(F.sum("s").alias("s")).collect():
        first[r["i"]] = r["s"]
    n = int(first[p])
    if n == 0:
        return 0, np.full(p, np.nan), np.full((p, p), np.nan)
    mean = first[:p] / n
    starts = range(0, p, block)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            x = matrix(batch) - mean
            for i in starts:
                for j in starts:
                    if i <= j:
                        total[i, j] = total.get((i, j), 0.0) + x[:, i : i + block].T @ x[:, j : j + block]
        part = TaskContext.get().partitionId() // MERGED
        for (i, j), m in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([i]), pa.array([j]), pa.array([m.tobytes()])], ["part", "i", "j", "m"])

    def add(table: pa.Table) -> pa.Table:
        m = np.sum([np.frombuffer(b.as_py()) for b in table.column("m")], axis=0)
        return table.slice(0, 1).set_column(table.schema.get_field_index("m"), "m", pa.array([m.tobytes()]))

    kind = "part long, i long, j long, m binary"
    some = rows.mapInArrow(products, kind).groupBy("part", "i", "j").applyInArrow(add, kind)
    cov = np.zeros((p, p))
    for r in some.groupBy("i", "j").applyInArrow(add, kind).collect():
        i, j = r["i"], r["j"]
        m = np.frombuffer(r["m"]).reshape(min(block, p - i), -1) / n
        cov[i : i + block, j : j + block], cov[j : j + block, i : i + block] = m, m.T
    return n, mean, cov


def stack(column, width: int) -> np.ndarray:
    """A column of equally long lists as one array with ``width`` values per row."""
    return np.array([np.asarray(v, dtype=float) for v in column], dtype=float).reshape(-1, width)


def merge(n: np.ndarray, mean: np.ndarray, cov: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Moments of the union of disjoint groups."""
    total = n.sum()
    center = (n[:, None] * mean).sum(axis=0) / total
    off = mean - center
    spread = cov + off[:, :, None] * off[:, None, :]
    return total, center, (n[:, None, None] * spread).sum(axis=0) / total


def elastic_net(gram: np.ndarray, target: np.ndarray, l1: float, l2: float, start: np.ndarray) -> np.ndarray:
    """Coordinate descent for ``b'Gb/2 - t'b + l1*|b| + l2*b'b/2``."""
    b = start.copy()
    left, least = target - gram @ b, 1e-12 * max(1.0, float(np.abs(target).max(initial=0.0)))
    for _ in range(10_000):
        largest = 0.0
        for j in range(len(b)):
            own = gram[j, j]
            rest = left[j] + own * b[j]
            new = np.sign(rest) * max(abs(rest) - l1, 0.0) / (own + l2) if own + l2 > 0 else 0.0
            if new != b[j]:
                largest = max(largest, abs(new - b[j]) * np.sqrt(own))
                left -= gram[:, j] * (new - b[j])
                b[j] = new
        if largest < least:
            break
    return b
