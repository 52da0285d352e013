"""Log-normal survival times with right censoring and a normal intercept per patient.

``log time = x'b + patient + noise``. The intercepts are integrated out by adaptive Gauss-Hermite quadrature, and the
marginal likelihood is maximised by Newton's method. Rows are packed once into slices, each of one patient and of bounded
size. A step is one pass: every task forms, for all its slices at once, the sums of the log likelihood and its
derivatives at the nodes. Patients of one slice, nearly all of them, are finished where they lie and leave one row per
task; those of several slices are added up slice by slice, so a patient who holds a third of all rows is spread
over many tasks and meets again as a few hundred numbers.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import RFormula
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.operators.joins import attach
from tallyforge.session import remove_path, work_path

#: Rows of a patient that lie together.
SLICE = 4096
#: Quadrature nodes per patient.
NODES = 15
#: Log of the spread of the intercepts, relative to the noise, that counts as none.
NO_SPREAD = -9.0
#: Steps of the search for the place of a patient's nodes.
INNER = 8


# ---- the normal tail


@cache
def _tail_fit() -> np.ndarray:
    """Chebyshev coefficients of ``(1 + 2x) exp(x * x) erfc(x)`` on ``x`` in 0..20, in ``t = (x - 2) / (x + 2)`` stretched to -1..1."""
    low, high = -1.0, 18.0 / 22.0
    s = np.cos(np.pi * (np.arange(80) + 0.5) / 80)
    t = low + (s + 1.0) * (high - low) / 2.0
    x = 2.0 * (1.0 + t) / (1.0 - t)
    y = [(1.0 + 2.0 * v) * math.exp(v * v) * math.erfc(v) for v in x]
    return np.polynomial.chebyshev.chebfit(s, y, 40)


def scaled_tail(x: np.ndarray) -> np.ndarray:
    """``exp(x * x) * erfc(x)`` for ``x >= 0``."""
    near = np.minimum(x, 20.0)
    t = (near - 2.0) / (near + 2.0)
    s = 2.0 * (t + 1.0) / (18.0 / 22.0 + 1.0) - 1.0
    out = np.polynomial.chebyshev.chebval(s, _tail_fit()) / (1.0 + 2.0 * near)
    far = np.maximum(x, 20.0)
    q = 1.0 / (2.0 * far * far)
    series = (1.0 - q * (1.0 - 3.0 * q * (1.0 - 5.0 * q * (1.0 - 7.0 * q)))) / (far * math.sqrt(math.pi))
    return np.where(x > 20.0, series, out)


def log_survival(z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``log(1 - Phi(z))`` and the hazard ``phi(z) / (1 - Phi(z))`` of the standard normal."""
    x = np.abs(z) / math.sqrt(2.0)
    tail = scaled_tail(x)
    small = 0.5 * tail * np.exp(-x * x)
    value = np.where(z >= 0, np.log(0.5 * tail) - x * x, np.log1p(-small))
    hazard = np.where(z >= 0, math.sqrt(2.0 / math.pi) / tail, np.exp(-x * x) / math.sqrt(2.0 * math.pi) / (1.0 - small))
    return value, hazard


# ---- one pass


class Rows:
    """The rows of some slices: log time, censoring flag, terms, and the slice of each row."""

    def __init__(self, y: np.ndarray, censored: np.ndarray, x: np.ndarray, starts: np.ndarray) -> None:
        self.y, self.censored, self.x, self.starts = y, censored, x, starts
        self.owner = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(y)]))

    def add(self, values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values, self.starts, axis=0)

    def density(self, at: np.ndarray, sigma: float) -> tuple[np.ndarray, ...]:
        """Log density of the rows (all rows by nodes) and its first and second derivatives: by the mean, by log sigma,
        by the mean twice, by both, by log sigma twice."""
        z = (self.y[:, None] - at) / sigma
        seen = ~self.censored
        value, a, s = -math.log(sigma) - 0.5 * math.log(2 * math.pi) - 0.5 * z * z, z / sigma, z * z - 1.0
        aa, as_, ss = np.full_like(z, -1.0 / sigma**2), -2.0 * z / sigma, -2.0 * z * z
        if not seen.all():
            c = self.censored
            v, h = log_survival(z[c])
            slope = h * (h - z[c])
            both = slope * z[c] + h
            value[c], a[c], s[c], aa[c], as_[c], ss[c] = v, h / sigma, h * z[c], -slope / sigma**2, -both / sigma, -both * z[c]
        return value, a, s, aa, as_, ss


def _places(rows: Rows, beta: np.ndarray, sigma: float, tau: float) -> tuple[np.ndarray, np.ndarray]:
    """Mode and spread of each slice's intercept, by Newton steps on its log density."""
    mean, b = rows.x @ beta, np.zeros(len(rows.starts))
    for _ in range(INNER):
        _, a, _, aa, _, _ = rows.density((mean + b[rows.owner])[:, None], sigma)
        curve = rows.add(aa[:, 0]) - 1.0 / tau**2
        b = b - (rows.add(a[:, 0]) - b / tau**2) / curve
    _, _, _, aa, _, _ = rows.density((mean + b[rows.owner])[:, None], sigma)
    return b, 1.0 / np.sqrt(1.0 / tau**2 - rows.add(aa[:, 0]))


def _at_nodes(rows: Rows, beta: np.ndarray, sigma: float, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per slice and node: log density, its gradient by ``(beta, log sigma)`` and the matrix of second derivatives."""
    p, k = len(beta), b.shape[1]
    value, a, s, aa, as_, ss = rows.density((rows.x @ beta)[:, None] + b[rows.owner], sigma)
    g = np.empty((len(rows.starts), k, p + 1))
    h = np.empty((len(rows.starts), k, p + 1, p + 1))
    for i in range(p):
        g[:, :, i] = rows.add(a * rows.x[:, i : i + 1])
        h[:, :, i, p] = h[:, :, p, i] = rows.add(as_ * rows.x[:, i : i + 1])
        for j in range(i + 1):
            h[:, :, i, j] = h[:, :, j, i] = rows.add(aa * (rows.x[:, i] * rows.x[:, j])[:, None])
    g[:, :, p], h[:, :, p, p] = rows.add(s), rows.add(ss)
    return rows.add(value), g, h


def _nodes(mode: np.ndarray, spread: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the intercept and the logarithms of their weights."""
    x, w = np.polynomial.hermite.hermgauss(NODES)
    return mode[:, None] + math.sqrt(2.0) * spread[:, None] * x, np.log(w) + x * x + np.log(math.sqrt(2.0) * spread)[:, None]


def _marginal(value: np.ndarray, g: np.ndarray, h: np.ndarray, b: np.ndarray, weight: np.ndarray, tau: float) -> np.ndarray:
    """Log likelihood, gradient and second derivatives by ``(beta, log sigma, log tau)``, added over patients, as one row.

    The second derivatives follow Louis: the mean of those at the nodes, and the spread of the gradients.
    """
    n, k, q = g.shape
    joint = value + weight - math.log(tau) - 0.5 * math.log(2 * math.pi) - 0.5 * (b / tau) ** 2
    top = joint.max(axis=1, keepdims=True)
    share = np.exp(joint - top)
    total = share.sum(axis=1, keepdims=True)
    share /= total
    full = np.concatenate([g, ((b / tau) ** 2 - 1.0)[:, :, None]], axis=2)
    mean = np.einsum("nk,nkq->nq", share, full)
    second = np.zeros((q + 1, q + 1))
    second[:q, :q] = np.einsum("nk,nkij->ij", share, h)
    second[q, q] = (share * -2.0 * (b / tau) ** 2).sum()
    second += np.einsum("nk,nki,nkj->ij", share, full, full) - mean.T @ mean
    return np.concatenate([[float((top + np.log(total)).sum())], mean.sum(axis=0), second.ravel()])


def _slices(batch: pa.RecordBatch, p: int) -> Iterator[tuple[pa.RecordBatch, Rows]]:
    """Some slices at a time, about ``4 * SLICE`` rows."""
    sizes = pa.compute.list_value_length(batch.column(batch.schema.get_field_index("y"))).to_numpy(zero_copy_only=False)
    upto, start = np.cumsum(sizes), 0
    while start < len(sizes):
        done = int(upto[start - 1]) if start else 0
        stop = max(start + 1, int(np.searchsorted(upto, done + 4 * SLICE, side="right")))
        part = batch.slice(start, stop - start)
        flat = lambda name, part=part: part.column(part.schema.get_field_index(name)).flatten().to_numpy(zero_copy_only=False)
        starts = np.r_[0, np.cumsum(sizes[start:stop])[:-1]].astype(int)
        yield part, Rows(flat("y"), flat("c").astype(bool), flat("x").reshape(-1, p), starts)
        start = stop


# ---- the fit


def pack(df: DataFrame, formula: str, censored: str, patient: str) -> tuple[DataFrame, list[str]]:
    """Slices ``patient, slices, y, c, x`` of the complete rows with a positive time, and the names of the terms."""
    key = "_patient"
    flagged = df.withColumn("_c", F.col(censored).cast("double")).withColumn(key, F.col(patient))
    terms = RFormula(formula=formula, handleInvalid="skip").fit(flagged.where(F.col("_c").isNotNull() & F.col(key).isNotNull()))
    ready = terms.transform(flagged).where(F.col("_c").isNotNull() & F.col(key).isNotNull() & (F.col("label") > 0))
    meta = ready.schema["features"].metadata["ml_attr"]["attrs"]
    named = [a["name"] for a in sorted((a for group in meta.values() for a in group), key=lambda a: a["idx"])]
    rows = ready.select(key, F.log("label").alias("y"), "_c", vector_to_array("features").alias("x"), F.monotonically_increasing_id().alias("_id"))
    counts = ready.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / SLICE).alias("slices"))
    dealt = attach(rows, counts, (key,)).withColumn("slice", F.pmod(F.xxhash64("_id"), "slices"))
    row = F.collect_list(F.struct("y", "_c", "x"))
    packed = dealt.groupBy(key, "slices", "slice").agg(row.alias("r"))
    return packed.select(key, "slices", F.col("r.y").alias("y"), F.col("r._c").alias("c"), F.flatten("r.x").alias("x")), named


class Fit:
    """Estimates of a fit: ``names`` with ``values`` and their standard ``errors``, the ``log_likelihood`` and the ``steps`` taken."""

    def __init__(self, names: list[str], values: np.ndarray, errors: np.ndarray, log_likelihood: float, steps: int) -> None:
        self.names, self.values, self.errors, self.log_likelihood, self.steps = names, values, errors, log_likelihood, steps

    def frame(self, like: DataFrame) -> DataFrame:
        rows = list(zip(self.names, map(float, self.values), map(float, self.errors), strict=True))
        return like.sparkSession.createDataFrame(rows, "term string, estimate double, std_error double")


def _pass(slices: DataFrame, places: DataFrame | None, p: int, beta: np.ndarray, sigma: float, tau: float, inner: int) -> tuple[np.ndarray, DataFrame | None]:
    """The sums of one step over all patients, and the new ``places``: patients of several slices with mode and spread."""
    q = p + 2
    width = 1 + q + q * q

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for batch in batches:
            for _, rows in _slices(batch, p):
                b, weight = _nodes(*_places(rows, beta, sigma, tau))
                value, g, h = _at_nodes(rows, beta, sigma, b)
                total += _marginal(value, g, h, b, weight, tau)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array(total)], ["i", "v"])

    found = slices.where("slices = 1").select("y", "c", "x").mapInArrow(alone, "i long, v double").groupBy("i").agg(F.sum("v").alias("v"))
    sums = np.zeros(width)
    for r in found.collect():
        sums[r["i"]] += r["v"]
    if places is None:
        return sums, None

    # Patients of several slices: their modes by Newton steps over all slices, one small row a slice.
    many = slices.where("slices > 1")

    def slopes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, rows in _slices(batch, p):
                b = part.column(part.schema.get_field_index("b")).to_numpy(zero_copy_only=False)
                _, a, _, aa, _, _ = rows.density((rows.x @ beta + b[rows.owner])[:, None], sigma)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(rows.add(a[:, 0])), pa.array(rows.add(aa[:, 0]))], ["_patient", "a", "aa"])

    kind = slices.schema["_patient"].dataType.simpleString()
    for _ in range(inner):
        steps = attach(many, places, ("_patient",)).select("_patient", "y", "c", "x", "b").mapInArrow(slopes, f"_patient {kind}, a double, aa double")
        added = steps.groupBy("_patient").agg(F.sum("a").alias("a"), F.sum("aa").alias("aa"))
        joined = places.select("_patient", "b").join(added, "_patient")
        curve = F.col("aa") - 1.0 / tau**2
        places = joined.select("_patient", (F.col("b") - (F.col("a") - F.col("b") / tau**2) / curve).alias("b"), (1.0 / F.sqrt(-curve)).alias("s")).checkpoint()

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, rows in _slices(batch, p):
                mode, spread = (part.column(part.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("b", "s"))
                value, g, h = _at_nodes(rows, beta, sigma, _nodes(mode, spread)[0])
                flat = np.concatenate([value[:, :, None], g, h.reshape(*g.shape[:2], -1)], axis=2).reshape(len(mode), -1)
                for i in range(len(mode)):
                    n = flat.shape[1]
                    again = lambda column, i=i, n=n: column.take(pa.array(np.full(n, i)))
                    yield pa.RecordBatch.from_arrays([again(part.column(0)), pa.array(np.full(n, mode[i])), pa.array(np.full(n, spread[i])), pa.array(np.arange(n)), pa.array(flat[i])], ["_patient", "b", "s", "i", "v"])

    cells = attach(many, places, ("_patient",)).select("_patient", "y", "c", "x", "b", "s").mapInArrow(partial, f"_patient {kind}, b double, s double, i long, v double")
    added = cells.groupBy("_patient", "b", "s", "i").agg(F.sum("v").alias("v"))
    whole = added.groupBy("_patient", "b", "s").agg(F.sort_array(F.collect_list(F.struct("i", "v"))).alias("l")).select("b", "s", F.col("l.v").alias("v"))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for batch in batches:
            b, weight = _nodes(*(batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1)))
            flat = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, NODES, -1)
            if batch.num_rows:
                total += _marginal(flat[:, :, 0], flat[:, :, 1 : p + 2], flat[:, :, p + 2 :].reshape(batch.num_rows, NODES, p + 1, p + 1), b, weight, tau)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array(total)], ["i", "v"])

    for r in whole.mapInArrow(finish, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).collect():
        sums[r["i"]] += r["v"]
    return sums, places


def _start(slices: DataFrame, p: int) -> tuple[list[int], np.ndarray, np.ndarray, np.ndarray, float]:
    """The terms that are not sums of multiples of earlier ones, their centre and scale, and least squares of the log
    times on them, censored ones as they stand."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((p + 2, p + 2))
        for batch in batches:
            for _, rows in _slices(batch, p):
                one = np.column_stack([np.ones(len(rows.y)), rows.x, rows.y])
                total += one.T @ one
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], ["i", "v"])

    m = np.zeros((p + 2) ** 2)
    for r in slices.select("y", "c", "x").mapInArrow(moments, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).collect():
        m[r["i"]] = r["v"]
    m = m.reshape(p + 2, p + 2)
    n = m[0, 0]
    if n == 0:
        raise ValueError("no complete row with a positive time")
    centre = m[0, 1 : p + 1] / n
    cov = m[1:, 1:] / n - np.outer(m[0, 1:], m[0, 1:]) / n**2
    scale, kept = np.sqrt(np.maximum(np.diag(cov)[:p], 0.0)), []
    for j in range(p):
        own, to = cov[np.ix_(kept, kept)], cov[kept, j]
        left = cov[j, j] - to @ np.linalg.solve(own, to) if kept else cov[j, j]
        if left > 1e-9 * max(cov[j, j], 1e-300) and scale[j] > 1e-12 * abs(centre[j]):
            kept.append(j)
    centre, scale, cov, p = centre[kept], scale[kept], cov[np.ix_([*kept, p], [*kept, p])], len(kept)
    b = np.linalg.lstsq(cov[:p, :p] / np.outer(scale, scale), cov[:p, p] / scale, rcond=None)[0]
    left = max(cov[p, p] - b @ (cov[:p, p] / scale), 1e-6)
    return kept, centre, scale, np.r_[m[0, -1] / n, b], math.sqrt(left)


def fit_survival(
    df: DataFrame, formula: str = "time ~ age * sex + disease", censored: str = "censored", patient: str = "patient", most_steps: int = 40, close: float = 1e-6
) -> Fit:
    """Maximum likelihood of the model above; ``censored = 1`` means the event had not happened by ``time``.

    Estimates are those of the terms, ``(intercept)``, ``(sigma)`` of the noise and ``(patient)``, the spread of the intercepts;
    the errors come from the second derivatives. A term that earlier ones determine is left out, and
    a spread that goes to nothing is 0. Rows with a missing value or without a positive time are left out;
    repeated rows count as often as they stand there. No complete row at all is an error, and so is a step limit that
    is reached. The slices are written to the shared folder and removed after the fit; of each step a few hundred
    numbers reach the driver.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(work_path(spark, "fits"))
    packed, names = pack(df, formula, censored, patient)
    path = work_path(spark, "slices")
    packed.write.parquet(path)
    slices = spark.read.schema(packed.schema).parquet(path)
    p = len(names)
    centred = None
    try:
        kept, centre, scale, beta, sigma = _start(slices, p)
        centred = _scaled(slices, p, kept, centre, scale)
        names, p = [names[j] for j in kept], len(kept)
        places = slices.where("slices > 1").select("_patient").distinct().withColumn("b", F.lit(0.0)).withColumn("s", F.lit(1.0)).checkpoint()
        places = None if places.isEmpty() else places

        def evaluate(theta: np.ndarray, places: DataFrame | None, inner: int) -> tuple[float, np.ndarray, np.ndarray, DataFrame | None]:
            sums, places = _pass(centred, places, p + 1, theta[: p + 1], math.exp(theta[p + 1]), math.exp(theta[p + 2]), inner)
            q = p + 3
            return float(sums[0]), sums[1 : 1 + q], sums[1 + q :].reshape(q, q), places

        theta = np.r_[beta, math.log(sigma), math.log(0.5 * sigma)]
        value, gradient, second, places = evaluate(theta, places, INNER)
        for step in range(1, most_steps + 1):
            none = theta[-1] <= theta[-2] + NO_SPREAD
            if none and gradient[-1] <= 0.01:  # the likelihood rises towards no spread at all
                gradient, second = gradient.copy(), second.copy()
                gradient[-1] = second[-1, :] = second[:, -1] = 0.0
                second[-1, -1] = -1.0
            move = np.clip(_uphill(gradient, second), -2.0, 2.0)
            if move[-1] < -0.1 and theta[-1] < theta[-2] - 3.0:  # it falls by equal steps for ever: the end is tried at once
                move[-1] = -math.inf
            move[-1] = max(move[-1], theta[-2] + NO_SPREAD - theta[-1])
            if np.abs(move).max() < close:
                break
            for _ in range(12):
                found = evaluate(theta + move, places, 3)
                if np.isfinite(found[0]) and found[0] >= value - 1e-9 * abs(value):
                    break
                move = move / 2.0
            theta, (value, gradient, second, places) = theta + move, found
        else:
            raise ValueError(f"no maximum found in {most_steps} steps")
    finally:
        if centred is not None:
            centred.unpersist()
        remove_path(spark, path)
    # back to the terms as they were
    back = np.eye(p + 3)
    back[1 : p + 1, 1 : p + 1] = np.diag(1.0 / scale)
    back[0, 1 : p + 1] = -centre / scale
    spread = np.exp(theta[p + 1 :])
    coefficients = back[: p + 1, : p + 1] @ theta[: p + 1]
    back[p + 1, p + 1], back[p + 2, p + 2] = spread
    errors = np.sqrt(np.maximum(np.diag(back @ np.linalg.pinv(-second) @ back.T), 0.0))
    if none:
        spread[1] = errors[-1] = 0.0
    values = np.r_[coefficients[1:], coefficients[0], spread]
    return Fit([*names, "(intercept)", "(sigma)", "(patient)"], values, np.r_[errors[1 : p + 1], errors[0], errors[p + 1 :]], value, step)


def _scaled(slices: DataFrame, p: int, kept: list[int], centre: np.ndarray, scale: np.ndarray) -> DataFrame:
    """Slices with a constant and the kept ones of their ``p`` terms, centred and scaled."""
    at = slices.columns.index("x")

    def change(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(at)
            x = (lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, p)[:, kept] - centre) / scale
            x = np.column_stack([np.ones(len(x)), x])
            offsets = np.r_[0, np.cumsum(pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False)) // p * (len(kept) + 1)].astype(np.int32)
            columns = [batch.column(i) if i != at else pa.ListArray.from_arrays(pa.array(offsets), pa.array(x.ravel())) for i in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return slices.mapInArrow(change, slices.schema).persist()


def _uphill(gradient: np.ndarray, second: np.ndarray) -> np.ndarray:
    """The Newton step, with the curvature made negative where it is not."""
    values, vectors = np.linalg.eigh(-(second + second.T) / 2.0)
    values = np.maximum(np.abs(values), 1e-8 * max(1.0, float(np.abs(values).max())))
    return vectors @ ((vectors.T @ gradient) / values)
