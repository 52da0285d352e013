"""Every prefix of a boosted classifier scored in one pass.

A boosted model of ``m`` rounds is the first ``m`` trees of a longer one. Each task walks all trees for a batch of rows at
once, adds their outputs up tree by tree and leaves one row of sums per round, so a curve over all rounds reads
the rows once, whatever their number.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Probabilities are kept this far from 0 and 1.
CLIP = 1e-15
#: Rows walked at a time.
BATCH = 16_384

_LINE = re.compile(r"^( *)(?:(Tree) \d+ \(weight (\S+)\)|(If|Else) \(feature (\d+) \S+ (\S+)\)|Predict: (\S+))")


class Trees:
    """The trees of a fitted model as arrays: ``feature`` (-1 in a leaf), ``threshold``, ``left``, ``right``, ``value``."""

    def __init__(self, text: str) -> None:
        self.roots: list[int] = []
        self.weights: list[float] = []
        self.feature: list[int] = []
        self.threshold: list[float] = []
        self.left: list[int] = []
        self.right: list[int] = []
        self.value: list[float] = []
        lines = [m.groups() for m in map(_LINE.match, text.splitlines()) if m]
        at = 0
        while at < len(lines):
            if lines[at][1]:
                self.weights.append(float(lines[at][2].rstrip("):")))
                self.roots.append(len(self.feature))
                at = self._read(lines, at + 1)
            else:
                at += 1

    def _read(self, lines: list[tuple], at: int) -> int:
        """Reads the node at a line of the description and those below it; the line after them."""
        _, _, _, branch, feature, threshold, value = lines[at]
        own = len(self.feature)
        for column, v in ((self.feature, -1), (self.threshold, 0.0), (self.left, own), (self.right, own), (self.value, 0.0)):
            column.append(v)
        if branch is None:
            self.value[own] = float(value)
            return at + 1
        self.feature[own], self.threshold[own], self.left[own] = int(feature), float(threshold), len(self.feature)
        at = self._read(lines, at + 1)
        self.right[own] = len(self.feature)
        return self._read(lines, at + 1)  # the line of the other branch has no node of its own

    def sums(self, x: np.ndarray) -> np.ndarray:
        """For each row and each number of trees the weighted sum of their outputs."""
        feature, threshold, left, right, value = (np.array(c) for c in (self.feature, self.threshold, self.left, self.right, self.value))
        out, rows = np.empty((len(x), len(self.roots))), np.arange(len(x))
        for t, (root, weight) in enumerate(zip(self.roots, self.weights, strict=True)):
            node = np.full(len(x), root)
            while (inner := feature[node] >= 0).any():
                goes_left = x[rows, np.maximum(feature[node], 0)] <= threshold[node]
                node = np.where(inner, np.where(goes_left, left[node], right[node]), node)
            out[:, t] = weight * value[node]
        return np.cumsum(out, axis=1)


def round_curve(model: PipelineModel, df: DataFrame, label: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Log loss and error of the model after each of its rounds: ``*by, round, n, logloss, error``.

    Rows without a label count nowhere. A null in ``by`` is a group. The
    last round has the metrics of the whole model.
    """
    trees = Trees(model.stages[-1].toDebugString)
    ready = PipelineModel(model.stages[:-1]).transform(df.where(F.col(label).isNotNull()))
    rows = ready.select(*by, F.col(label).cast("double").alias("_y"), vector_to_array("features").alias("_x"))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    schema = ", ".join([*[f"`{c}` {kinds[c]}" for c in by], "round int, n bigint, loss double, wrong bigint"])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rounds = len(trees.roots)
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH):
                batch = whole.slice(at, BATCH)
                y = batch.column(len(by)).to_numpy(zero_copy_only=False)
                x = np.array(batch.column(len(by) + 1).flatten().to_numpy(zero_copy_only=False)).reshape(len(y), -1)
                p = 1.0 / (1.0 + np.exp(-2.0 * trees.sums(x)))
                clipped = np.clip(p, CLIP, 1.0 - CLIP)
                loss = -(y[:, None] * np.log(clipped) + (1.0 - y)[:, None] * np.log(1.0 - clipped))
                wrong = (p > 0.5) != (y > 0.5)[:, None]
                keys = list(zip(*[batch.column(i).to_pylist() for i in range(len(by))], strict=True)) if by else [()] * len(y)
                for key in dict.fromkeys(keys):
                    own = np.fromiter((k == key for k in keys), bool, len(keys))
                    columns = [pa.array([v] * rounds, batch.column(i).type) for i, v in enumerate(key)]
                    columns += [pa.array(np.arange(1, rounds + 1, dtype=np.int32)), pa.array(np.full(rounds, own.sum()))]
                    columns += [pa.array(loss[own].sum(0)), pa.array(wrong[own].sum(0))]
                    yield pa.RecordBatch.from_arrays(columns, [*by, "round", "n", "loss", "wrong"])

    sums = rows.mapInArrow(score, schema).groupBy(*by, "round").agg(F.sum("n").alias("n"), F.sum("loss").alias("loss"), F.sum("wrong").alias("wrong"))
    return sums.select(*by, "round", "n", (F.col("loss") / F.col("n")).alias("logloss"), (F.col("wrong") / F.col("n")).alias("error"))
