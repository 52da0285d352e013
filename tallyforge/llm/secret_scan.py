"""Secrets in text: three fixed patterns, and character Markov models for strings that no pattern names.

Two first-order models over characters, one of random strings and one of ordinary identifiers, are trained from
labelled samples; a candidate run of key characters is a secret when the log-likelihood ratio per character of the two
is above a threshold. The labels come from the patterns: what they match is random, the other words of the same texts
are ordinary.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.frames import grouped, records

# The patterns by kind, in the order in which equal starts are listed, and the least length of what counts.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")  # the run after AKIA is as long as it can be, so its least length can stand in the pattern
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_LEAST = 12

#: A candidate for the models: a run of key characters of at least this length with a letter.
RUN = re.compile(r"[A-Za-z0-9+/_=-]{12,}")
LETTER = re.compile(r"[A-Za-z]")
ORDINARY = re.compile(r"[A-Za-z_][A-Za-z0-9_-]{5,}")
#: Training texts: those with the smallest hash of their id, at most this many; the whole text is read.
TRAIN_TEXTS = 4_000
#: Log-likelihood ratio per character above which a run of SURE characters or more is a secret. A shorter one shows less, so
#: it needs as much in all as one of that length would.
THRESHOLD, SURE = 1.2, 20
#: Added to every transition count.
SMOOTH = 0.5
SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-."
CODE = np.full(128, len(SYMBOLS), np.int64)  # the last code is the border of a string
CODE[[ord(c) for c in SYMBOLS]] = np.arange(len(SYMBOLS))
SIZE = len(SYMBOLS) + 1


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind number, end)`` of the three patterns, sorted."""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def transitions(strings: list[str]) -> np.ndarray:
    """Numbers of the character pairs in the strings, each string between two borders."""
    codes = CODE[np.frombuffer(("~" + "~".join(strings) + "~").encode("ascii"), np.uint8)]
    return np.bincount(codes[:-1] * SIZE + codes[1:], minlength=SIZE * SIZE)


@dataclass(frozen=True)
class MarkovPair:
    """Log-probability ratio of every transition, random against ordinary, row by row."""

    ratio: np.ndarray

    @classmethod
    def of_counts(cls, random: np.ndarray, ordinary: np.ndarray) -> MarkovPair:
        def logs(n: np.ndarray) -> np.ndarray:
            n = n.reshape(SIZE, SIZE) + SMOOTH
            return np.log(n / n.sum(axis=1, keepdims=True))

        return cls((logs(random) - logs(ordinary)).ravel())

    def scores(self, strings: list[str]) -> np.ndarray:
        """Mean log-likelihood ratio per transition of each string."""
        if not strings:
            return np.zeros(0)
        codes = CODE[np.frombuffer(("~" + "~".join(strings) + "~").encode("ascii"), np.uint8)]
        values = self.ratio[codes[:-1] * SIZE + codes[1:]]
        lengths = np.array([len(s) + 1 for s in strings])
        return np.add.reduceat(values, np.concatenate(([0], np.cumsum(lengths)[:-1]))) / lengths


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", limit: int = TRAIN_TEXTS) -> MarkovPair:
    """The pair of models, from at most ``limit`` texts chosen by a hash of ``key``.

    Texts without a label teach nothing; without any text at all both models are flat and no run is above the threshold.
    """
    ids = docs.select(F.col(key).alias("_id")).where(F.col("_id").isNotNull()).distinct().orderBy(F.xxhash64("_id"), "_id").limit(limit)
    sample = docs.select(F.col(key).alias("_id"), F.col(text).alias("_text")).join(F.broadcast(ids), "_id", "left_semi")  # at most ``limit`` ids

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((2, SIZE * SIZE), np.int64)
        for _, texts in grouped(batches, "_text"):
            for t in texts:
                spans = base_spans(t)
                random = [ASSIGN.match(t, s).group(2) if kind == 0 else t[s:e] for s, kind, e in spans]
                ordinary, at = [], 0
                for m in ORDINARY.finditer(t):
                    while at < len(spans) and spans[at][2] <= m.start():
                        at += 1
                    if at == len(spans) or m.end() <= spans[at][0]:
                        ordinary.append(m.group())
                for i, strings in enumerate((random, ordinary)):
                    if strings:
                        totals[i] += transitions(strings)
        model, pair = np.nonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(model, pa.int32()), pa.array(pair, pa.int32()), pa.array(totals[model, pair], pa.int64())], ["model", "pair", "n"])

    rows = sample.mapInArrow(count, "model int, pair int, n long").groupBy("model", "pair").agg(F.sum("n").alias("n")).collect()  # at most 2 * SIZE ** 2
    totals = np.zeros((2, SIZE * SIZE))
    for r in rows:
        totals[r["model"], r["pair"]] = r["n"]
    return MarkovPair.of_counts(totals[0], totals[1])


def needed(length: int, threshold: float = THRESHOLD) -> float:
    """The least mean log-likelihood ratio of a secret of this length."""
    return threshold * max(1.0, SURE / length)


def candidates(text: str, spans: list[tuple[int, int, int]]) -> Iterator[re.Match]:
    """The runs that the models are asked about: all with a letter that do not lie wholly inside one of the spans (sorted).
    A run that a span touches or splits is scored whole."""
    at = 0
    for m in RUN.finditer(text):
        while at < len(spans) and spans[at][2] <= m.start():
            at += 1
        inside = any(s <= m.start() and m.end() <= e for s, _, e in spans[max(0, at - len(KINDS)) : at + len(KINDS)])
        if not inside and LETTER.search(m.group()):
            yield m


def find(texts: list[str], models: MarkovPair, threshold: float = THRESHOLD) -> list[list[tuple[int, int, int]]]:
    """``(start, kind number, end)`` of every secret of every text; what only the models find has kind 3 and may reach beyond
    the spans of the patterns, which stay as they are."""
    found, runs = [], []
    for i, t in enumerate(texts):
        spans = base_spans(t)
        runs += [(i, m.start(), m.end(), m.group()) for m in candidates(t, spans)]
        found.append(spans)
    for (i, start, end, run), score in zip(runs, models.scores([r[3] for r in runs]), strict=True):
        if score > needed(len(run), threshold):
            found[i].append((start, len(KINDS), end))
    return [sorted(spans) for spans in found]


def scan(docs: DataFrame, keys: list[str], models: MarkovPair, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``keys`` and ``secrets``: an array of (kind, start, end) in code points, by start and kind, for every row.

    A null or empty text has none. Repeated rows are scanned like any other; columns beside ``keys`` are not looked at.
    """
    source = docs.select(*keys, F.col(text).alias("_text"))
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    out = docs.select(*keys, F.expr("cast(null as array<struct<kind:string,start:bigint,end:bigint>>) AS secrets")).schema
    names = (*KINDS, "model")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in grouped(batches, "_text"):
            rows = [[{"kind": names[k], "start": s, "end": e} for s, k, e in spans] for spans in find(texts, models, threshold)]
            schema = pa.schema([part.schema.field(k) for k in keys] + [("secrets", kind)])
            yield records({k: part.column(i) for i, k in enumerate(keys)} | {"secrets": rows}, schema)

    return source.mapInArrow(run, out)


def redact(docs: DataFrame, models: MarkovPair, text: str = "text", mark: str = "[secret]", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by ``mark``; all rows and the other columns stay as they are."""
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in grouped(batches, text):
            column = part.column(at).to_pylist()
            for i, spans in enumerate(find(texts, models, threshold)):
                if spans:
                    kept, end = [], 0
                    for s, _, e in spans:
                        if s >= end:
                            kept += [column[i][end:s], mark]
                        end = max(end, e)
                    column[i] = "".join([*kept, column[i][end:]])
            arrays = [pa.array(column, part.schema.field(at).type) if i == at else part.column(i) for i in range(part.num_columns)]
            yield pa.RecordBatch.from_arrays(arrays, schema=part.schema)

    return docs.mapInArrow(run, docs.schema)
