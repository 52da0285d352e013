"""Language identification by error-correcting output codes.

Every language has a codeword of bits. One binary classifier per bit tells from character 3-grams whether the bit is
set; it weighs each 3-gram by the log-ratio of its probabilities in the languages on either side. Decoding sums
a logistic loss over the bits for each codeword, each bit by its reliability, and takes the codeword of least loss.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.frames import grouped, records

UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")
#: 3-grams are hashed into this many features.
FEATURES = 4096
#: Added to the count of every feature of every language.
SMOOTH = 0.5
#: Mean margin of a text of the language itself, in units of the logistic loss.
SCALE = 4.0
#: Languages up to this number get all distinct splits as bits, more of them random splits.
EXHAUSTIVE = 6
#: Below this score, or with a mean bit margin of the wrong sign, the decoding is ambiguous.
AMBIGUOUS = 0.6
#: Bytes of one text that are counted at a time.
STEP = 1 << 20
FOLD = np.full(256, 32, np.uint8)
FOLD[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
FOLD[128:] = np.arange(128, 256)


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """An array of ``n`` rows of +1 and -1: all splits of few languages, else ``12 * log2(n)`` random balanced ones."""
    if n <= 1:
        return np.ones((n, 1), np.int8)
    if n <= EXHAUSTIVE:
        rest = range(1, n)
        sides = [set(c) for k in range(1, n) for c in combinations(rest, k)]  # language 0 is always on the other side
        return np.array([[1 if i in side else -1 for side in sides] for i in range(n)], np.int8)
    rng, bits = np.random.default_rng(seed), int(np.ceil(12 * np.log2(n)))
    return np.array([rng.permutation(np.resize([1, -1], n)) for _ in range(bits)], np.int8).T


def histogram(texts: list[str]) -> np.ndarray:
    """Counts of the hashed 3-grams with a letter in the middle: a row per text."""
    out = np.zeros((len(texts), FEATURES), np.float32)
    for i, t in enumerate(texts):
        raw = FOLD[np.frombuffer(f" {t.lower()} ".encode("utf-8", "surrogatepass"), np.uint8)]
        for at in range(0, max(len(raw) - 2, 0), STEP):
            b = raw[at : at + STEP + 2].astype(np.uint32)
            h = (b[:-2] * np.uint32(0x9E3779B1) + b[1:-1] * np.uint32(0x85EBCA6B) + b[2:] * np.uint32(0xC2B2AE35)) >> np.uint32(7)
            out[i] += np.bincount((h ^ (h >> np.uint32(12)))[b[1:-1] != 32] % FEATURES, minlength=FEATURES)
    return out


@dataclass(frozen=True)
class CodeModel:
    """Languages, their codewords, and per bit the weight of every feature and the weight of the bit."""

    languages: list[str]
    codes: np.ndarray
    weights: np.ndarray
    reliability: np.ndarray

    @classmethod
    def of_counts(cls, counts: dict[str, np.ndarray]) -> CodeModel:
        languages = sorted(counts)
        codes = codewords(len(languages))
        if not languages:
            return cls([], codes, np.zeros((FEATURES, 1), np.float32), np.ones(1))
        p = np.stack([counts[x] + SMOOTH for x in languages])
        p /= p.sum(axis=1, keepdims=True)
        if len(languages) == 1:
            return cls(languages, codes, np.zeros((FEATURES, 1), np.float32), np.ones(1))
        on = (codes.T > 0).astype(float)
        odds = np.log((on @ p) / on.sum(axis=1, keepdims=True)) - np.log(((1 - on) @ p) / (1 - on).sum(axis=1, keepdims=True))
        margins = (p @ odds.T) * codes  # of the mean text of each language, positive when right
        mean, least = margins.mean(axis=0), margins.min(axis=0)
        return cls(languages, codes, (odds * (SCALE / np.maximum(mean, 1e-9))[:, None]).T.astype(np.float32), np.clip(least / np.maximum(mean, 1e-9), 0.05, 1.0))

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and ambiguity of each text."""
        known = np.array([bool(LETTER.search(t)) for t in texts], bool) & bool(self.languages)
        pred, score, unclear = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        rows = np.flatnonzero(known)
        for part in np.array_split(rows, max(1, len(rows) // 256)):
            if not len(part):
                continue
            h = histogram([texts[i] for i in part])
            margin = (h @ self.weights) / np.maximum(h.sum(axis=1, keepdims=True), 1)
            loss = np.logaddexp(0, -margin[:, None, :] * self.codes[None]) @ self.reliability
            best = loss.argmin(axis=1)
            chance = np.exp(loss.min(axis=1, keepdims=True) - loss)
            top = chance.max(axis=1) / chance.sum(axis=1)
            agreed = (margin * self.codes[best]) @ self.reliability
            for i, b, s, a in zip(part, best, top, agreed, strict=True):
                pred[i], score[i], unclear[i] = self.languages[b], s, s < AMBIGUOUS or (len(self.languages) > 1 and a <= 0)
        return pred, score, unclear


def held_out(key: str = "doc_id") -> Column:
    """Whether a row is kept from training."""
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string")), F.lit(4)) == 2, F.lit(False))


def train(docs: DataFrame, language: str = "lang", text: str = "text") -> CodeModel:
    """The model of all rows with a language and a text. The counts of a language are summed inside each task first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for part, texts in grouped(batches, "_text"):
            languages = np.array(part.column(0).to_pylist(), object)
            for name in set(languages):
                for rows in np.array_split(np.flatnonzero(languages == name), len(texts) // 256 + 1):
                    if len(rows):
                        totals[name] = totals.get(name, 0) + histogram([texts[i] for i in rows]).sum(axis=0, dtype=float)
        for name, n in totals.items():
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n], pa.list_(pa.float64()))], ["language", "n"])

    rows = docs.select(F.col(language).alias("_language"), F.col(text).alias("_text")).dropna()
    sums = rows.mapInArrow(count, "language string, n array<double>").select("language", F.posexplode("n").alias("feature", "n"))
    found = sums.groupBy("language", "feature").agg(F.sum("n").alias("n")).groupBy("language").agg(F.sort_array(F.collect_list(F.struct("feature", "n"))).alias("n"))
    return CodeModel.of_counts({r["language"]: np.array([x["n"] for x in r["n"]]) for r in found.collect()})  # one vector for each language


def identify(docs: DataFrame, keys: list[str], model: CodeModel, text: str = "text") -> DataFrame:
    """``keys`` with ``lang_pred``, ``score`` (0 to 1) and ``ambiguous`` for every row.

    A text that is null or has no letter is ``und`` with score 0 and ambiguous. Repeated rows get equal answers, and
    columns beside ``keys`` and ``text`` are not looked at.
    """
    source = docs.select(*keys, F.col(text).alias("_text"))
    out = docs.select(*keys, F.lit("").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(False).alias("ambiguous")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in grouped(batches, "_text"):
            pred, score, unclear = model.predict(texts)
            schema = pa.schema([part.schema.field(k) for k in keys] + [("lang_pred", pa.string()), ("score", pa.float64()), ("ambiguous", pa.bool_())])
            yield records({k: part.column(i) for i, k in enumerate(keys)} | {"lang_pred": pred, "score": score, "ambiguous": unclear}, schema)

    return source.mapInArrow(run, out)


def keep_identified(docs: DataFrame, model: CodeModel, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose language is found and not ambiguous, unchanged."""
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in grouped(batches, docs_text):
            pred, _, unclear = model.predict(texts)
            yield part.filter(pa.array([p != UNKNOWN and not u for p, u in zip(pred, unclear, strict=True)], pa.bool_()))

    docs_text = docs.columns[at]
    return docs.mapInArrow(run, docs.schema)
