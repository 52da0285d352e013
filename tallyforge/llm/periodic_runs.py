"""Periodic runs of words, found in tiles.

A run is a maximal stretch with smallest period ``q`` that is at least ``max(12, 2 * q)`` words long: a maximal stretch of
at least ``max(q, 12 - q)`` positions at which the word ``q`` further on is the same. Periods are handled by octave. In an
octave of periods from ``low`` up to ``high`` boundaries stand every ``step`` words, so close that every such stretch holds
one. A document is cut into overlapping tiles per octave, each with its boundaries and the words that a period of the
octave and one step can reach from them; a tile none of whose boundaries repeats even half a step of words at a
distance of the octave can hold no part of a run and is not made. Tiles are solved on their own, wherever they
land: the Z-function of what follows a boundary, and that of what precedes it read backwards, give for every
period how far it reaches to the right and to the left, at most one step. A stretch that ends within a step is
complete; one that reaches a whole step is a fragment, which continues in the next tile. Fragments go to their
document and period, where touching ones are stitched.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StringType, StructField, StructType
from pyspark.sql.window import Window

from tallyforge.llm.frames import grouped, stored

#: Shortest run, in words.
SHORTEST = 12
#: The lowest octave: periods 1 to 7, boundaries every 6 words.
FIRST = (1, 8, 6)
#: Words that a tile's boundaries span, at least one boundary.
TILE_WORDS = 4096
#: Tiles that one task solves, about: a few seconds.
TASK_TILES = 2_000
ID_BITS = 36

RUNS = "array<struct<start:bigint,period:bigint,length:bigint>>"


def octaves(longest: int) -> Iterator[tuple[int, int, int]]:
    """``low, high, step`` of the octaves whose periods fit twice into ``longest`` words."""
    low, high, step = FIRST
    while 2 * low <= longest:
        yield low, high, step
        low, high, step = high, 2 * high, high


def least_stretch(q):
    """Positions at which a period ``q`` must hold on end."""
    return np.maximum(q, SHORTEST - q)


# ---- words


def split_words(texts: list[str]) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts and the number of words of each; words are parted by ASCII white space."""
    lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pa.array(texts, pa.string())))
    words = lists.flatten()
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    empty = np.fromiter((not t for t in pc.ascii_trim_whitespace(pa.array(texts, pa.string())).to_pylist()), bool, len(texts))
    if empty.any():  # an empty text is split into one empty word
        words = words.filter(pa.array(np.repeat(~empty, counts)))
        counts[empty] = 0
    return words, counts


# ---- tiles


def _mixed(ids: np.ndarray) -> np.ndarray:
    """Well spread 64-bit numbers for small ones."""
    x = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x632BE59BD9B4E019)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


BASE = 0x5851F42D4C957F2D
INVERSE = pow(BASE, -1, 1 << 64)


class BlockHashes:
    """Hashes of all blocks of a length: equal blocks have equal ones. Sums of powers modulo 2**64, shifted back to the block."""

    def __init__(self, ids: np.ndarray) -> None:
        n = len(ids)
        power = np.full(n, BASE, np.uint64)
        back = np.full(n, INVERSE, np.uint64)
        power[0] = back[0] = 1
        self.back = np.cumprod(back, dtype=np.uint64)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_mixed(ids) * np.cumprod(power, dtype=np.uint64), dtype=np.uint64, out=self.sums[1:])

    def of(self, length: int) -> np.ndarray:
        """For each place where a block of ``length`` begins; the last places, where none does, have numbers of their own."""
        n = len(self.back)
        out = np.arange(n, dtype=np.uint64)
        if n >= length:
            out[: n - length + 1] = (self.sums[length:] - self.sums[: n - length + 1]) * self.back[: n - length + 1]
        return out


def marked(hashes: BlockHashes, low: int, high: int, step: int) -> np.ndarray:
    """Boundaries, every ``step`` places, beside which half a step of words, read forwards from the boundary or up to it,
    is repeated at a distance of the octave."""
    half = step // 2
    h = hashes.of(half)
    n = len(h)
    rows = max(n - low, 0) // step + 1
    hit = np.zeros(rows, bool)
    padded = np.append(h, np.uint64(0xFFFFFFFFFFFFFFFF))
    for shift in (0, half):  # the block begins at the boundary, or ends there
        at = np.arange(rows) * step - shift
        inside = at >= 0
        own = padded[np.where(inside, at, n)]
        if step == low and high == 2 * low:
            # the blocks at distances low to high of all boundaries are the places themselves, row by row
            rest = h[step - shift :]
            k = min(rows, len(rest) // step)
            hit[:k] |= inside[:k] & (rest[: k * step].reshape(k, step) == own[:k, None]).any(1)
            for r in range(k, rows):
                hit[r] |= inside[r] and bool((rest[r * step : (r + 1) * step] == own[r]).any())
        else:
            for q in range(low, high):
                hit |= inside & (at + q < n) & (own == padded[np.clip(at + q, 0, n)])
    return np.flatnonzero(hit) * step


def tiles_of(ids: np.ndarray, counts: np.ndarray) -> Iterator[tuple[int, int, int, np.ndarray, np.ndarray]]:
    """``(document, low, first word, words, boundaries)`` of the tiles that may hold a part of a run.

    All documents are searched together, with a word of its own between any two, so that nothing repeats across.
    """
    number = np.arange(len(counts))
    for low, high, step in octaves(int(counts.max(initial=0))):
        long = counts[number] >= max(SHORTEST, 2 * low)
        number = number[long]
        if not len(number):
            return
        sizes = counts[number]
        begins = np.r_[0, np.cumsum(sizes + 1)[:-1]]
        joined = np.empty(int((sizes + 1).sum()), np.int64)
        between = np.zeros(len(joined), bool)
        between[begins + sizes] = True
        joined[between] = -1 - np.arange(len(number))
        kept = np.zeros(len(counts), bool)
        kept[number] = True
        joined[~between] = ids[np.repeat(kept, counts)]
        found = marked(BlockHashes(joined), low, high, step)
        owner = np.searchsorted(begins, found, side="right") - 1
        span = max(step, TILE_WORDS // step * step)
        tile = found // span
        cuts = np.flatnonzero((owner[1:] != owner[:-1]) | (tile[1:] != tile[:-1])) + 1
        for group in np.split(np.arange(len(found)), cuts) if len(found) else []:
            d = owner[group[0]]
            start, stop = begins[d], begins[d] + sizes[d]
            first = max(start, found[group[0]] - step)
            last = min(stop, found[group[-1]] + high + step)
            yield int(number[d]), low, int(first - start), joined[first:last].astype(np.int32), (found[group] - first).astype(np.int32)


# ---- one tile


def z_function(s: list[int]) -> list[int]:
    """For each place how many words from there on equal those from the beginning on."""
    n = len(s)
    z = [0] * n
    if n:
        z[0] = n
    left = right = 0
    for i in range(1, n):
        k = 0
        if i < right:
            k = z[i - left]
            if k < right - i:
                z[i] = k
                continue
            k = right - i
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        left, right = i, i + k
    return z


@lru_cache(1 << 16)
def _prime_factors(n: int) -> list[int]:
    out, p = [], 2
    while p * p <= n:
        if n % p == 0:
            out.append(p)
            while n % p == 0:
                n //= p
        p += 1
    return out + [n] if n > 1 else out


def fragments(words: list[int], boundaries: list[int], low: int, high: int, step: int) -> dict[int, list[list[int]]]:
    """By period: stretches ``[begin, end]`` of places at which the period holds; each is complete and long enough, or
    reaches a whole step from its boundary. Touching ones are one. Periods that are multiples of a smaller one are left out."""
    found: dict[int, list[list[int]]] = {}
    for c in boundaries:
        after = z_function(words[c : c + high + step])
        back = words[max(0, c - step) : c][::-1]
        ahead = words[max(0, c - step) : c + high][::-1]
        before = z_function(back + [None] + ahead)
        at, reach = len(back) + 1, min(c + high, len(words)) - c
        for q in range(low, min(high, len(words) - c + 1)):
            r = min(after[q], step) if q < len(after) else 0
            j = at + reach - q
            z = before[j] if j < len(before) else 0
            l = min(z, step)
            if l + r == 0 or (l < step and r < step and l + r < least_stretch(q)):
                continue
            if any(after[q // p] >= q - q // p for p in _prime_factors(q)):
                continue
            held = found.setdefault(q, [])
            if held and held[-1][1] >= c - l:
                held[-1][0], held[-1][1] = min(held[-1][0], c - l), max(held[-1][1], c + r)
            else:
                held.append([c - l, c + r])
    return found


# ---- the operator


def find_runs(
    docs: DataFrame, keys: list[str], text: str = "text", rewrite: Callable[[list, int], np.ndarray | None] | None = None, with_text: bool = False
) -> DataFrame:
    """``keys`` with ``runs (start, period, length)``, by start and then period, ``n_words`` and ``collapsed_sha256``, the
    digest of the text without the repetitions: of every run only its first period stays, words are joined by single
    spaces. ``with_text`` adds that text as ``collapsed``.

    ``rewrite`` may name other words for a row: given its keys and its number of words, the numbers of the words to take
    in their order, as many as there were. Null, empty and blank texts have no words and no runs. Every row gives one
    row, repeated ones too. A document of any length is tiled; only its words are held by the task that reads it. An
    empty table gives an empty one. Columns that are not named are not looked at.
    """
    source = docs.select(*[F.col(f"`{k}`") for k in keys], F.col(f"`{text}`").alias("_text"))
    own = [f for f in source.schema.fields if f.name != "_text"]
    fields = [StructField("_row", LongType()), *own, StructField("_low", IntegerType()), StructField("_first", LongType()), StructField("_ids", BinaryType()),
              StructField("_marks", BinaryType()), StructField("_words", StringType()), StructField("_n", LongType()), StructField("_sha", StringType())]
    schema = StructType(fields)

    def tile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << ID_BITS
        for part, texts in grouped(batches, "_text"):
            words, counts = split_words(texts)
            if rewrite is not None:
                words = _rewritten(words, counts, part, len(own), rewrite)
            ids = pc.dictionary_encode(words).indices.to_numpy(zero_copy_only=False).astype(np.int64)
            docs_out: dict[str, list] = {f.name: [] for f in fields[1 + len(own) :]}
            rows, takes, tiled = [], [], set()
            for d, low, first, some, marks in tiles_of(ids, counts):
                tiled.add(d)
                rows.append(row + d)
                takes.append(d)
                for name, value in zip(docs_out, (low, first, some.tobytes(), marks.tobytes(), None, None, None), strict=True):
                    docs_out[name].append(value)
                if len(rows) >= 2000:
                    yield _batch(part, own, schema, rows, takes, docs_out)
                    rows, takes, docs_out = [], [], {k: [] for k in docs_out}
            joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)], pa.int32()), words), " ").to_pylist()
            for d, line in enumerate(joined):
                rows.append(row + d)
                takes.append(d)
                sha = None if d in tiled else hashlib.sha256(line.encode()).hexdigest()
                for name, value in zip(docs_out, (None, None, None, None, line if with_text or d in tiled else None, int(counts[d]), sha), strict=True):
                    docs_out[name].append(value)
            yield _batch(part, own, schema, rows, takes, docs_out)
            row += len(texts)

    spread = stored(source.mapInArrow(tile, schema), "run-tiles")
    pieces = spread.where("_low is not null").select("_row", "_low", "_first", "_ids", "_marks")
    pieces = pieces.repartition(1 + pieces.count() // TASK_TILES, "_row", "_low", "_first")  # their bytes say little about their work
    parts = pieces.mapInArrow(_solve, "_row long, q long, a long, b long")
    runs = stitch(parts).groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))
    whole = spread.where("_low is null").drop("_low", "_first", "_ids", "_marks")
    plain = whole.where("_sha is not null")
    out = ["_n AS n_words", "runs", "_sha AS collapsed_sha256"] + ["_words AS collapsed"] * with_text
    named = [f"`{f.name}`" for f in own]
    plain = plain.withColumn("runs", F.array().cast(RUNS)).selectExpr(*named, *out)
    found = whole.where("_sha is null").drop("_sha").join(runs, "_row", "left")
    found = found.withColumn("runs", F.coalesce("runs", F.array().cast(RUNS)))
    shape = StructType([*own, StructField("_n", LongType()), found.schema["runs"], StructField("_words", StringType()), StructField("_sha", StringType())])
    collapsed = found.select(*named, "_n", "runs", "_words").mapInArrow(lambda batches: _collapse(batches, len(own)), shape)
    return plain.unionByName(collapsed.selectExpr(*named, *out))


def stitch(parts: DataFrame) -> DataFrame:
    """Runs ``_row, period, start, length`` of fragments ``_row, q, a, b`` that touch or overlap; too short ones are left out."""
    line = Window.partitionBy("_row", "q").orderBy("a", "b")
    before = F.max("b").over(line.rowsBetween(Window.unboundedPreceding, -1))
    opened = parts.withColumn("new", F.coalesce((F.col("a") > before).cast("int"), F.lit(0)))
    numbered = opened.withColumn("k", F.sum("new").over(line.rowsBetween(Window.unboundedPreceding, 0)))
    whole = numbered.groupBy("_row", "q", "k").agg(F.min("a").alias("start"), F.max("b").alias("b"))
    long = whole.where(F.col("b") - F.col("start") >= F.greatest(F.col("q"), F.lit(SHORTEST) - F.col("q")))
    return long.select("_row", F.col("q").alias("period"), "start", (F.col("b") - F.col("start") + F.col("q")).alias("length"))


def _batch(part: pa.RecordBatch, own: list, schema: StructType, rows: list[int], takes: list[int], columns: dict[str, list]) -> pa.RecordBatch:
    kinds = {"_low": pa.int32(), "_first": pa.int64(), "_ids": pa.binary(), "_marks": pa.binary(), "_words": pa.string(), "_n": pa.int64(), "_sha": pa.string()}
    at = pa.array(takes, pa.int64())
    arrays = [pa.array(rows, pa.int64())] + [part.column(i).take(at) for i in range(len(own))] + [pa.array(v, kinds[k]) for k, v in columns.items()]
    return pa.RecordBatch.from_arrays(arrays, schema.names)


def _rewritten(words: pa.Array, counts: np.ndarray, part: pa.RecordBatch, n_keys: int, rewrite: Callable) -> pa.Array:
    keys = list(zip(*[part.column(i).to_pylist() for i in range(n_keys)], strict=True))
    order, start, changed = np.arange(len(words)), 0, False
    for key, n in zip(keys, counts.tolist(), strict=True):
        taken = rewrite(key, n)
        if taken is not None:
            order[start : start + n] = start + taken
            changed = True
        start += n
    return words.take(pa.array(order)) if changed else words


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["_row", "q", "a", "b"]
    bands = {low: (high, step) for low, high, step in octaves(1 << 62)}
    for batch in batches:
        out: list[tuple[int, int, int, int]] = []
        rows, lows, firsts = (batch.column(i).to_pylist() for i in range(3))
        for k in range(batch.num_rows):
            words = np.frombuffer(batch.column(3)[k].as_buffer(), np.int32).tolist()
            marks = np.frombuffer(batch.column(4)[k].as_buffer(), np.int32).tolist()
            for q, held in fragments(words, marks, lows[k], *bands[lows[k]]).items():
                out += [(rows[k], q, firsts[k] + a, firsts[k] + b) for a, b in held]
            if len(out) > 100_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names)


def _collapse(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for n, runs, text in zip(*[batch.column(n_keys + i).to_pylist() for i in range(3)], strict=True):
            if runs:
                edge = np.zeros(n + 1, np.int64)
                for r in runs:
                    edge[r["start"] + r["period"]] += 1
                    edge[r["start"] + r["length"]] -= 1
                kept = np.cumsum(edge)[:n] == 0
                text = " ".join([w for w, k in zip(text.split(" "), kept.tolist(), strict=True) if k])
            texts.append(text)
        sha = [hashlib.sha256(t.encode()).hexdigest() for t in texts]
        arrays = [batch.column(i) for i in range(n_keys + 2)] + [pa.array(texts, pa.string()), pa.array(sha, pa.string())]
        yield pa.RecordBatch.from_arrays(arrays, [*batch.schema.names[: n_keys + 2], "_words", "_sha"])
