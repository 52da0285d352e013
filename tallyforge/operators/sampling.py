"""Repeatable samples, splits, folds and global ranks.

Rows are ordered by a hash of their key alone; only rows that share that hash with the row at an edge are told apart, by
a hash of the whole row, and rows that are equal throughout by their number. A sample of exact size needs the hash at
one rank: counts per prefix lead to it in a few steps, each over the rows of the prefix found before, and every row is
then compared with it where it lies. For unique keys only the key column is read. Null and repeated keys are ordinary
rows: no row is lost, and sizes are exact.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyforge.functions.hashing import fold_number, hash_int, row_hash
from tallyforge.operators.order_stats import values_at_ranks

#: Hex digits that form a sort group of :func:`global_rank`.
PREFIX_DIGITS = 4

#: Lengths of the prefixes that are counted one after the other. A step brings at most 65,536 counts to the driver, the
#: last ones those of the hashes that share 48 bits.
STEPS = (4, 8, 12, 32)

#: A prefix with at most this many rows is fetched and sorted on the driver (under 1 MB).
FETCHED = 10_000


def _content(df: DataFrame, seed: int | str) -> Column:
    """32 hex digits: the hash of the whole row with the places of its NULLs."""
    values = [F.col(f"`{c}`") for c in df.columns]
    known = F.concat(*[F.when(c.isNull(), "0").otherwise("1") for c in values])
    halves = [F.lpad(F.hex(F.xxhash64(F.lit(f"{part}:{seed}"), known, *values)), 16, "0") for part in ("a", "b")]
    return F.concat(*halves)


def _at_rank(hashed: DataFrame, rank: Callable[[int], int]) -> tuple[str, int, int]:
    """Of one column ``h`` of 32 hex digits: the value at the wanted 1-based rank (given the number of rows; below 1 for
    none), which of its equals that is, and how many there are."""
    prefix, last, at = "", 0, None
    for length in STEPS:
        inside = hashed.where(F.substring("h", 1, last) == prefix) if last else hashed
        counts = inside.groupBy(F.substring("h", 1, length).alias("p")).agg(F.count(F.lit(1)).alias("c")).toArrow().sort_by("p")
        upto = np.cumsum(counts.column("c").to_numpy())
        if at is None:
            at = rank(int(upto[-1]) if len(upto) else 0)
            if at < 1:
                return "", 0, 0
        i = int(np.searchsorted(upto, at))
        here = counts.column("c")[i].as_py()
        prefix, last, at = counts.column("p")[i].as_py(), length, int(at - (upto[i] - here))
        if last < STEPS[-1] and here <= FETCHED:
            found = hashed.where(F.col("h").startswith(prefix)).toArrow().column("h")
            found = found.take(pc.array_sort_indices(found))
            edge = found[at - 1]
            equal = np.flatnonzero(pc.equal(found, edge).to_numpy())
            return edge.as_py(), int(at - equal[0]), len(equal)
    return prefix, at, here


def _mark(df: DataFrame, key: str, name: str = "is_train", seed: int | str = 42, fraction: float | None = None, size: int | None = None) -> DataFrame:
    """``name`` tells whether a row is among the first, ``size`` of them or ``floor(fraction * n)``, at most all.

    The edge is looked up when the frame is made, by two or three jobs over the key. Where it falls among rows of one
    key, the same is done once more over those rows; of rows that are equal throughout as many are taken as are needed.
    """
    wanted = (lambda n: min(size, n)) if fraction is None else (lambda n: math.floor(fraction * n))
    edge, at, equal = _at_rank(df.select(row_hash(key, seed).alias("h")), wanted)
    own = row_hash(key, seed)
    if at == equal:  # also when nothing is taken: no hash is below an empty one
        return df.withColumn(name, own <= edge)
    tied = df.where(own == edge)
    inner, among, same = _at_rank(tied.select(_content(df, seed).alias("h")), lambda _: at)
    apart = F.when(own == edge, _content(df, seed) <= inner).otherwise(own < edge)
    if among == same:
        return df.withColumn(name, apart)
    last = (own == edge) & (_content(df, seed) == inner)
    number = F.row_number().over(Window.partitionBy("_h").orderBy("_h"))
    cut = df.where(last).withColumn("_h", F.lit(inner)).withColumn(name, number <= among).drop("_h")
    return df.where(~last).withColumn(name, apart).unionByName(cut)


def sample_n(df: DataFrame, key: str, n: int, seed: int | str = 42) -> DataFrame:
    """Exactly ``n`` random rows, or the whole frame when it is smaller."""
    return split_n(df, key, n, seed)[0]


def split_n(df: DataFrame, key: str, n: int, seed: int | str = 42) -> tuple[DataFrame, DataFrame]:
    """Exactly ``n`` random rows and the rest; disjoint, together the whole frame."""
    marked = _mark(df, key, "_taken", seed, size=n)
    return marked.where("_taken").drop("_taken"), marked.where("not _taken").drop("_taken")


def mark_split(df: DataFrame, key: str, fraction: float = 0.75, seed: int | str = 42) -> DataFrame:
    """Add ``is_train``: true for exactly ``floor(fraction * n)`` random rows."""
    return _mark(df, key, seed=seed, fraction=fraction)


def split_exact(df: DataFrame, key: str, fraction: float = 0.75, seed: int | str = 42) -> tuple[DataFrame, DataFrame]:
    """Train and test rows; disjoint, together the whole frame."""
    marked = _mark(df, key, "_train", seed, fraction=fraction)
    return marked.where("_train").drop("_train"), marked.where("not _train").drop("_train")


def mark_split_ordered(df: DataFrame, key: str, fraction: float = 0.7, seed: int | str = 42) -> DataFrame:
    """Add ``is_train``: true for the first ``floor(fraction * n)`` rows in key order (numeric key), null keys last.

    Rows that share the key at the edge are ordered by their hash; where all of them are taken, the mark is a comparison
    with the key. The edge is looked up when the frame is made.
    """
    keys = df.select(key)
    n, known = keys.agg(F.count(F.lit(1)), F.count(key)).first()
    size = math.floor(fraction * n)
    if size < 1:
        return df.withColumn("is_train", F.lit(False))
    if size <= known:
        value = values_at_ranks(keys, key, {"last": (fraction, lambda _: F.lit(size - 1))}).first()["value"]
        edge = F.lit(value).cast(df.schema[key].dataType)
        before, tied = F.coalesce(F.col(key) < edge, F.lit(False)), F.coalesce(F.col(key) == edge, F.lit(False))
    else:
        before, tied = F.col(key).isNotNull(), F.col(key).isNull()
    n_before, n_tied = keys.agg(F.count(F.when(before, 1)), F.count(F.when(tied, 1))).first()
    if n_before + n_tied == size:
        return df.withColumn("is_train", before | tied)
    some = _mark(df.where(tied), key, seed=seed, size=size - n_before)
    return df.where(~tied).withColumn("is_train", before).unionByName(some)


def split_ordered(df: DataFrame, key: str, fraction: float = 0.7) -> tuple[DataFrame, DataFrame]:
    """The first rows in key order, and the rest; together the whole frame."""
    marked = mark_split_ordered(df, key, fraction)
    return marked.where("is_train").drop("is_train"), marked.where("not is_train").drop("is_train")


def mark_split_hash(df: DataFrame, key: str, fraction: float = 0.75, seed: int | str = 42) -> DataFrame:
    """Add ``is_train`` by the first 16 bits of the hash: no sort, sizes approximate."""
    return df.withColumn("is_train", F.floor(hash_int(key, seed) / 65536) < round(fraction * 65536))


def with_folds(df: DataFrame, key: str, k: int = 10, seed: int | str = 42) -> DataFrame:
    return df.withColumn("fold", fold_number(key, k, seed))


def global_rank(df: DataFrame, key: str, seed: int | str = 42, digits: int = PREFIX_DIGITS, unique: bool = False) -> DataFrame:
    """Add ``rank``: 1..n in the order of the samples, sorted group by group instead of in one task.

    Only the key's hash prefix decides the group; the offsets sent to every executor are one row per prefix, at most
    ``16**digits`` rows. A key that holds a large share of the rows is one sort group, which spills to disk. With
    ``unique`` keys rows are not hashed as a whole, so only the columns that are asked for are read.
    """
    rows = df.withColumn("_h", row_hash(key, seed)).withColumn("_p", F.substring("_h", 1, digits))
    counts = df.select(F.substring(row_hash(key, seed), 1, digits).alias("_p")).groupBy("_p").agg(F.count(F.lit(1)).alias("_c"))
    offsets = counts.select("_p", (F.sum("_c").over(Window.partitionBy().orderBy("_p")) - F.col("_c")).alias("_start"))
    order = ["_h"] if unique else ["_h", _content(df, seed)]
    within = F.row_number().over(Window.partitionBy("_p").orderBy(*order))
    ranked = rows.withColumn("_r", within).join(F.broadcast(offsets), "_p")
    return ranked.withColumn("rank", F.col("_start") + F.col("_r")).drop("_h", "_p", "_r", "_start")
