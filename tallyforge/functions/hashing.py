"""Repeatable pseudo-random columns: a function of row key and seed only.

The same rows are picked after a lost executor, with any partitioning, and by any engine with md5.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyforge.functions.columns import ColumnOrName, col


def row_hash(key: ColumnOrName, seed: int | str = 42) -> Column:
    """32 hex digits from the key and the seed; a NULL key counts as an empty text."""
    return F.md5(F.concat(F.coalesce(col(key).cast("string"), F.lit("")), F.lit(f":{seed}")))


def hash_int(key: ColumnOrName, seed: int | str = 42) -> Column:
    """The first 32 bits of :func:`row_hash` as a non-negative bigint."""
    return F.conv(F.substring(row_hash(key, seed), 1, 8), 16, 10).cast("bigint")


def hash_uniform(key: ColumnOrName, seed: int | str = 42) -> Column:
    """Uniform value in (0, 1)."""
    return (hash_int(key, seed) + 0.5) / 4294967296.0


def fold_number(key: ColumnOrName, k: int, seed: int | str = 42) -> Column:
    """Cross-validation fold 0..k-1."""
    return (hash_int(key, seed) % k).cast("int")


def pick(key: ColumnOrName, options: list, seed: int | str = 42) -> Column:
    """One of the options per row, with replacement."""
    return F.element_at(F.array(*[F.lit(o) for o in options]), (hash_int(key, seed) % len(options) + 1).cast("int"))
