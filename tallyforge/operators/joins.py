"""Joins of detail tables with lookups, totals and samples."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Largest side, in rows, that is sent to every executor.
BROADCAST_ROWS = 10_000

#: Tasks that share one key when the other side is too large to broadcast.
SALTS = 32


def checked_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """A broadcast side whose size has been measured, or the frame as it is.

    At most ``max_rows + 1`` rows are fetched. When the whole frame fits, it becomes a local relation
    with a broadcast hint, so the big side of the join is never shuffled and the small side is not
    computed twice. Otherwise the frame is returned without a hint and Spark shuffles both sides,
    with skewed partitions split at run time.
    """
    rows = df.limit(max_rows + 1).toArrow()
    if rows.num_rows > max_rows:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))


def attach(
    left: DataFrame, right: DataFrame, keys: tuple[str, ...], how: str = "inner", max_rows: int | None = None
) -> DataFrame:
    """``left`` with the columns of ``right``, which has one row per key; NULL keys match each other.

    A small right side is broadcast. A larger one is repeated once per salt and ``left`` is salted by its
    row hash, so a key that holds a large share of ``left`` is joined by :data:`SALTS` tasks.
    """
    side = checked_broadcast(right, BROADCAST_ROWS if max_rows is None else max_rows)
    on = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    rest = [c for c in right.columns if c not in keys]
    marked = side.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *rest)
    if side is right:
        salt = F.pmod(F.xxhash64(*left.columns), F.lit(SALTS)).cast("int")
        left = left.withColumn("_salt", salt)
        marked = marked.withColumn("_k_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        on.append(F.col("_salt") == F.col("_k_salt"))
    joined = left.join(marked, on, how)
    return joined.drop("_salt", "_k_salt", *[f"_k_{k}" for k in keys])


def with_group_total(
    df: DataFrame, keys: tuple[str, ...], value: Column, name: str, max_rows: int | None = None
) -> DataFrame:
    """Every row with the total of its group; NULL keys form a group, a group of NULLs totals 0.

    The totals are one partial and final aggregation and come back by a join. A window over the keys
    would move the whole table into as many tasks as there are groups; here the detail rows stay where
    they are as long as the totals are few, and hot groups are salted when they are many.
    """
    totals = df.groupBy(*keys).agg(F.coalesce(F.sum(value), F.lit(0.0)).alias(name))
    return attach(df, totals, keys, "left", max_rows)


def semi_lookup(df: DataFrame, lookup: DataFrame, key: str, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Rows whose key is listed; a key listed twice does not multiply rows.

    A long list is not made distinct first: both sides are then plain shuffles, which Spark can split
    where one key is hot.
    """
    listed = lookup.select(key).distinct()
    side = checked_broadcast(listed, max_rows)
    return df.join(lookup.select(key) if side is listed else side, key, "left_semi")


def code_label(df: DataFrame, lookup: DataFrame, code: str, label: str, name: str) -> DataFrame:
    """Add the label of a code; codes without a label keep their row with NULL."""
    small = checked_broadcast(lookup.select(F.col(code), F.col(label).alias(name)))
    return df.join(small, code, "left")


def except_rows(df: DataFrame, taken: DataFrame) -> DataFrame:
    """The rows of ``df`` without those of ``taken``: whole rows are matched, nulls with nulls, one for one.

    A key does not tell rows apart when it is null or repeated, so none is asked for. Equal rows become one row with
    their number before the shuffle. The rest of a sample is cheaper from its mark, see
    :func:`tallyforge.operators.sampling.split_exact`; this is for frames that come from elsewhere.
    """
    return df.exceptAll(taken.select(*[F.col(f"`{c}`") for c in df.columns]))


def union_all(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Stack frames by column name, duplicates kept."""
    return reduce(lambda a, b: a.unionByName(b), others, first)
