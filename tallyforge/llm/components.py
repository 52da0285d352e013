"""Connected components of a link table that is never gathered: star contraction on DataFrames."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.frames import stored

#: Links a task contracts at a time.
BLOCK = 500_000


class UnionFind:
    """Sets of dense positions; the root of a set is its smallest member."""

    def __init__(self, n: int) -> None:
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def union(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        return True


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each block of links as stars: every node with the smallest node its block connects it with."""

    def stars(held: list[np.ndarray]) -> pa.RecordBatch:
        links = np.concatenate(held)
        nodes, at = np.unique(links, return_inverse=True)
        at, sets = at.reshape(links.shape), UnionFind(len(nodes))
        for x, y in at.tolist():
            sets.union(x, y)
        roots = nodes[[sets.find(i) for i in range(len(nodes))]]
        far = roots != nodes
        return pa.RecordBatch.from_arrays([pa.array(nodes[far]), pa.array(roots[far])], ["a", "b"])

    held, n = [], 0
    for batch in batches:
        held.append(np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1)], axis=1))
        n += batch.num_rows
        if n >= BLOCK:
            yield stars(held)
            held, n = [], 0
    if n:
        yield stars(held)


def _large(links: DataFrame) -> DataFrame:
    both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("root"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("root").alias("b")).distinct()


def _small(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("root"))
    moved = down.join(least, "a").where("b <> root").select(F.col("b").alias("a"), F.col("root").alias("b"))
    return moved.unionAll(least.select("a", F.col("root").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``(id, root)`` for every node of ``links (a, b)`` other than the smallest of its component, which is the root.

    Null ends and links of a node with itself connect nothing. Each round is written to the shared folder; the number of
    rounds grows with the logarithm of the largest component's diameter.
    """
    kind = links.schema[0].dataType.simpleString()
    clean = links.toDF("a", "b").where("a is not null and b is not null and a <> b")
    now = stored(clean.mapInArrow(_contract, f"a {kind}, b {kind}"), "links")
    mark = None
    while True:
        now = stored(_small(_large(now)), "links")
        row = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(row) == mark:
            return now.select(F.col("a").alias("id"), F.col("b").alias("root"))
        mark = tuple(row)
