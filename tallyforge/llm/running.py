"""Sums along an order within groups of any size: no window over a group, no group in one task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType
from pyspark.sql.window import Window

from tallyforge.llm.frames import stored
from tallyforge.operators.joins import attach

#: Row numbers of a partition take the lower bits of a row's id.
ID_BITS = 36


def running(df: DataFrame, group: str | None, order: list[str | Column], weight: Column | None = None, name: str = "at") -> DataFrame:
    """``df`` with ``name``, the sum of ``weight`` (1 if absent) over the rows of the same group that stand before a row,
    ``<name>_total``, that of the whole group, and ``row``, a number no other row has.

    Rows are dealt out by range, so a group that holds most of the table lies in many tasks; a task adds up its own part
    of each group, and one row per task and group tells where it begins. A null group is a group. Nulls in the order
    come first; rows that are equal in it stand in any order, which stays as it is once written. Weights are whole
    numbers, none of them null.
    """
    tie = F.monotonically_increasing_id()
    placed = df.select(*[F.col(f"`{c}`") for c in df.columns], (F.lit(1) if weight is None else weight).cast("long").alias("_w"), tie.alias("_tie"))
    by = [F.col(f"`{group}`")] if group else []
    by += [F.col(f"`{c}`") if isinstance(c, str) else c for c in order] + [F.col("_tie")]
    sorted_rows = placed.repartitionByRange(*by).sortWithinPartitions(*by)
    at = placed.columns.index(group) if group else None
    schema = StructType([*df.schema.fields, *[StructField(c, LongType()) for c in ("_w", "row", "_part", name)]])
    kept = len(df.columns)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, total, last = TaskContext.get().partitionId(), 0, 0, None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            w = batch.column(kept).to_numpy(zero_copy_only=False).astype(np.int64)
            codes = np.zeros(n, np.int64)
            if at is not None:
                codes = pc.dictionary_encode(batch.column(at), null_encoding="encode").indices.to_numpy(zero_copy_only=False)
            begins = np.r_[True, codes[1:] != codes[:-1]]
            starts, run = np.flatnonzero(begins), np.cumsum(begins) - 1
            before = np.cumsum(w) - w
            local = before - before[starts][run]
            if number and (at is None or batch.column(at)[0].as_py() == last):
                local[run == 0] += total
            total = int(local[-1] + w[-1])
            last = None if at is None else batch.column(at)[n - 1].as_py()
            rows = (part << ID_BITS) + number + np.arange(n)
            number += n
            columns = [batch.column(i) for i in range(kept)] + [pa.array(w), pa.array(rows), pa.array(np.full(n, part)), pa.array(local)]
            yield pa.RecordBatch.from_arrays(columns, [f.name for f in schema.fields])

    written = stored(sorted_rows.mapInArrow(add, schema), "running")
    keys = (group, "_part") if group else ("_part",)
    parts = written.groupBy(*keys).agg(F.sum("_w").alias("_sum"))
    whole = Window.partitionBy(*([group] if group else [F.lit(0)]))
    before = F.sum("_sum").over(whole.orderBy("_part")) - F.col("_sum")
    starts = parts.select(*keys, before.alias("_start"), F.sum("_sum").over(whole).alias(f"{name}_total"))
    joined = attach(written, starts, keys)
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], "row", (F.col(name) + F.col("_start")).alias(name), f"{name}_total")
