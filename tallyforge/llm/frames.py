"""Helpers shared by the text operators."""

from __future__ import annotations

import ctypes
import sys
import types
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tallyforge.session import remove_path, shared_root

#: Texts are handled in groups of about this many characters inside a task.
GROUP_CHARS = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Removes the shuffle files of a query when it ends, see :func:`stored`.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: The open scopes of :func:`scratch`, innermost last.
_scopes: list[list[DataFrame]] = []


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: the lineage ends there, and a lost executor costs nothing.

    As nothing reads the shuffle files again, they go when the write ends, and not when the driver happens to collect
    its garbage.
    """
    spark = df.sparkSession
    path = f"{shared_root(spark)}/tallyforge-llm/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEAN_UP, "false")
    spark.conf.set(CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEAN_UP, before)
    written = spark.read.schema(df.schema).parquet(path)
    if _scopes:
        written.tallyforge_path = path
        _scopes[-1].append(written)
    return written


@contextmanager
def scratch() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Written frames that are only steps: all that are stored inside are removed at the end, but for those handed to what
    this gives, which pass to the scope around it, or stay. Nothing that is not kept may be read afterwards."""
    own: list[DataFrame] = []
    _scopes.append(own)

    def keep(df: DataFrame) -> DataFrame:
        for i, one in enumerate(own):
            if one is df:
                del own[i]
                if len(_scopes) > 1:
                    _scopes[-2].append(df)
                break
        return df

    try:
        yield keep
    finally:
        _scopes.pop()
        for df in own:
            remove_path(df.sparkSession, df.tallyforge_path)


def small_batches(spark: SparkSession, size: str = "4m") -> None:
    """Lets the session hand rows to Python workers in batches of about ``size`` bytes. With long texts, a batch of the usual
    number of rows takes tens of megabytes on both sides, of which either keeps its share."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def worker_value(key: tuple, make: Callable[[], Any]) -> Any:
    """A value kept in a Python worker, so that tasks after the first one find it ready, until a task of another kind comes."""
    kept = _worker_state()
    if key not in kept:
        kept[key] = make()
    return kept[key]


def _worker_state() -> dict:
    return sys.modules.setdefault("tallyforge_worker_state", types.ModuleType("tallyforge_worker_state")).__dict__.setdefault("kept", {})


def release() -> None:
    """Gives memory that is free back to the system: a worker lives on after its task, and others share the machine."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # only the GNU library has it
        pass


def grouped(batches: Iterator[pa.RecordBatch], text: str, limit: int = GROUP_CHARS, keep: tuple[tuple, ...] = ()) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of the batches whose texts have about ``limit`` bytes together (a longer text stands alone); null is empty.

    What the worker holds for tasks of another kind, all but the keys ``keep`` of :func:`worker_value`, is dropped first.
    """
    kept = _worker_state()
    if others := [k for k in kept if k not in keep]:
        for key in others:
            del kept[key]
        release()
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        lengths = pa.compute.fill_null(pa.compute.binary_length(column), 0).to_numpy(zero_copy_only=False)
        start = total = 0
        for i, n in enumerate(lengths):
            if total and total + n > limit:
                yield _slice(batch, text, start, i)
                start, total = i, 0
            total += int(n)
        if start < batch.num_rows:
            yield _slice(batch, text, start, batch.num_rows)
    release()


def _slice(batch: pa.RecordBatch, text: str, start: int, stop: int) -> tuple[pa.RecordBatch, list[str]]:
    part = batch.slice(start, stop - start)
    return part, [t or "" for t in part.column(part.schema.get_field_index(text)).to_pylist()]


def records(columns: dict[str, Any], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)
