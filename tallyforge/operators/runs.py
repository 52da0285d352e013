"""Run log, run search, model addresses and versions, all as tables."""

from __future__ import annotations

import datetime
import hashlib
import os

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyforge.functions.columns import to_numeric

LOG_SCHEMA = "run_id string, kind string, key string, value string, ts timestamp"
VERSION_SCHEMA = "name string, version bigint, run_id string, uri string"


def log_run(
    spark: SparkSession,
    path: str,
    run_id: str,
    params: dict | None = None,
    metrics: dict | None = None,
    artifact_uri: str | None = None,
) -> None:
    """Append parameters, metrics and the artifact address of one run; absent values are skipped."""
    log_runs(spark, path, [(run_id, params or {}, metrics or {}, artifact_uri)])


def append_rows(rows: DataFrame, path: str) -> None:
    """Append log rows ``(run_id, kind, key, value)`` made on the cluster."""
    rows.select("run_id", "kind", "key", "value", F.current_timestamp().alias("ts")).write.mode("append").parquet(path)


def metric_rows(metrics: DataFrame, run_id: str, names: tuple[str, ...], kind: str = "metric") -> DataFrame:
    """A wide frame of metrics per run as log rows, NULL values skipped."""
    typed = metrics.select(F.col(run_id).cast("string").alias("run_id"), *[F.col(n).cast("string") for n in names])
    long = typed.unpivot("run_id", list(names), "key", "value").where(F.col("value").isNotNull())
    return long.select("run_id", F.lit(kind).alias("kind"), "key", "value")


def run_search(log: DataFrame, names: tuple[str, ...], order: str, descending: bool = True) -> DataFrame:
    """One row per run with the named params and metrics as columns, best first.

    The value logged last counts (of equal times the larger one). A metric is a number; a parameter is a number when all
    its values are, else text. A name that is logged as both stands for the metric, and its parameter for
    ``params.<name>``. Equal metrics are ordered by run id.
    """
    if "ts" not in log.columns:
        log = log.withColumn("ts", F.lit(None).cast("timestamp"))
    metric, param = F.col("kind") == "metric", F.col("kind") == "param"
    last = lambda kind, name: F.max(F.when(kind & (F.col("key") == name), F.struct("ts", "value")))["value"]
    bare = [(n, n.removeprefix("params.")) for n in names]
    kinds = {r["key"]: r for r in log.where(F.col("key").isin(*{b for _, b in bare})).groupBy("key").agg(
        F.coalesce(F.bool_or(metric), F.lit(False)).alias("is_metric"),
        F.coalesce(F.bool_and(F.when(param, to_numeric("value").isNotNull())), F.lit(True)).alias("numbers"),
    ).collect()}
    wide = log.groupBy("run_id").agg(*[last(metric, b).alias(f"_m{i}") for i, (_, b) in enumerate(bare)], *[last(param, b).alias(f"_p{i}") for i, (_, b) in enumerate(bare)])
    columns = []
    for i, (n, b) in enumerate(bare):
        as_metric = n == b and (b not in kinds or kinds[b]["is_metric"])
        as_number = as_metric or kinds[b]["numbers"]
        value = F.col(f"_m{i}" if as_metric else f"_p{i}")
        columns.append((to_numeric(value) if as_number else value).alias(n))
    typed = wide.select("run_id", *columns)
    by = F.col(f"`{order}`")
    return typed.orderBy(by.desc_nulls_last() if descending else by.asc_nulls_last(), "run_id")


def top_run(log: DataFrame, names: tuple[str, ...], order: str, descending: bool = True) -> DataFrame:
    return run_search(log, names, order, descending).limit(1)


def model_uri(artifact_uri: str | Column, name: str | Column) -> Column:
    """Artifact address and model name, ``/`` between them."""
    return F.concat_ws("/", artifact_uri, name)


def next_versions(registry: DataFrame, candidates: DataFrame) -> DataFrame:
    """Candidates ``(name, run_id, uri)`` with the versions that follow the last one of their name, by run id."""
    last = registry.groupBy("name").agg(F.max("version").alias("_last"))
    number = F.row_number().over(Window.partitionBy("name").orderBy("run_id", "uri"))
    version = (F.coalesce(F.col("_last"), F.lit(0)) + number).cast("bigint").alias("version")
    return candidates.join(last, "name", "left").select("name", version, "run_id", "uri")


def claim(spark: SparkSession, path: str) -> bool:
    """Creates an empty file that did not exist; False when it did. Only one of several writers gets True."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = where.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(where.getParent())
    if system.getUri().getScheme() == "file":  # Spark's local file system looks first and creates then
        try:
            os.close(os.open(where.toUri().getPath(), os.O_CREAT | os.O_EXCL | os.O_WRONLY))
        except FileExistsError:
            return False
        return True
    try:
        system.create(where, False).close()
    except Py4JJavaError as e:
        if "FileAlreadyExists" in e.java_exception.getClass().getName() or system.exists(where):
            return False
        raise
    return True


def register_version(spark: SparkSession, path: str, name: str, run_id: str, uri: str) -> int:
    """Append the next version of a model to the version table; any number of writers at a time.

    A writer claims the version after the last one known by creating its file, and tries the next one if another writer has it
    already. Each version is a file of its own, so writers do not meet in the table either.
    """
    try:
        known = spark.read.schema(VERSION_SCHEMA).option("recursiveFileLookup", True).parquet(path)
        last = known.where(F.col("name") == name).agg(F.max("version").alias("v")).first()["v"]
    except AnalysisException as e:  # the first version creates the table
        if "PATH_NOT_FOUND" not in str(e):
            raise
        last = None
    version = (last or 0) + 1
    mark = hashlib.sha256(name.encode()).hexdigest()
    while not claim(spark, f"{path}/_claims/{mark}/{version}"):
        version += 1
    row = spark.createDataFrame([(name, version, run_id, uri)], VERSION_SCHEMA)
    row.coalesce(1).write.parquet(f"{path}/{mark}-{version}")
    return version


def versions(spark: SparkSession, path: str) -> DataFrame:
    """The version table."""
    return spark.read.schema(VERSION_SCHEMA).option("recursiveFileLookup", True).parquet(path)


def log_runs(spark: SparkSession, path: str, found: list[tuple[str, dict, dict, str | None]]) -> None:
    """Append several runs ``(run_id, params, metrics, artifact_uri)`` in one write."""
    now = datetime.datetime.now()
    rows = []
    for run_id, params, metrics, uri in found:
        items = [("param", k, v) for k, v in params.items()] + [("metric", k, v) for k, v in metrics.items()] + [("artifact", "uri", uri)]
        rows += [(run_id, kind, k, str(v), now) for kind, k, v in items if v is not None]
    spark.createDataFrame(rows, LOG_SCHEMA).coalesce(1).write.mode("append").parquet(path)
