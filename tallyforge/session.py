"""Session settings and the shared work folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings the operators are written for. AQE picks join strategies and partition counts from
#: measured sizes and splits skewed join partitions, so no operator fixes a partition number.
SESSION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


#: Where the work folder of a local session is remembered; it is removed when the program ends.
WORK_KEY = "tallyforge.work.dir"


def build_session(master: str | None = None, app: str = "tallyforge", **conf: str) -> SparkSession:
    """A session with :data:`SESSION_CONF`; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A machine-local temporary folder is used only on a local master with the setting absent, as in
    unit tests; on a cluster a missing setting is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if spark.sparkContext.master.startswith("local") and not spark.sparkContext.master.startswith("local-"):
        root = spark.conf.get(WORK_KEY, None)
        if root is None:
            root = tempfile.mkdtemp(prefix="tallyforge-")
            atexit.register(shutil.rmtree, root, ignore_errors=True)
            spark.conf.set(WORK_KEY, root)
        return root
    raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")


def work_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_root(spark)}/tallyforge/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` stored once in the shared folder and read back: the lineage ends there. Its folder is ``.tallyforge_path``."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back.tallyforge_path = path
    return back


def remove_path(spark: SparkSession, path: str) -> None:
    """Deletes a folder of the shared file system, once nothing reads it any more; a missing one is no error."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
