"""Catalog tables and SQL text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyforge.functions.text import json_row


def read_table(spark: SparkSession, *parts: str) -> DataFrame:
    """A catalog table by its one to three name parts."""
    return spark.table(".".join(f"`{p}`" for p in parts))


def run_sql(spark: SparkSession, text: str, **frames: DataFrame) -> DataFrame:
    """Run SQL text; ``{name}`` stands for the frame passed under that name."""
    return spark.sql(text, **frames)


def use_database(spark: SparkSession, name: str) -> None:
    spark.catalog.setCurrentDatabase(name)


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Names of tables and views of a database, with whether they are temporary."""
    rows = [(t.name, t.isTemporary) for t in spark.catalog.listTables(database)]
    return spark.createDataFrame(rows, "name string, temporary boolean")


def register_rows(spark: SparkSession, rows: list, schema: str, name: str) -> DataFrame:
    """Copy a few local rows to the cluster and make them readable as a view."""
    df = spark.createDataFrame(rows, schema)
    df.createOrReplaceTempView(name)
    return df


def clone_parquet(spark: SparkSession, path: str, table: str, location: str | None = None) -> DataFrame:
    """A catalog table from a Parquet folder.

    Without ``location`` the table points at the folder and nothing is copied; with it the rows are
    copied there first, so later changes of the folder do not show.
    """
    if location:
        spark.read.parquet(path).write.mode("overwrite").option("path", location).format("parquet").saveAsTable(table)
    else:
        spark.catalog.createTable(table, path=path, source="parquet")
    return spark.table(table)


def clone_bucketed(df: DataFrame, table: str, key: str, buckets: int, location: str) -> DataFrame:
    """A catalog table of the rows at ``location``, dealt into buckets by ``key`` and sorted by it.

    Tables with the same number of buckets join on their keys without moving either: the move is paid once, when the table
    is written, a file for each bucket. A key that holds a large share of the rows makes a large bucket, so the key
    should be one like an order's, which few rows share.
    """
    dealt = df.repartition(buckets, key)
    dealt.write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", location).saveAsTable(table)
    return df.sparkSession.table(table)


def create_schema(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{name}`")


def show_plan(df: DataFrame, mode: str = "formatted") -> None:
    """Print the plan of a query."""
    df.explain(mode)


def schema_frame(df: DataFrame) -> DataFrame:
    """Name and type of every column, without running a job."""
    rows = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "name string, type string")


def signature_json(df: DataFrame) -> DataFrame:
    """One JSON object per column: its type and name."""
    return schema_frame(df).select("name", json_row("type", "name").alias("json"))
