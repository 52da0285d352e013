"""Delimited files and result folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from tallyforge.sources.naming import safe_columns


def read_csv(spark: SparkSession, path: str, sep: str = ",", schema: str | None = None) -> DataFrame:
    """A delimited file with a header, on any file system Spark can read.

    With a schema the file is read once and its header must have the schema's names in their order; without one the types are inferred in an extra pass.
    """
    reader = spark.read.option("header", True).option("sep", sep)
    reader = reader.schema(schema).option("enforceSchema", False) if schema else reader.option("inferSchema", True)
    return safe_columns(reader.csv(path))


def read_csv_split(spark: SparkSession, path: str, store: str, sep: str = ",", schema: str = "", multi_line: bool = True, quote_escape: str = '"') -> tuple[DataFrame, DataFrame]:
    """A delimited file with a header as its good rows, and its bad records as ``(file, record)``.

    Bad is a record with too few or too many fields or with a value that is not of its column's type; its text is kept as it
    stands in the file. The file is parsed once: every record is written to ``store`` under good or bad, and both frames
    read from there, so together they have every record, line breaks inside quotes included. With ``multi_line`` a file is
    read by one task; files without such line breaks can be split when it is off. A quote inside quotes is doubled, or follows
    ``quote_escape``. The header must have the schema's names.
    """
    typed = safe_columns(spark.createDataFrame([], schema))
    fields = [f for f in spark.createDataFrame([], schema).schema.fields]
    record = "_record"
    while record in {f.name for f in fields}:
        record += "_"
    whole = StructType([*fields, StructField(record, StringType())])
    reader = spark.read.schema(whole).option("header", True).option("sep", sep).option("enforceSchema", True).option("multiLine", multi_line).option("escape", quote_escape)
    rows = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", record).option("columnPruning", False).csv(path)
    check_header(spark, path, sep, [f.name for f in fields])
    named = rows.select(*[F.col(f"`{f.name}`").alias(n) for f, n in zip(fields, typed.columns, strict=True)], F.col(record), F.col("_metadata.file_path").alias("_file"))
    named.withColumn("_bad", F.col(record).isNotNull()).write.partitionBy("_bad").parquet(store)
    back = spark.read.schema(StructType([*named.schema.fields, StructField("_bad", BooleanType())])).parquet(store)
    return back.where("not _bad").select(*[f"`{c}`" for c in typed.columns]), back.where("_bad").select(F.col("_file").alias("file"), F.col(record).alias("record"))


def check_header(spark: SparkSession, path: str, sep: str, names: list[str]) -> None:
    """An error when a file does not begin with these names; only first lines are read."""
    first = spark.read.option("header", False).option("sep", sep).csv(path).limit(1).collect()
    found = [v for v in (first[0] if first else [])]
    if [str(v).lower() for v in found] != [n.lower() for n in names]:
        raise ValueError(f"header {found} is not {names}")


def write_csv(df: DataFrame, path: str, sep: str = ",") -> str:
    df.write.option("header", True).option("sep", sep).csv(path)
    return path


def write_results(df: DataFrame, path: str) -> str:
    """Store a result as Parquet for later steps; the folder must not exist yet."""
    df.write.parquet(path)
    return path


def to_client(df: DataFrame, max_rows: int = 10_000):
    """A short result as a pandas frame on the driver; a longer one is refused."""
    rows = df.limit(max_rows + 1).toPandas()
    if len(rows) > max_rows:
        raise ValueError(f"more than {max_rows} rows: write the result to storage instead")
    return rows
