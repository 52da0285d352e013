"""Row-by-row comparison of a query with its SQL twin in DuckDB."""

from __future__ import annotations

import datetime
import glob
import math
import os

import duckdb
from pyspark.sql import DataFrame


def connect(base: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{base}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _cell(v):
    if v is None:
        return "<null>"
    if isinstance(v, bool):
        return f"b{v}"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(0.0 if v == 0 else v)
    if isinstance(v, int):
        return f"i{v}"
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return str(v)


def canonical(names: list[str], rows) -> list[tuple[str, ...]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def spark_rows(df: DataFrame):
    return sorted(df.columns), canonical(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql: str):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    return sorted(names), canonical(names, cur.fetchall())


def difference(df: DataFrame, con, sql: str) -> str | None:
    """None when columns, row count and all values agree, else what differs first."""
    (n1, r1), (n2, r2) = spark_rows(df), duck_rows(con, sql)
    if n1 != n2:
        return f"columns {n1} != {n2}"
    if len(r1) != len(r2):
        return f"rows {len(r1)} != {len(r2)}"
    for a, b in zip(r1, r2):
        if a != b:
            return f"spark {a} != sql {b}"
    return None
