"""Group fits, grids, run tables, sources and sinks."""

import hashlib
import threading
from collections import Counter
from concurrent.futures import ThreadPoolExecutor
from functools import partial

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyforge.operators import filters, grids, group_fits, profit, runs, summary
from tallyforge.plans.table_queries import profit_tables
from tallyforge.session import shared_root, work_path
from tallyforge.sources import files, naming, tables


def test_group_fits_match_least_squares(spark):
    rng = np.random.default_rng(11)
    n = 3000
    group = np.where(np.arange(n) % 3 == 0, 0, rng.integers(1, 20, n))  # one group holds a third of the rows
    x = rng.normal(size=(n, 2))
    y = group + x @ np.array([2.0, -1.0]) + rng.normal(size=n)
    pdf = pd.DataFrame({"g": group, "a": x[:, 0], "b": x[:, 1], "y": y})
    df = spark.createDataFrame(pdf).repartition(6)
    df = df.unionByName(spark.createDataFrame([(99, 1.0, 1.0, 1.0)], df.schema))
    found = {r["g"]: r for r in group_fits.fit_per_group(df, "g", ("a", "b"), "y").collect()}
    assert found[99]["n"] == 1 and found[99]["a"] is None
    for g in np.unique(group):
        m = group == g
        best = np.linalg.lstsq(np.column_stack([np.ones(m.sum()), x[m]]), y[m], rcond=None)[0]
        assert [found[g]["intercept"], found[g]["a"], found[g]["b"]] == pytest.approx(list(best))
        assert found[g]["n"] == m.sum()


def test_ridge_shrinks(spark):
    df = spark.createDataFrame([(1, float(i), 2.0 * i) for i in range(10)], "g int, x double, y double")
    plain = group_fits.fit_per_group(df, "g", ("x",), "y").first()["x"]
    ridge = group_fits.fit_per_group(df, "g", ("x",), "y", ridge=50.0).first()["x"]
    assert plain == pytest.approx(2.0) and 0 < ridge < 2.0


def test_scorer_carries_its_numbers(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, None)], "a double, b double")
    rows = df.select(group_fits.linear_scorer(1.0, (2.0, 3.0))("a", "b").alias("s")).collect()
    assert rows[0]["s"] == 9.0 and rows[1]["s"] is None


def test_batch_ratio_estimates_pi(spark):
    from tallyforge.functions.hashing import hash_uniform

    points = spark.range(40000).select("id", hash_uniform("id", "x").alias("x"), hash_uniform("id", "y").alias("y"))
    inside = F.col("x") * F.col("x") + F.col("y") * F.col("y") <= 1
    batches = group_fits.batch_hits(points, F.col("id") % 3, inside)
    total = group_fits.batch_ratio(batches).first()
    assert total["batches"] == 3 and total["n"] == 40000
    assert abs(total["estimate"] - np.pi) < 4 * total["se"]


def test_task_map_sees_every_row(spark):
    parts = group_fits.task_map(spark.range(1000).repartition(5), lambda p: pd.DataFrame({"s": [p["id"].sum()]}), "s long")
    assert parts.agg(F.sum("s")).first()[0] == 499500


def test_grids(spark):
    grid = grids.parameter_grid(spark, a=[0.001, 0.01, 0.1, 1.0], b=[1, 2, 3])
    assert grid.count() == 12 and grid.columns == ["a", "b"]
    best = grids.best_of_grid(grid, F.col("a") * F.col("a") + F.col("b"), "a").first()
    assert (best["a"], best["b"]) == (0.001, 1)
    trees = grids.parameter_grid(spark, trees=list(range(100, 301, 50)))
    assert [r["trees"] for r in trees.orderBy("trees").collect()] == [100, 150, 200, 250, 300]


def test_run_log_search_and_versions(spark):
    path, registry = work_path(spark, "runs"), work_path(spark, "versions")
    runs.log_run(spark, path, "r2", {"alpha": 0.1, "unset": None}, {"r2": 0.5, "rmse": 1.0}, "store/r2")
    runs.log_run(spark, path, "r1", {"alpha": 0.2}, {"r2": 0.5})
    runs.log_run(spark, path, "r3", {"alpha": 0.3}, {"rmse": 2.0})
    log = spark.read.schema(runs.LOG_SCHEMA).parquet(path)
    assert log.where("key = 'unset'").count() == 0
    found = runs.run_search(log, ("alpha", "r2"), "r2").collect()
    assert [r["run_id"] for r in found] == ["r1", "r2", "r3"] and found[2]["r2"] is None
    assert runs.top_run(log, ("rmse",), "rmse", descending=False).first()["run_id"] == "r2"
    uri = log.where("kind = 'artifact'").select(runs.model_uri(F.col("value"), F.lit("m"))).first()[0]
    assert uri == "store/r2/m"
    assert [runs.register_version(spark, registry, "m", r, "u") for r in ("r1", "r2")] == [1, 2]
    assert runs.register_version(spark, registry, "other", "r1", "u") == 1
    assert runs.versions(spark, registry).count() == 3


def test_csv_names_and_schema(spark, tmp_path):
    path = tmp_path / "w.csv"
    path.write_text('"fixed acidity";pH;quality\n7.4;3.51;5\n7.8;;6\n')
    df = files.read_csv(spark, str(path), ";")
    assert df.columns == ["fixed_acidity", "ph", "quality"]
    assert [tuple(r) for r in df.collect()] == [(7.4, 3.51, 5), (7.8, None, 6)]
    typed = files.read_csv(spark, str(path), ";", "`fixed acidity` double, pH double, quality string")
    assert typed.columns == ["fixed_acidity", "ph", "quality"] and typed.first()["quality"] == "5"
    with pytest.raises(Exception, match="header"):
        files.read_csv(spark, str(path), ";", "a double, b double, c string").collect()
    with pytest.raises(ValueError, match="distinct"):
        naming.safe_columns(spark.createDataFrame([(1, 2)], "`a.b` int, a_b int"))


def test_catalog(spark, tmp_path):
    source, copy = str(tmp_path / "src"), str(tmp_path / "copy")
    spark.range(5).write.parquet(source)
    tables.create_schema(spark, "lending")
    old = spark.catalog.currentDatabase()
    tables.use_database(spark, "lending")
    try:
        linked = tables.clone_parquet(spark, source, "linked")
        copied = tables.clone_parquet(spark, source, "copied", copy)
        spark.range(5, 7).write.mode("append").parquet(source)
        spark.catalog.refreshTable("linked")
        assert spark.table("linked").count() == 7 and copied.count() == 5 and linked.columns == ["id"]
        assert tables.read_table(spark, "spark_catalog", "lending", "copied").count() == 5
        listed = {r["name"] for r in tables.list_tables(spark, "lending").where("not temporary").collect()}
        assert {"linked", "copied"} <= listed
    finally:
        spark.sql("DROP TABLE IF EXISTS linked")
        spark.sql("DROP TABLE IF EXISTS copied")
        tables.use_database(spark, old)
        spark.sql("DROP SCHEMA IF EXISTS lending CASCADE")


def test_local_rows_schema_and_signature(spark, capsys):
    df = tables.register_rows(spark, [(1, 2.0), (2, 3.0)], "id int, w double", "some_rows")
    assert tables.run_sql(spark, "SELECT sum(w) AS s FROM {t}", t=df).first()["s"] == 5.0
    assert spark.table("some_rows").count() == 2
    assert [tuple(r) for r in tables.schema_frame(df).collect()] == [("id", "int"), ("w", "double")]
    assert tables.signature_json(df).orderBy("name").first()["json"] == '{"type":"int","name":"id"}'
    tables.show_plan(df)
    assert "Physical Plan" in capsys.readouterr().out
    assert files.to_client(df).shape == (2, 2)
    with pytest.raises(ValueError, match="more than 1 rows"):
        files.to_client(df, 1)
    assert filters.preview(df, 1).count() == 1


def test_concurrent_writers_get_distinct_versions(spark):
    registry = work_path(spark, "versions")
    with ThreadPoolExecutor(20) as pool:
        got = list(pool.map(lambda i: runs.register_version(spark, registry, "m", f"r{i}", "u"), range(20)))
    assert sorted(got) == list(range(1, 21))
    rows = runs.versions(spark, registry).collect()
    assert sorted(r.version for r in rows) == list(range(1, 21)) and {r.run_id: r.version for r in rows} == {f"r{i}": v for i, v in enumerate(got)}
    assert runs.register_version(spark, registry, "x/../m", "r", "u") == 1 and not runs.claim(spark, f"{registry}/_claims/{hashlib.sha256(b'm').hexdigest()}/20")


def test_jobs_at_the_same_time(spark):
    seen, lock = Counter(), threading.Lock()

    def job(i):
        with lock:
            seen[i] += 1
        if i == 2 and seen[i] == 1:
            raise RuntimeError("lost")
        return spark.range(i).count(), spark.sparkContext.getLocalProperty("spark.job.description")

    spark.sparkContext.setLocalProperty("spark.job.description", "grid")
    try:
        found = grids.run_all(spark, {i: partial(job, i) for i in range(4)}, workers=4)
    finally:
        spark.sparkContext.setLocalProperty("spark.job.description", None)
    assert found == {i: (i, "grid") for i in range(4)} and seen[2] == 2

    def broken():
        raise KeyError("always")

    with pytest.raises(KeyError):
        grids.run_all(spark, {"a": broken, "b": lambda: 1})


def test_bad_records_go_to_a_table_of_their_own(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    lines = ['id;size x;note', '1;2.5;plain', '2;oops;text', '3;;', '4;1.0', '5;1.0;"two\nlines; and a ""quote"""', '6;x;"bad\nwith break"', '7;1;a;b', ';3;no id']
    (folder / "a.csv").write_text("\n".join(lines) + "\n")
    (folder / "b.csv").write_text("id;size x;note\n9;9;z\n")
    good, bad = files.read_csv_split(spark, str(folder), str(tmp_path / "out"), ";", "id int, `size x` double, note string")
    assert good.columns == ["id", "size_x", "note"] and bad.columns == ["file", "record"]
    rows = sorted((r.id or 0, r.size_x, r.note) for r in good.collect())
    assert rows == [(0, 3.0, "no id"), (1, 2.5, "plain"), (3, None, None), (5, 1.0, 'two\nlines; and a "quote"'), (9, 9.0, "z")]
    found = bad.collect()
    assert len(found) == 4 and all(r.file.endswith("/a.csv") for r in found) and any("with break" in r.record for r in found)
    assert len(rows) + len(found) == 9
    with pytest.raises(ValueError, match="header"):
        files.read_csv_split(spark, str(folder), str(tmp_path / "other"), ";", "id int, other double, note string")


def test_a_group_streams_through_one_task_in_batches(spark):
    rows = [("hot", i) for i in range(25_000)] + [(f"k{i % 40}", i) for i in range(2000)] + [(None, i) for i in range(30)]
    df = spark.createDataFrame(rows, "k string, v long").repartition(8)

    def step(state, part):
        values = part.column(1).to_pylist()
        assert len(values) <= 1000 and (state[2] is None or values[0] >= state[2]) and values == sorted(values)
        return state[0] + 1, state[1] + sum(values), values[-1]

    found = group_fits.group_stream(df, "k", lambda k: (0, 0, None), step, lambda k, s: {"k": k, "batches": s[0], "total": s[1]}, "k string, batches long, total long", batch=1000, order=("v",))
    got = {r.k: r for r in found.collect()}
    assert len(got) == 42 and found.count() == 42
    want = Counter()
    for k, v in rows:
        want[k] += v
    assert {k: r.total for k, r in got.items()} == want and got["hot"].batches >= 25
    none = group_fits.group_stream(df.limit(0), "k", lambda k: 0, lambda s, p: s, lambda k, s: {"k": k}, "k string")
    assert none.count() == 0


def test_bucketed_clones_meet_without_an_exchange(spark, base, tmp_path):
    frames, names = profit_tables(spark, base), []
    try:
        for name, key in (("lineitem", "l_orderkey"), ("orders", "o_orderkey")):
            names.append(f"{name}_buckets")
            frames[name] = tables.clone_bucketed(frames[name], names[-1], key, 4, str(tmp_path / name))
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        joined = frames["lineitem"].join(frames["orders"], F.col("l_orderkey") == F.col("o_orderkey")).select("l_orderkey", "o_orderdate")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan and "SelectedBucketsCount: 4 out of 4" in plan
        assert joined.count() == frames["lineitem"].count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_bucket_summary_single_row_group(spark):
    df = spark.createDataFrame([("s", 3.1, 5.0), ("s", 2.9, 7.0), ("t", 1.0, 1.0)], "g string, w double, l double")
    rows = {r["g"]: r for r in summary.bucket_summary(df, "g", "w", "l").collect()}
    assert (rows["s"]["w"], rows["s"]["count"], rows["s"]["mean"]) == (3.0, 2, 6.0)
    assert rows["t"]["stdev"] is None and rows["t"]["upper"] is None


def test_profit_pre_aggregation_equals_detail(spark):
    """Duplicate cost rows and a part with most of the lines; both forms must agree."""
    lines = [(i, 1 if i % 3 else 2, i % 2, 10.0 + i, 0.1, float(i % 5)) for i in range(60)]
    frames = {
        "part": spark.createDataFrame([(1, "bolt"), (2, "ant"), (3, "cog")], "p_partkey int, p_name string"),
        "lineitem": spark.createDataFrame(lines, "l_orderkey int, l_partkey int, l_suppkey int, l_extendedprice double, l_discount double, l_quantity double"),
        "partsupp": spark.createDataFrame([(1, 0, 2.0), (1, 0, 3.0), (1, 1, 1.0), (2, 0, 4.0)], "ps_partkey int, ps_suppkey int, ps_supplycost double"),
        "orders": spark.createDataFrame([(i, f"199{i % 4}-01-01") for i in range(60)], "o_orderkey int, d string").selectExpr("o_orderkey", "date(d) AS o_orderdate"),
        "supplier": spark.createDataFrame([(0, 7), (1, 8)], "s_suppkey int, s_nationkey int"),
        "nation": spark.createDataFrame([(7, "X"), (8, "Y")], "n_nationkey int, n_name string"),
    }
    detail = profit.profit_rows(frames).groupBy("nation", "o_year").agg(F.round(F.sum("amount"), 6).alias("s"))
    short = profit.profit_by_nation(frames).select("nation", "o_year", F.round("sum_profit", 6).alias("s"))
    assert sorted(map(tuple, short.collect())) == sorted(map(tuple, detail.collect()))
    assert profit.top_profit(profit.profit_by_nation(frames)).first()["nation"] == "X"


def test_shared_folder_comes_from_the_session(spark):
    assert work_path(spark, "x").startswith(shared_root(spark) + "/tallyforge/x-")
    assert spark.conf.get("spark.checkpoint.dir").rstrip("/") == shared_root(spark)
