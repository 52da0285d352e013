"""Sizes, disjointness and repeatability of samples and splits."""

import hashlib
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyforge.functions import hashing as H
from tallyforge.operators import joins, sampling
from tallyforge.sources import views


def order(keys, seed=42):
    return sorted(keys, key=lambda k: (hashlib.md5(f"{k}:{seed}".encode()).hexdigest(), k))


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(0, 3000, 3).withColumnRenamed("id", "k").repartition(6)


@pytest.mark.parametrize("fetched", [1, 40, 10_000])
@pytest.mark.parametrize("n", [0, 1, 7, 999, 1000, 5000])
def test_sample_size(rows, n, fetched, monkeypatch):
    monkeypatch.setattr(sampling, "FETCHED", fetched)
    found = sorted(r["k"] for r in sampling.sample_n(rows, "k", n).collect())
    assert found == sorted(order(range(0, 3000, 3))[:n])


@pytest.mark.parametrize("fraction", [0.0, 0.001, 0.333, 0.75, 1.0])
def test_split_is_exact_and_complete(rows, fraction):
    train, test = sampling.split_exact(rows, "k", fraction, seed="s")
    a, b = {r["k"] for r in train.collect()}, {r["k"] for r in test.collect()}
    assert not a & b and len(a | b) == 1000
    assert a == set(order(range(0, 3000, 3), "s")[: int(fraction * 1000)])


def test_split_does_not_depend_on_partitions(spark, rows):
    first = sorted(r["k"] for r in sampling.split_exact(rows, "k")[0].collect())
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        again = sorted(r["k"] for r in sampling.split_exact(rows.repartition(2), "k")[0].collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert first == again


def test_split_moves_only_the_bucket_of_the_rank(rows):
    plan = sampling.mark_split(rows, "k")._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("fraction", [0.0, 0.7, 1.0])
def test_ordered_split(rows, fraction):
    train, test = sampling.split_ordered(rows, "k", fraction)
    cut = int(1000 * fraction)
    assert sorted(r["k"] for r in train.collect()) == list(range(0, 3000, 3))[:cut]
    assert test.count() == 1000 - cut


def test_global_rank_is_a_permutation(rows):
    found = {r["k"]: r["rank"] for r in sampling.global_rank(rows, "k", digits=2).collect()}
    assert [k for k, _ in sorted(found.items(), key=lambda kv: kv[1])] == order(range(0, 3000, 3))
    assert sorted(found.values()) == list(range(1, 1001))


def test_folds_and_hash_split_are_balanced(rows):
    folds = [r["count"] for r in sampling.with_folds(rows, "k", 5).groupBy("fold").count().collect()]
    assert len(folds) == 5 and min(folds) > 140
    share = sampling.mark_split_hash(rows, "k", 0.25).agg(F.avg(F.col("is_train").cast("int"))).first()[0]
    assert 0.2 < share < 0.3


def test_except_keeps_duplicates(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    left = joins.except_rows(df, spark.createDataFrame([(2,)], "k int"))
    assert [r["k"] for r in left.collect()] == [1, 1]


def test_hash_columns(rows):
    stats = rows.select(H.hash_uniform("k").alias("u"), H.pick("k", [1, 2, 3]).alias("c"))
    row = stats.agg(F.avg("u"), F.min("c"), F.max("c")).first()
    assert abs(row[0] - 0.5) < 0.05 and (row[1], row[2]) == (1, 3)


@pytest.mark.parametrize("fetched", [1, 10_000])
@pytest.mark.parametrize("size", [0, 1, 13, 20, 27, 33, 40])
def test_null_and_repeated_keys_lose_no_row(spark, size, fetched, monkeypatch):
    monkeypatch.setattr(sampling, "FETCHED", fetched)
    data = [(None, i) for i in range(8)] + [(1, i) for i in range(10)] + [(2, 5)] * 12 + [(3, None)] * 5 + [(i, i) for i in range(10, 15)]
    df = spark.createDataFrame(data, "k int, v int").repartition(4)
    taken, rest = sampling.split_n(df, "k", size)
    a, b = taken.collect(), rest.collect()
    assert len(a) == size and Counter(map(tuple, a + b)) == Counter(data)
    assert Counter(map(tuple, joins.except_rows(df, taken).collect())) == Counter(map(tuple, b))
    train, test = sampling.split_ordered(df, "k", size / 40)
    keys = sorted((k for k, _ in data), key=lambda k: (k is None, k or 0))
    assert Counter(r.k for r in train.collect()) == Counter(keys[:size]) and train.count() + test.count() == 40
    assert Counter(map(tuple, train.collect() + test.collect())) == Counter(data)


def test_only_the_key_is_read(spark, base):
    wine = views.wine(spark, base)
    for df in (sampling.mark_split(wine, "wine_id").select("wine_id", "is_train"), sampling.global_rank(wine, "wine_id", unique=True).select("wine_id", "rank"),
               sampling.mark_split_ordered(wine, "wine_id").select("wine_id", "is_train")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert set(re.findall(r"ReadSchema: struct<(.*?)>", plan)) == {"o_orderkey:bigint"}
