"""Exact ranks and quantiles against brute force, with hot values, NULLs and tiny groups."""

import numpy as np
import pytest

from tallyforge.operators.order_stats import exact_median, exact_quantiles, values_at_ranks
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def numbers():
    rng = np.random.default_rng(7)
    values = np.concatenate([rng.normal(size=4000), np.full(3000, 0.25), rng.exponential(size=2000) * 1e6])
    groups = np.where(np.arange(len(values)) % 3 == 0, 1, rng.integers(2, 6, len(values)))
    return [(int(g), float(v)) for g, v in zip(groups, values)] + [(1, None), (9, None), (7, 3.0), (8, 1.0), (8, 2.0)]


@pytest.mark.parametrize("accuracy", [10, 100, 10_000])
def test_quantiles_by_group(spark, numbers, accuracy):
    df = spark.createDataFrame(numbers, "g int, v double").repartition(7)
    probabilities = {"lo": 0.025, "mid": 0.5, "hi": 0.975}
    found = {r["g"]: r for r in exact_quantiles(df, "v", probabilities, ("g",), accuracy).collect()}
    assert set(found) == {1, 2, 3, 4, 5, 7, 8}
    for g, row in found.items():
        mine = [v for k, v in numbers if k == g and v is not None]
        for name, p in probabilities.items():
            assert row[name] == pytest.approx(np.quantile(mine, p), rel=1e-12, abs=1e-12)


def test_median_with_a_hot_value(spark):
    df = spark.createDataFrame([(5.0,)] * 400 + [(float(i),) for i in range(500)], "v double")
    values = [5.0] * 400 + [float(i) for i in range(500)]
    assert exact_median(df, "v").first()["median"] == np.median(values)


def test_empty_and_single(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert exact_median(df, "v").first()["median"] is None
    assert exact_median(spark.createDataFrame([(4.0,)], "v double"), "v").first()["median"] == 4.0


def test_ranks_of_large_integers(spark):
    start = 9_007_199_254_740_990
    df = spark.range(start, start + 1000).repartition(5)
    row = values_at_ranks(df, "id", {"k": (0.3, lambda n: F.floor(n * 0.3))}).first()
    assert (row["n"], row["value"]) == (1000, start + 300)


def test_infinite_values(spark):
    df = spark.createDataFrame([(float("inf"),), (float("-inf"),), (1.0,), (float("nan"),)], "v double")
    assert exact_median(df, "v").first()["median"] == 1.0
