"""Draw summaries, convergence checks, WAIC and pooling against numpy."""

from statistics import NormalDist

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyforge.functions.normal import inverse_normal_sql
from tallyforge.operators import draws, order_stats, pooling
from tallyforge.operators.order_stats import average_ranks
from tallyforge.sources import views


@pytest.fixture(scope="module")
def chains():
    rng = np.random.default_rng(3)
    out = {}
    for param in ("a", "b"):
        for chain in range(3):
            noise = rng.normal(size=701)
            x = np.zeros(701)
            for i in range(1, 701):
                x[i] = (0.6 if param == "a" else 0.0) * x[i - 1] + noise[i]
            out[param, chain] = x + (chain if param == "b" else 0)
    return out


@pytest.fixture(scope="module")
def frame(spark, chains):
    rows = [(c, i + 100, p, float(v)) for (p, c), x in chains.items() for i, v in enumerate(x)]
    return spark.createDataFrame(rows, "chain int, iter long, param string, value double").repartition(6)


def test_summary(frame, chains):
    for r in draws.draws_summary(frame).collect():
        x = np.concatenate([v for (p, _), v in chains.items() if p == r["param"]])
        assert r["mean"] == pytest.approx(x.mean()) and r["sd"] == pytest.approx(x.std(ddof=1))
        assert r["se"] == pytest.approx(x.std(ddof=1) / np.sqrt(len(x)))
        for name, p in draws.SUMMARY_QUANTILES.items():
            assert r[name] == pytest.approx(np.quantile(x, p))


def test_rhat(frame, chains):
    found = {r["param"]: r["rhat"] for r in draws.split_rhat(frame).collect()}
    for param in "ab":
        halves = [h for (p, _), x in chains.items() if p == param for h in (x[:350], x[350:700])]
        w = np.mean([h.var(ddof=1) for h in halves])
        b = np.var([h.mean() for h in halves], ddof=1)
        assert found[param] == pytest.approx(np.sqrt((349 / 350 * w + b) / w))
    assert found["b"] > 1.1 > found["a"]


def ess(xs):
    n = len(xs[0])
    max_lag = n - 1
    acov = np.mean([[np.sum((x - x.mean())[: n - t] * (x - x.mean())[t:]) / n for t in range(max_lag + 1)] for x in xs], axis=0)
    w = acov[0] * n / (n - 1)
    v = (n - 1) / n * w + (np.var([x.mean() for x in xs], ddof=1) if len(xs) > 1 else 0.0)
    rho = 1 - (w - acov) / v
    rho[0] = 1
    total = 0.0
    for i in range(0, max_lag, 2):
        pair = rho[i] + rho[i + 1]
        if pair < 0:
            break
        total += pair
    return len(xs) * n / (2 * total - 1)


@pytest.mark.parametrize("block", [60, 350, 8192])
def test_effective_size(frame, chains, block):
    found = {r["param"]: r["ess"] for r in draws.effective_size(frame, 50, block).collect()}
    for param in "ab":
        assert found[param] == pytest.approx(ess([x for (p, _), x in chains.items() if p == param]))
    assert found["a"] < 3 * 701 / 2


def test_a_null_parameter_and_trends_keep_their_size(spark):
    rng = np.random.default_rng(9)
    trend = np.linspace(-3, 3, 4000) + rng.normal(size=4000) * 0.1
    short = rng.normal(size=37)
    rows = [(1, i, None, float(v)) for i, v in enumerate(trend)] + [(1, i, "short", float(v)) for i, v in enumerate(short)] + [(2, i, "none", float("nan")) for i in range(5)]
    df = spark.createDataFrame(rows, "chain int, iter long, param string, value double").repartition(4)
    found = {r["param"]: r["ess"] for r in draws.effective_size(df, 8, 128).collect()}
    assert set(found) == {None, "short"}
    assert found[None] == pytest.approx(ess([trend])) and found["short"] == pytest.approx(ess([short]))


def test_no_task_gathers_more_than_three_blocks(spark, monkeypatch):
    """A trending chain: lags run to its end while a task holds three blocks."""
    n, block = 200_000, 4096
    df = spark.range(n).select(F.lit(1).alias("chain"), F.col("id").alias("iter"), F.lit("t").alias("param"), (F.col("id") / n).alias("value"))
    x = np.arange(n) / n - np.mean(np.arange(n) / n)
    size = 1 << 19
    want = np.fft.irfft(np.abs(np.fft.rfft(x, size)) ** 2, size)[:n] / n
    rows = draws.autocovariances(df, 160_001, 159_000, block).collect()
    assert sorted(r["lag"] for r in rows) == list(range(159_000, 160_001))
    assert [r["acov"] for r in sorted(rows, key=lambda r: r["lag"])] == pytest.approx(want[159_000:160_001].tolist(), rel=1e-8)
    pair = draws._pair_sums

    def watched(block, low, high):
        own = pair(block, low, high)

        def sums(table):
            assert table.num_rows <= 3 * block
            return own(table)

        return sums

    monkeypatch.setattr(draws, "_pair_sums", watched)
    assert draws.autocovariances(df, 9000, 8000, block).count() == 1000


def plain_rank_rhat(xs):
    halves = [h for x in xs for h in (x[: len(x) // 2], x[len(x) // 2 : len(x) // 2 * 2])]
    every = np.concatenate(halves)

    def rhat(values):
        order = np.sort(values)
        rank = (np.searchsorted(order, values, "left") + 1 + np.searchsorted(order, values, "right")) / 2
        z = np.array([NormalDist().inv_cdf(p) for p in (rank - 0.375) / (len(values) + 0.25)]).reshape(len(halves), -1)
        n, w = z.shape[1], z.var(axis=1, ddof=1).mean()
        return np.sqrt(((n - 1) / n * w + z.mean(axis=1).var(ddof=1)) / w)

    return rhat(every), rhat(np.abs(every - np.median(every)))


def test_rank_rhat(spark, frame, chains):
    rng = np.random.default_rng(2)
    wide = {("c", k): np.round(rng.standard_cauchy(300) * (1 + 3 * (k == 2)), 1) for k in range(3)}  # ties, heavy tails, one wider chain
    rows = [(c, i, None if p == "c" else p, float(v)) for (p, c), x in wide.items() for i, v in enumerate(x)] + [(0, 3000 + i, "d", None) for i in range(4)]
    more = frame.unionByName(spark.createDataFrame(rows, frame.schema))
    found = {r["param"]: r for r in draws.rank_rhat(more).collect()}
    for param, xs in [(p, [x for (q, _), x in chains.items() if q == p]) for p in "ab"] + [(None, list(wide.values()))]:
        bulk, tail = plain_rank_rhat(xs)
        assert found[param]["rhat_bulk"] == pytest.approx(bulk) and found[param]["rhat_tail"] == pytest.approx(tail)
        assert found[param]["rhat"] == pytest.approx(max(bulk, tail))
    assert found[None]["rhat_tail"] > 1.05 > found[None]["rhat_bulk"]


def test_average_ranks_of_a_hot_group(spark):
    values = [5.0] * 700 + [float(i % 97) for i in range(900)]
    df = spark.createDataFrame([("hot", v) for v in values] + [(None, 1.0), (None, 3.0), (None, 1.0), ("x", float("nan"))], "g string, v double").repartition(7)
    found = {(r.g, r.v): (r.m, r["rank"], r.n) for r in average_ranks(df, "v", ("g",)).collect()}
    order = np.sort(values)
    for v in set(values):
        low, high = np.searchsorted(order, v, "left"), np.searchsorted(order, v, "right")
        assert found["hot", v] == (high - low, (low + 1 + high) / 2, 1600)
    assert found[None, 1.0] == (2, 1.5, 3) and found[None, 3.0] == (1, 3.0, 3) and len(found) == len(set(values)) + 2
    cut = order_stats._in_segments(df.where("g = 'hot'"), "v", [i / 8 for i in range(1, 8)], ("g",), 2000).groupBy("_b").agg(F.count_distinct("v").alias("d")).collect()
    assert len(cut) > 30 and max(r.d for r in cut) <= 30


def test_inverse_normal(spark):
    ps = [1e-300, 1e-20, 1e-6, 0.001, 0.07, 0.075, 0.3, 0.5, 0.7, 0.925, 0.93, 0.999, 1 - 1e-12]
    rows = spark.createDataFrame([(p,) for p in ps], "p double").select("p", F.expr(inverse_normal_sql("p")).alias("z")).collect()
    for r in rows:
        assert r.z == pytest.approx(NormalDist().inv_cdf(r.p), rel=1e-13, abs=1e-15)


def test_gaps(spark, frame):
    assert draws.gaps(frame).count() == 0
    assert draws.gaps(frame.where("iter <> 300 OR chain <> 1")).count() == 2


@pytest.mark.parametrize("spread", [1.0, 400.0])
def test_waic(spark, spread):
    rng = np.random.default_rng(5)
    ll = -np.abs(rng.normal(size=(40, 7)) * spread) - 3
    rows = [(d, o, float(ll[d, o])) for d in range(40) for o in range(7)]
    found = draws.waic(spark.createDataFrame(rows, "draw int, obs int, ll double").repartition(5)).first()
    top = ll.max(axis=0)
    lppd = np.sum(np.log(np.mean(np.exp(ll - top), axis=0)) + top)
    p = np.sum(ll.var(axis=0, ddof=1))
    assert found["lppd"] == pytest.approx(lppd) and found["p_waic"] == pytest.approx(p)
    assert found["waic"] == pytest.approx(-2 * (lppd - p))


def test_eight_schools(spark):
    groups = views.schools(spark)
    posterior = pooling.tau_posterior(groups, 40.0, 2000)
    effects = {r["id"]: r for r in pooling.pooled_effects(groups, posterior).collect()}
    assert effects[1]["theta_mean"] == pytest.approx(11.38, abs=0.01)
    assert effects[2]["theta_mean"] == pytest.approx(7.89, abs=0.01)
    assert all(r["theta_sd"] < r["sigma"] for r in effects.values())
    hyper = pooling.pooled_hyper(posterior).first()
    assert 7 < hyper["mu_mean"] < 9 and 5 < hyper["tau_mean"] < 8
    assert posterior.agg(F.sum("p")).first()[0] == pytest.approx(1.0)


def test_prior_on_tau_shrinks(spark):
    groups = views.schools(spark)
    flat = pooling.pooled_hyper(pooling.tau_posterior(groups, 40.0)).first()
    half_cauchy = pooling.tau_posterior(groups, 40.0, log_prior=lambda t: -F.log(1 + (t / 2.0) * (t / 2.0)))
    assert pooling.pooled_hyper(half_cauchy).first()["tau_mean"] < flat["tau_mean"]
