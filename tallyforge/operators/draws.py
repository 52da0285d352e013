"""Summaries and convergence checks of posterior draws ``(chain, iter, param, value)``.

Iterations are numbered without gaps within a chain, as samplers write them; :func:`gaps` lists chains
for which that does not hold. A few parameters with very many draws are the usual shape, so no operator
sorts or gathers a whole chain.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyforge.functions.normal import inverse_normal_sql
from tallyforge.operators.joins import attach
from tallyforge.operators.order_stats import average_ranks, exact_quantiles
from tallyforge.session import remove_path, written

#: Quantiles of the printed summary.
SUMMARY_QUANTILES = {"q2_5": 0.025, "q25": 0.25, "q50": 0.5, "q75": 0.75, "q97_5": 0.975}

CHAIN = ("param", "chain")


def _chains(draws: DataFrame) -> DataFrame:
    return draws.groupBy(*CHAIN).agg(
        F.min("iter").alias("_first"),
        F.max("iter").alias("_last"),
        F.count(F.lit(1)).alias("_n"),
        F.avg("value").alias("_mean"),
    )


def gaps(draws: DataFrame) -> DataFrame:
    """Chains whose iteration numbers have gaps or repeats: ``param, chain, expected, found``."""
    rows = _chains(draws).select(*CHAIN, (F.col("_last") - F.col("_first") + 1).alias("expected"), F.col("_n").alias("found"))
    return rows.where(F.col("expected") != F.col("found"))


def draws_summary(draws: DataFrame) -> DataFrame:
    """Mean, sd, standard error and exact quantiles per parameter.

    NaN counts as missing throughout. A parameter without known draws keeps its row, and so does a NULL parameter.
    """
    draws = draws.select("param", F.when(~F.isnan("value"), F.col("value")).alias("value"))
    basic = draws.groupBy("param").agg(
        F.count("value").alias("n"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("sd"),
        F.try_divide(F.stddev_samp("value"), F.sqrt(F.count("value"))).alias("se"),
    )
    return attach(basic, exact_quantiles(draws, "value", SUMMARY_QUANTILES, ("param",)), ("param",), "left")


def _halves(draws: DataFrame) -> DataFrame:
    """Draws with ``half``: every chain is halved, an odd last iteration is dropped."""
    chains = _chains(draws).select(*CHAIN, "_first", F.floor((F.col("_last") - F.col("_first") + 1) / 2).alias("_half"))
    placed = attach(draws, chains.where("_half > 0"), CHAIN)
    half = F.floor((F.col("iter") - F.col("_first")) / F.col("_half"))
    return placed.select(*CHAIN, half.alias("half"), "value").where(F.col("half") < 2)


def _rhat(halves: DataFrame, name: str = "rhat") -> DataFrame:
    """R-hat per parameter of ``(param, chain, half, n, m, v)``: numbers, means and variances of the halves."""
    n = F.avg("n")
    within, between = F.avg("v"), F.var_samp("m")
    return halves.groupBy("param").agg(F.sqrt(F.try_divide((n - 1) / n * within + between, within)).alias(name))


def split_rhat(draws: DataFrame) -> DataFrame:
    """Split R-hat per parameter: every chain is halved, an odd last iteration is dropped."""
    known = F.count("value").alias("n"), F.avg("value").alias("m"), F.var_samp("value").alias("v")
    return _rhat(_halves(draws).groupBy(*CHAIN, "half").agg(*known))


def rank_rhat(draws: DataFrame) -> DataFrame:
    """``param, rhat_bulk, rhat_tail, rhat``: split R-hat of rank-normalised draws, and of their distances from the median.

    Draws are replaced by the normal quantiles of their average ranks among all draws of the parameter, so neither heavy
    tails nor chains that differ in spread alone go unseen; ``rhat`` is the larger of both. Ranks are exact, see
    :func:`tallyforge.operators.order_stats.average_ranks`. NULL and NaN draws count nowhere; a NULL parameter keeps its row.
    """
    known = draws.where(F.col("value").isNotNull() & ~F.isnan("value"))
    halves = written(_halves(known), "halves")  # read by several jobs
    middle = exact_quantiles(halves, "value", {"_median": 0.5}, ("param",))
    folded = attach(halves, middle, ("param",)).withColumn("value", F.abs(F.col("value") - F.col("_median"))).drop("_median")
    folded = written(folded, "folded")
    found = []
    for rows, name in ((halves, "rhat_bulk"), (folded, "rhat_tail")):
        ranks = average_ranks(rows, "value", ("param",), ("chain", "half")).withColumn("p", (F.col("rank") - 0.375) / (F.col("n") + 0.25))
        scores = ranks.withColumn("z", F.expr(inverse_normal_sql("p")))
        m, z, n = F.col("m"), F.col("z"), F.sum("m")
        sums = scores.groupBy("param", "chain", "half").agg(n.alias("n"), (F.sum(m * z) / n).alias("m"), (F.try_divide(F.sum(m * z * z) - F.sum(m * z) * F.sum(m * z) / n, n - 1)).alias("v"))
        found.append(_rhat(sums, name))
    both = written(attach(found[0], found[1], ("param",), "left").withColumn("rhat", F.greatest("rhat_bulk", "rhat_tail")), "rhat")
    for one in (halves, folded):
        remove_path(draws.sparkSession, one.tallyforge_path)
    return both


#: Draws of a block. A block meets two others at a time, whatever the lag.
BLOCK = 8192


def _pair_sums(block: int, low: int, high: int) -> Callable[[pa.Table], pa.Table]:
    """For a block of a chain and the two blocks ``k`` further on: the sums of ``x[i] * x[i + lag]`` for the lags ``k * block``
    up to, and without, ``(k + 1) * block``, ``i`` over the block's own draws; by a Fourier transform of four blocks.

    Draws are placed by their iteration number; a missing one adds nothing.
    """

    def sums(table: pa.Table) -> pa.Table:
        k = table.column("_k")[0].as_py()
        role, at, x = (table.column(c).to_numpy() for c in ("_role", "_at", "_x"))
        own = np.bincount(at[role == 0], weights=x[role == 0], minlength=block)
        others = np.zeros(2 * block)
        for r in (1, 2):
            others[(r - 1) * block : r * block] = np.bincount(at[role == r], weights=x[role == r], minlength=block)
        if k == 0:
            others[:block] = own
        size = 4 * block
        products = np.fft.irfft(np.conj(np.fft.rfft(own, size)) * np.fft.rfft(others, size), size)[:block]
        lags = k * block + np.arange(block)
        wanted = (lags >= low) & (lags < min(high, table.column("_n")[0].as_py()))
        again = pa.array(np.zeros(int(wanted.sum()), np.int64))
        columns = [table.column(c).take(again) for c in ("param", "chain", "_n", "_mean")]
        return pa.table([*columns, pa.array(lags[wanted]), pa.array(products[wanted])], names=["param", "chain", "_n", "_mean", "lag", "s"])

    return sums


def autocovariances(draws: DataFrame, high: int, low: int = 0, block: int = BLOCK) -> DataFrame:
    """Autocovariance per chain at the lags from ``low`` up to, and without, ``high`` that are shorter than the chain:
    ``param, chain, _n, _mean, lag, acov``.

    Chains are cut into blocks of consecutive iterations. For the lags of ``k`` blocks each block meets the two blocks ``k``
    and ``k + 1`` further on, so every product of two draws is formed once, a task holds three blocks whatever the lag,
    and a chain of any length is spread over many tasks.
    """
    chains = _chains(draws).select(*CHAIN, "_first", F.floor((F.col("_last") - F.col("_first")) / block).alias("_end"), "_n", "_mean")
    at = F.col("iter") - F.col("_first")
    own, first, last = F.floor(at / block), low // block, (high - 1) // block
    entry = lambda j, k, role: F.struct(j.cast("long").alias("j"), k.cast("long").alias("k"), F.lit(role).alias("role"))
    roles = F.flatten(F.transform(F.sequence(F.lit(first), F.lit(last)), lambda k: F.array(entry(own, k, 0), entry(own - k, k, 1), entry(own - k - 1, k, 2))))
    meets = lambda e: (e["j"] >= 0) & (e["j"] + e["k"] <= F.col("_end")) & ((e["k"] > 0) | (e["role"] != 1))
    placed = attach(draws, chains, CHAIN).select(
        *CHAIN, "_n", "_mean", (at % block).alias("_at"), (F.col("value") - F.col("_mean")).alias("_x"), F.explode(F.filter(roles, meets)).alias("_e")
    ).select(*CHAIN, "_n", "_mean", "_at", "_x", F.col("_e.j").alias("_j"), F.col("_e.k").alias("_k"), F.col("_e.role").alias("_role"))
    types = {f.name: f.dataType.simpleString() for f in draws.schema.fields}
    schema = f"param {types['param']}, chain {types['chain']}, _n bigint, _mean double, lag bigint, s double"
    sums = placed.groupBy(*CHAIN, "_j", "_k").applyInArrow(_pair_sums(block, low, high), schema)
    return sums.groupBy(*CHAIN, "_n", "_mean", "lag").agg((F.sum("s") / F.first("_n")).alias("acov"))


def effective_size(draws: DataFrame, first: int = 64, block: int = BLOCK) -> DataFrame:
    """Effective sample size per parameter; a NULL parameter keeps its row.

    Autocorrelations pooled over chains are summed in pairs of lags up to, and without, the first pair that is
    negative. The search goes through ranges of lags, each four times as long as all before: only the parameters that had
    no negative pair so far are looked at again, only at the new lags, until each has one or its chains end. Each range
    is a job that leaves one row per parameter; its lags are written and removed again.
    """
    left = draws.where(F.col("value").isNotNull() & ~F.isnan("value")).select("param", "chain", "iter", "value")
    low, high, base, state, done = 0, first, None, None, []
    while True:
        lags = written(autocovariances(left, high, low, block), "lags")
        if base is None:
            zero = lags.where("lag = 0").groupBy("param").agg(
                F.avg("_n").alias("n"), F.sum("_n").alias("total"), F.max("_n").alias("longest"),
                F.avg(F.try_divide(F.col("acov") * F.col("_n"), F.col("_n") - 1)).alias("w"), F.coalesce(F.var_samp("_mean"), F.lit(0.0)).alias("b"),
            )
            base = written(zero.select("param", "total", "longest", "w", ((F.col("n") - 1) / F.col("n") * F.col("w") + F.col("b")).alias("v")), "chains")
        pooled = attach(lags.groupBy("param", "lag").agg(F.avg("acov").alias("acov")), base, ("param",))
        rho = F.when(F.col("lag") == 0, F.lit(1.0)).otherwise(1.0 - F.try_divide(F.col("w") - F.col("acov"), F.col("v")))
        pairs = pooled.groupBy("param", F.floor(F.col("lag") / 2).alias("pair")).agg(F.sum(F.coalesce(rho, F.lit(-1.0))).alias("r"), F.count(F.lit(1)).alias("c")).where("c = 2")
        stops = pairs.groupBy("param").agg(F.min(F.when(F.col("r") < 0, F.col("pair"))).alias("stop"))
        kept = attach(pairs, stops, ("param",)).where("stop is null or pair < stop").groupBy("param").agg(F.sum("r").alias("s"))
        found = attach(attach(attach(left.select("param").distinct(), base, ("param",)), stops, ("param",), "left"), kept, ("param",), "left")
        if state is not None:
            found = attach(found, state.select("param", F.col("s").alias("_s")), ("param",), "left")
        total = F.coalesce("s", F.lit(0.0)) + (F.lit(0.0) if state is None else F.coalesce("_s", F.lit(0.0)))
        state = written(found.select("param", "total", total.alias("s"), (F.col("stop").isNull() & (F.col("longest") > high)).alias("open")), "sizes")
        remove_path(draws.sparkSession, lags.tallyforge_path)
        done.append(state.where("not open").select("param", F.try_divide("total", 2.0 * F.col("s") - 1.0).alias("ess")))
        going = state.where("open").select("param")
        if going.isEmpty():
            remove_path(draws.sparkSession, base.tallyforge_path)
            return reduce(lambda a, b: a.unionByName(b), done)
        left = attach(left, going, ("param",))
        low, high = high, 4 * high


def waic(loglik: DataFrame, width: float = 50.0) -> DataFrame:
    """``lppd, p_waic, waic`` from point-wise log-likelihoods ``(draw, obs, ll)``.

    The exponentials are summed relative to a multiple of ``width`` near each value, so no maximum has
    to be known beforehand and all draws of an observation are merged on the map side. What is left, a
    row or two per observation, is put on the common maximum afterwards.
    """
    anchor = F.floor(F.col("ll") / width) * width
    part = (
        loglik.where(F.col("ll").isNotNull())
        .groupBy("obs", anchor.cast("double").alias("e"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg("ll").alias("m"),
            F.var_pop("ll").alias("v"),
            F.sum(F.exp(F.col("ll") - anchor)).alias("s"),
        )
    )
    whole = Window.partitionBy("obs")
    n, top = F.sum("n").over(whole), F.max("e").over(whole)
    mean = F.sum(F.col("n") * F.col("m")).over(whole) / n
    points = (
        part.select("obs", "n", "m", "v", "s", "e", top.alias("top"), mean.alias("mean"))
        .groupBy("obs")
        .agg(
            (F.log(F.sum(F.col("s") * F.exp(F.col("e") - F.col("top"))) / F.sum("n")) + F.max("top")).alias("lpd"),
            F.try_divide(
                F.sum(F.col("n") * (F.col("v") + F.pow(F.col("m") - F.col("mean"), F.lit(2.0)))), F.sum("n") - 1
            ).alias("p"),
        )
    )
    total = points.agg(F.sum("lpd").alias("lppd"), F.sum("p").alias("p_waic"))
    return total.withColumn("waic", -2.0 * (F.col("lppd") - F.col("p_waic")))
