"""The censored fit with an intercept per patient against a brute-force likelihood, and every prefix of a boosted model."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyforge.operators import boosted, joins, metrics, models, survival
from tallyforge.sources import views


def patients(n, seed, hot=0.0):
    rng = np.random.default_rng(seed)
    who = np.where(rng.random(n) < hot, 0, rng.integers(1, n // 5, n))
    age = rng.integers(20, 80, n).astype(float)
    sex = rng.integers(0, 2, n)
    effect = rng.normal(0, 0.7, n)[who]
    y = 1.0 + 0.02 * age - 0.5 * sex + 0.01 * age * sex + effect + rng.normal(0, 0.5, n)
    limit = rng.normal(2.6, 1.0, n)
    cut = y > limit
    return pd.DataFrame({"patient": who, "age": age, "sex": np.where(sex, "m", "f"), "time": np.exp(np.minimum(y, limit)), "censored": cut.astype(int)})


def plain_loglik(pdf, terms, values):
    """The marginal log likelihood by a fine, even grid over each patient's intercept."""
    x = np.column_stack([{"age": pdf["age"], "sex_m": (pdf["sex"] == "m") * 1.0, "sex_f": (pdf["sex"] == "f") * 1.0,
                          "age:sex_m": pdf["age"] * (pdf["sex"] == "m"), "age:sex_f": pdf["age"] * (pdf["sex"] == "f"), "(intercept)": np.ones(len(pdf))}[t] for t in terms[:-2]])
    sigma, tau = values[-2:]
    b = np.linspace(-9 * tau, 9 * tau, 3001)
    z = ((np.log(pdf["time"].to_numpy()) - x @ values[:-2])[:, None] - b) / sigma
    dens = -0.5 * z * z - math.log(sigma * math.sqrt(2 * math.pi))
    c = pdf["censored"].to_numpy() == 1
    dens[c] = [[math.log(max(0.5 * math.erfc(v / math.sqrt(2)), 1e-300)) for v in row] for row in z[c]]
    total = 0.0
    for who in np.unique(pdf["patient"]):
        joint = dens[pdf["patient"].to_numpy() == who].sum(axis=0) - 0.5 * (b / tau) ** 2 - math.log(tau * math.sqrt(2 * math.pi))
        total += joint.max() + math.log(np.exp(joint - joint.max()).sum() * (b[1] - b[0]))
    return total


def newton_step(f, at, width=1e-3):
    """The step a numeric Newton method would take from here."""
    n, e = len(at), np.eye(len(at)) * width * np.maximum(np.abs(at), 0.05)
    g = np.array([(f(at + e[i]) - f(at - e[i])) / (2 * e[i, i]) for i in range(n)])
    h = np.zeros((n, n))
    for i in range(n):
        for j in range(i + 1):
            h[i, j] = h[j, i] = (f(at + e[i] + e[j]) - f(at + e[i] - e[j]) - f(at - e[i] + e[j]) + f(at - e[i] - e[j])) / (4 * e[i, i] * e[j, j])
    return -np.linalg.solve(h, g)


@pytest.mark.parametrize("formula", ["time ~ age", "time ~ age * sex"])
def test_estimates_are_the_maximum(spark, formula):
    pdf = patients(200, 3)
    fit = survival.fit_survival(spark.createDataFrame(pdf).repartition(3), formula)
    f = lambda v: plain_loglik(pdf, fit.names, v)
    assert fit.log_likelihood == pytest.approx(f(fit.values), abs=1e-4)
    assert np.abs(newton_step(f, fit.values)).max() < 5e-5


def test_hot_patient_in_slices_gives_the_same_fit(spark, monkeypatch):
    pdf = patients(600, 5, hot=0.4)
    df = spark.createDataFrame(pdf).repartition(4)
    whole = survival.fit_survival(df, "time ~ age + sex")
    monkeypatch.setattr(survival, "SLICE", 20)
    packed, _ = survival.pack(df, "time ~ age + sex", "censored", "patient")
    sizes = packed.select("slices", F.size("y").alias("n")).collect()
    assert max(r.slices for r in sizes) > 5 and max(r.n for r in sizes) < 60
    parts = survival.fit_survival(df, "time ~ age + sex")
    assert parts.names == whole.names
    assert parts.values == pytest.approx(whole.values, abs=1e-5) and parts.errors == pytest.approx(whole.errors, rel=1e-3)


def test_no_spread_between_patients(spark):
    pdf = patients(300, 11)
    pdf["patient"] = np.arange(300) % 60  # has nothing to do with the time
    fit = survival.fit_survival(spark.createDataFrame(pdf), "time ~ age")
    assert fit.values[-1] < 0.2 and fit.values[fit.names.index("age")] == pytest.approx(0.02, abs=0.01)
    pdf["time"] = np.exp(0.01 * pdf["age"] + 0.1 * np.tile([1, -1], 150))  # every patient has as many above as below
    pdf["patient"], pdf["censored"] = np.repeat(np.arange(150), 2), 0
    fit = survival.fit_survival(spark.createDataFrame(pdf), "time ~ age")
    assert (fit.values[-1], fit.errors[-1]) == (0.0, 0.0) and fit.values[-2] == pytest.approx(0.1, abs=1e-3)


def test_odd_rows_of_the_survival_fit(spark):
    pdf = patients(120, 7)
    df = spark.createDataFrame(pdf)
    odd = spark.createDataFrame([(None, 30.0, "m", 2.0, 1), (3, None, "m", 2.0, 0), (3, 30.0, None, 2.0, 0), (3, 30.0, "f", 0.0, 0), (3, 30.0, "f", -1.0, 0), (3, 30.0, "f", None, 0), (3, 30.0, "f", 2.0, None)], df.schema)
    a = survival.fit_survival(df, "time ~ age")
    b = survival.fit_survival(df.unionByName(odd.where("sex is not null")).withColumnRenamed("sex", "y"), "time ~ age")
    assert a.values == pytest.approx(b.values, abs=1e-6)
    with pytest.raises(ValueError, match="no complete row"):
        survival.fit_survival(odd.where("time <= 0"), "time ~ age")


def test_normal_tail():
    z = np.r_[np.linspace(-12, 12, 4001), 20, 30, 37]
    value, hazard = survival.log_survival(z)
    want = np.array([math.log(0.5 * math.erfc(v / math.sqrt(2))) for v in z])
    assert value == pytest.approx(want, rel=1e-9, abs=1e-14)
    assert hazard == pytest.approx(np.exp(-z * z / 2 - want) / math.sqrt(2 * math.pi), rel=1e-8)


@pytest.fixture(scope="module")
def classifier(spark, base):
    rows = views.breast_like(spark, base)
    columns = views.BREAST[:6]
    return models.fit_boosted_classifier(rows, columns, columns[:2], rounds=12), rows


def test_every_prefix_of_the_rounds(spark, classifier):
    model, rows = classifier
    rows = rows.withColumn("part", F.when(F.col("vec_id") % 3 != 0, "a"))
    curve = boosted.round_curve(model, rows, "target", ("part",)).collect()
    assert sorted((str(r.part), r.round) for r in curve) == sorted((p, k) for p in ("a", "None") for k in range(1, 13))
    last = {r.part: r for r in curve if r["round"] == 12}
    final = metrics.binary_metrics(models.predict_probability(model, rows), "probability", "target", ("part",)).collect()
    for r in final:
        assert (last[r.part].logloss, last[r.part].error) == pytest.approx((r.logloss, r.error))
    trees = boosted.Trees(model.stages[-1].toDebugString)
    assert len(trees.roots) == 12 and trees.weights == pytest.approx(list(model.stages[-1].treeWeights))
    # a shorter sum of trees, asked of the trees themselves
    vectors = [r.features for r in models.PipelineModel(model.stages[:-1]).transform(rows).limit(20).select("features").collect()]
    own = trees.sums(np.array([v.toArray() for v in vectors]))
    for i, v in enumerate(vectors):
        assert own[i] == pytest.approx(np.cumsum([w * t.predict(v) for t, w in zip(model.stages[-1].trees, model.stages[-1].treeWeights)]))


def test_curve_of_odd_rows(spark, classifier):
    model, rows = classifier
    none = rows.limit(5).withColumn("target", F.lit(None).cast("long"))
    assert boosted.round_curve(model, none, "target").count() == 0
    twice = joins.union_all(rows, rows)
    once = {r["round"]: r for r in boosted.round_curve(model, rows, "target").collect()}
    for r in boosted.round_curve(model, twice, "target").collect():
        assert r.n == 2 * once[r["round"]].n and r.logloss == pytest.approx(once[r["round"]].logloss)
