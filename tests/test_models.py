"""Preparation, fits and scoring: bounds, optimality, reload."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import Bucketizer
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from tallyforge.operators import features, joins, lambda_path, metrics, models, sampling
from tallyforge.operators.moments import block_moments, moments, stack
from tallyforge.session import work_path
from tallyforge.sources import views

WINE = ("alcohol", "ph", "sulphates")

# Five rows to score, eleven measurements each.
SCORING_ROWS = (
    (7.4, 0.7, 0, 1.9, 0.076, 11, 34, 0.9978, 3.51, 0.56, 9.4),
    (7.8, 0.88, 0, 2.6, 0.098, 25, 67, 0.9968, 3.2, 0.68, 9.8),
    (7.8, 0.76, 0.04, 2.3, 0.092, 15, 54, 0.997, 3.26, 0.65, 9.8),
    (11.2, 0.28, 0.56, 1.9, 0.075, 17, 60, 0.998, 3.16, 0.58, 9.8),
    (7.4, 0.7, 0, 1.9, 0.076, 11, 34, 0.9978, 3.51, 0.56, 9.4),
)


@pytest.fixture(scope="module")
def wine(spark, base):
    return views.wine(spark, base).cache()


@pytest.fixture(scope="module")
def local(wine):
    return wine.toPandas()


def test_metrics_by_hand(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (3.0, 5.0)], "p double, y double")
    row = metrics.regression_metrics(df, "p", "y").first()
    assert row["rmse"] == pytest.approx(np.sqrt(5 / 3)) and row["mae"] == 1.0
    assert row["r2"] == pytest.approx(np.corrcoef([1, 2, 3], [2, 2, 5])[0, 1] ** 2)
    constant = metrics.regression_metrics(df.withColumn("p", F.lit(1.0)), "p", "y").first()
    assert constant["r2"] is None
    binary = spark.createDataFrame([(1.0, 1), (0.0, 1), (0.5, 0)], "p double, y int")
    row = metrics.binary_metrics(binary, "p", "y").first()
    assert row["error"] == pytest.approx(1 / 3) and 0 < row["logloss"] < 20


def test_best_row_tie(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", 2.0), ("d", None)], "run string, m double")
    assert metrics.best_row(df, "m", "run").first()["run"] == "a"
    assert metrics.best_row(df, "m", "run", "max").first()["run"] == "c"


def test_recipe_uses_training_statistics_only(spark):
    train = spark.createDataFrame(
        [(10.0, " 36 months", "1", "1", "NA"), (11.0, " 60 months", "3", None, "4"), (12.0, None, "5", "9", "6")],
        "int_rate double, term string, bc_util string, bc_open_to_buy string, all_util string",
    )
    recipe, names = features.fit_recipe(train)
    assert names == ["bc_open_to_buy", "bc_util", "all_util", "term_60_months"]
    other = spark.createDataFrame([(" 60 months", "3", None, "n/a"), (None, "7", "5", "5")], "term string, bc_util string, bc_open_to_buy string, all_util string")
    first, second = recipe.transform(other).collect()
    assert (first["bc_util"], first["bc_open_to_buy"], first["all_util"], first["term_60_months"]) == (0.0, 0.0, 0.0, 1.0)
    assert second["bc_util"] == 2.0 and second["all_util"] == 0.0 and second["term_60_months"] is None


def test_dummy_names_and_quotes(spark):
    df = spark.createDataFrame([("a",), ("it's",), (None,), ("b\\c",)], "x string")
    stage = features.fit_dummy(df, "x")
    rows = [tuple(r) for r in stage.transform(df).collect()]
    assert rows == [(0.0, 0.0), (0.0, 1.0), (None, None), (1.0, 0.0)]


def test_scaler_ddof_and_constant(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    assert [tuple(r) for r in features.fit_scaler(df, ("a", "b")).transform(df).collect()] == [(-1.0, 0.0), (1.0, 0.0)]
    scaled = features.fit_scaler(df, ("a",), ddof=1, suffix="_s").transform(df)
    assert scaled.first()["a_s"] == pytest.approx(-1 / np.sqrt(2))


def solve(local, alpha, lam, columns=WINE, standardize=False):
    x, y = local[list(columns)].to_numpy(float), local["quality"].to_numpy(float)
    cov = np.cov(np.column_stack([x, y]).T, bias=True)
    return lambda_path.coefficients(cov, alpha, np.array([lam]), standardize)[0]


def test_moments_match_numpy(wine, local):
    row = moments(wine, (*WINE, "quality")).toPandas()
    data = local[[*WINE, "quality"]].to_numpy(float)
    assert np.allclose(stack(row["mean"], 4)[0], data.mean(axis=0))
    assert np.allclose(stack(row["cov"], 16)[0].reshape(4, 4), np.cov(data.T, bias=True))


@pytest.mark.parametrize("alpha,lam", [*views.WINE_RUNS, (1.0, 0.05), (0.0, 0.3)])
def test_elastic_net_is_optimal_and_agrees_with_the_path_solver(wine, local, alpha, lam):
    fit = models.fit_elastic_net(wine, WINE, "quality", alpha, lam).stages[-1]
    b = fit.coefficients.toArray()
    x, y = local[list(WINE)].to_numpy(float), local["quality"].to_numpy(float)
    residual = y - x @ b - fit.intercept
    gradient = (x - x.mean(axis=0)).T @ residual / len(y) - lam * (1 - alpha) / y.std() * b
    for g, c in zip(gradient, b):
        if c == 0:
            assert abs(g) <= lam * alpha + 1e-3
        else:
            assert g == pytest.approx(lam * alpha * np.sign(c), abs=1e-3)
    assert np.allclose(solve(local, alpha, lam), b, atol=2e-3)


def test_cross_validation_against_refits(wine, local):
    errors = lambda_path.fold_errors(wine, WINE, "quality", "wine_id", 0.14, folds=4, points=12)
    found = errors.toPandas()
    folds = {r["wine_id"]: r["fold"] for r in sampling.with_folds(wine, "wine_id", 4).collect()}
    local = local.assign(fold=local["wine_id"].map(folds))
    for lam, fold in found[["lam", "fold"]].drop_duplicates().itertuples(index=False):
        train, test = local[local.fold != fold], local[local.fold == fold]
        b = solve(train, 0.14, lam, standardize=True)
        x = test[list(WINE)].to_numpy(float) - train[list(WINE)].to_numpy(float).mean(axis=0)
        mse = np.mean((test["quality"] - train["quality"].mean() - x @ b) ** 2)
        row = found[(found.lam == lam) & (found.fold == fold)].iloc[0]
        assert row["mse"] == pytest.approx(mse, rel=1e-6) and row["n"] == len(test)
    curve = lambda_path.error_curve(errors)
    local_curve = curve.toPandas()
    best = local_curve.loc[local_curve.cvm.idxmin()]
    rule = lambda_path.one_se_rule(curve).first()
    assert rule["lambda_min"] == pytest.approx(best.lam)
    assert rule["lambda_1se"] == pytest.approx(local_curve[local_curve.cvm <= best.cvm + best.cvsd].lam.max())
    assert rule["lambda_1se"] >= rule["lambda_min"]


def test_chosen_penalty_can_be_used(wine):
    lam = lambda_path.choose_lambda(wine, WINE, "quality", "wine_id", 0.5, folds=5)
    assert lam > 0
    fit = models.fit_elastic_net(wine, WINE, "quality", 0.5, lam)
    assert models.evaluate(fit, wine, "quality")["r2"] > 0


def test_model_beats_the_mean_and_survives_a_reload(spark, wine):
    train, test = sampling.split_exact(wine, "wine_id")
    model = models.fit_elastic_net(train, WINE, "quality", 0.14, 0.05)
    found = models.evaluate(model, test, "quality")
    mean_only = test.withColumn("p", F.lit(train.agg(F.avg("quality")).first()[0]))
    assert found["rmse"] < metrics.regression_metrics(mean_only, "p", "quality").first()["rmse"]
    uri = models.save_model(model, work_path(spark, "model"))
    again = models.score_saved(uri, test, "wine_quality_pred").orderBy("wine_id").collect()
    direct = models.predict(model, test).orderBy("wine_id").collect()
    assert [r["wine_quality_pred"] for r in again] == [r["prediction"] for r in direct]
    assert len(again) == test.count()


def test_rate_model(spark, base):
    rows = features.rate_rows(views.loans(spark, base))
    model, names = models.fit_rate_model(rows, trees=8)
    scored = models.predict(model, rows, "rate_pred")
    assert scored.count() == rows.count() and scored.columns == [*rows.columns, "rate_pred"]
    fit = metrics.regression_metrics(scored, "rate_pred", "int_rate").first()
    spread = rows.agg(F.stddev_pop("int_rate")).first()[0]
    assert fit["rmse"] < spread and 0 < fit["r2"] <= 1
    uri = models.save_model(model, work_path(spark, "model"))
    again = models.score_saved(uri, rows, "rate_pred")
    assert again.exceptAll(scored).count() == 0
    top = models.top_importances(models.importances(model, names, rows), 2).collect()
    assert top[0]["importance"] >= top[1]["importance"]
    first = models.top_importances(models.importances(model, names, rows), 2, "first").collect()
    assert [r["feature"] for r in first] == names[:2]


def test_rate_model_is_fitted_on_cells_of_equal_bins(spark, monkeypatch):
    """Each cell once, all rows counted, and the same trees as on the rows one by one."""
    rows = spark.range(3000).selectExpr(
        "id AS member_id", "double(5 + id * id % 23) AS int_rate", "if(id % 3 = 0, ' 60 months', ' 36 months') AS term",
        "string(id % 30) AS bc_util", "if(id % 3 = 1, NULL, string(7 * (id % 5))) AS bc_open_to_buy", "string(id % 2) AS all_util")
    seen, fit = [], GBTRegressor.fit

    def noted(self, df):
        seen.append((df.count(), df.agg(F.sum("_rows")).first()[0] if "_rows" in df.columns else None))
        return fit(self, df)

    monkeypatch.setattr(GBTRegressor, "fit", noted)
    model, names = models.fit_rate_model(rows, trees=6)
    assert seen == [(30, 3000.0)]
    at = next(i for i, stage in enumerate(model.stages) if isinstance(stage, Bucketizer))
    ready = features.assembler(names, "keep").transform(PipelineModel(model.stages[:at]).transform(rows))
    plain = fit(GBTRegressor(labelCol="int_rate", maxIter=6, maxDepth=5, seed=42), ready)
    both = models.predict(model, models.predict(PipelineModel([plain]), ready, "a").select(*rows.columns, "a"), "b")
    assert both.where("abs(a - b) < 1e-9").count() == 3000
    with pytest.raises(Exception, match="(?i)label"):
        models.fit_rate_model(rows.withColumn("int_rate", F.expr("if(member_id = 7, NULL, int_rate)")), trees=2)


def test_bin_edges(spark, monkeypatch):
    assert features.bin_edges(np.array([1.0, 2.0, 4.0]), np.array([5, 1, 9])) == [1.5, 3.0]
    assert features.bin_edges(np.arange(100.0), np.ones(100, int), 3) == [24.5, 49.5, 74.5]
    assert features.bin_edges(np.array([3.0]), np.array([8])) == []
    rows = spark.createDataFrame([(x, 0.0) for x in (1.0, 2.0, 2.0, 4.0)], "x double, y double")
    bins = features.fit_bins(rows, ["x", "y"])
    found = bins.transform(spark.createDataFrame([(1.5, 0.0), (3.5, 0.0), (2.0, 0.0), (-9.0, 0.0)], "x double, y double")).collect()
    assert [(r.x_bin, r.y_bin) for r in found] == [(0.0, 0.0), (2.0, 0.0), (1.0, 0.0), (0.0, 0.0)]  # an edge belongs to the lower bin
    monkeypatch.setattr(features, "EDGE_VALUES", 50)  # more values: edges of a sample, every row is binned
    many = spark.range(5000).selectExpr("double(id) AS x")
    sizes = features.fit_bins(many, ["x"]).transform(many).groupBy("x_bin").count().collect()
    assert len(sizes) == 32 and sum(r["count"] for r in sizes) == 5000


def test_union_keeps_names_and_duplicates(spark):
    a = spark.createDataFrame([(1, "x")], "k int, s string")
    b = spark.createDataFrame([("x", 1)], "s string, k int")
    assert [tuple(r) for r in joins.union_all(a, b).collect()] == [(1, "x"), (1, "x")]


def test_scoring_rows_are_filled_by_row(spark):
    names = ("fixed_acidity", "volatile_acidity", "citric_acid", "residual_sugar", "chlorides", "free_sulfur_dioxide",
             "total_sulfur_dioxide", "density", "ph", "sulphates", "alcohol")
    rows = spark.createDataFrame([tuple(map(float, r)) for r in SCORING_ROWS], ", ".join(f"{n} double" for n in names))
    train = rows.withColumn("quality", F.col("alcohol") * 0.5)
    scored = models.predict(models.fit_elastic_net(train, ("alcohol",), "quality", 0.0, 0.0), rows)
    assert [round(r["prediction"], 6) for r in scored.collect()] == [4.7, 4.9, 4.9, 4.9, 4.7]


def test_thousands_of_columns(spark):
    rng = np.random.default_rng(4)
    n, p = 400, 2000
    x = rng.normal(size=(n, p)).round(3)
    y = 3 * x[:, 7] - 2 * x[:, 1500] + 0.5 + rng.normal(size=n) * 0.1
    names = [f"f{i}" for i in range(p)]
    rows = spark.createDataFrame([(float(v), r.tolist()) for v, r in zip(y, x)], "y double, x array<double>").repartition(3)
    wide = rows.select("y", *[F.col("x")[i].alias(c) for i, c in enumerate(names)])
    count, mean, cov = block_moments(wide, (*names, "y"))
    both = np.column_stack([x, y])
    assert count == n and mean == pytest.approx(both.mean(axis=0)) and np.allclose(cov, np.cov(both.T, bias=True))
    fit = models.fit_elastic_net(wide, tuple(names), "y", 1.0, 0.5).stages[-1]
    b = fit.coefficients.toArray()
    assert set(np.flatnonzero(np.abs(b) > 0.05)) == {7, 1500} and b[7] > 2 > 0 > b[1500]
    gap = cov[:p, p] - cov[:p, :p] @ b  # the conditions of the least penalised error
    assert np.abs(gap).max() < 0.5 + 1e-8 and np.allclose(gap[b != 0], 0.5 * np.sign(b[b != 0]))


def test_block_moments_of_odd_rows(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 1.0), (3.0, float("nan")), (5.0, 4.0)], "a double, b double")
    n, mean, cov = block_moments(df, ("a", "b"), block=1)
    assert n == 2 and mean.tolist() == [3.0, 3.0] and cov.tolist() == [[4.0, 2.0], [2.0, 1.0]]
    assert block_moments(df.limit(0), ("a", "b"))[0] == 0
    with pytest.raises(ValueError, match="no row"):
        models.fit_elastic_net(df.limit(0), ("a",), "b", 0.5, 0.1)
