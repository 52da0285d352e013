"""Queries for feature preparation, fits, grids, run tables, group fits and posterior checks."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.functions import columns as C
from tallyforge.functions.frames import rounded
from tallyforge.functions.normal import inverse_normal_sql
from tallyforge.functions.text import join_rows
from tallyforge.operators import boosted, draws, features, grids, group_fits, joins, lambda_path, models, pooling, runs, sampling, survival
from tallyforge.operators.filters import filter_metric, row_slice
from tallyforge.operators.metrics import binary_metrics, regression_metrics
from tallyforge.plans.registry import query
from tallyforge.session import remove_path, work_path, written
from tallyforge.sources import files, lookups, tables, views

WINE, BREAST = views.WINE, views.BREAST
#: The numbers of trees of the boosted grid.
TREE_GRID = (100, 150, 200, 250, 300)


# Preparation


@query(
    "agg_scaler",
    """
WITH marked AS (SELECT *, row_number() OVER (ORDER BY vec_id) <= floor(0.7 * count(*) OVER ()) AS is_train FROM breast_like),
stats AS (SELECT avg(mean_radius) AS m1, stddev_pop(mean_radius) AS s1, avg(mean_texture) AS m2, stddev_pop(mean_texture) AS s2 FROM marked WHERE is_train)
SELECT vec_id, is_train, round((mean_radius - m1) / s1, 6) AS mean_radius, round((mean_texture - m2) / s2, 6) AS mean_texture FROM marked, stats
""",
    ("breast_like",),
)
def agg_scaler(spark, base):
    rows = views.breast_like(spark, base).select("vec_id", "mean_radius", "mean_texture")
    marked = sampling.mark_split_ordered(rows, "vec_id")
    scaler = features.fit_scaler(marked.where("is_train"), ("mean_radius", "mean_texture"))
    return rounded(scaler.transform(marked), 6, "mean_radius", "mean_texture").select(
        "vec_id", "is_train", "mean_radius", "mean_texture"
    )


RATE_SQL = """
WITH rates AS (SELECT member_id, try_cast(replace(int_rate,'%','') AS DOUBLE) AS int_rate, term, try_cast(bc_util AS DOUBLE) AS u,
    try_cast(bc_open_to_buy AS DOUBLE) AS o, try_cast(all_util AS DOUBLE) AS a FROM loans),
kept AS (SELECT * FROM rates WHERE int_rate IS NOT NULL),
st AS (SELECT avg(u) AS mu, stddev_samp(u) AS su, avg(o) AS mo, stddev_samp(o) AS so, avg(a) AS ma, stddev_samp(a) AS sa FROM kept)
"""


@query(
    "prep_recipe",
    RATE_SQL
    + """SELECT member_id, int_rate, round(coalesce((u - mu) / su, 0), 6) AS bc_util, round(coalesce((o - mo) / so, 0), 6) AS bc_open_to_buy,
 round(coalesce((a - ma) / sa, 0), 6) AS all_util, CAST(term = ' 60 months' AS DOUBLE) AS term_60_months FROM kept, st""",
    ("loans",),
)
def prep_recipe(spark, base):
    rows = features.rate_rows(views.loans(spark, base))
    recipe, _ = features.fit_recipe(rows)
    return rounded(recipe.transform(rows), 6, *features.RECIPE_COLUMNS)


@query(
    "step_dummy",
    "SELECT member_id, "
    + ", ".join(f"CAST(grade = '{g}' AS DOUBLE) AS grade_{g.lower()}" for g in "BCDEFG")
    + " FROM loans",
    ("loans",),
)
def step_dummy(spark, base):
    rows = views.loans(spark, base).select("member_id", "grade")
    return features.fit_dummy(rows, "grade").transform(rows)


@query(
    "step_impute_mean",
    "SELECT member_id, round(coalesce(try_cast(bc_util AS DOUBLE), avg(try_cast(bc_util AS DOUBLE)) OVER ()), 6) AS bc_util FROM loans",
    ("loans",),
)
def step_impute_mean(spark, base):
    rows = views.loans(spark, base).select("member_id", C.to_numeric("bc_util").alias("bc_util"))
    return rounded(features.fit_impute_mean(rows, ("bc_util",)).transform(rows), 6, "bc_util")


@query("features_matrix", f"SELECT wine_id, round({' + '.join(WINE)}, 8) AS total FROM wine", ("wine",))
def features_matrix(spark, base):
    """The sum over each row's feature vector; NULL where a feature is missing."""
    rows = features.assembler(WINE, "keep").transform(views.wine(spark, base))
    total = F.aggregate(models.vector_to_array("features"), F.lit(0.0), lambda a, x: a + x)
    return rows.select("wine_id", F.round(F.when(~F.isnan(total), total), 8).alias("total"))


# Fits


def wine_split(spark, base) -> tuple[DataFrame, DataFrame]:
    return sampling.split_exact(views.wine(spark, base), "wine_id")


def net_sql(runs_wanted: tuple[tuple[float, float], ...], sweeps: int = 60) -> str:
    """SQL of the elastic-net fits: the split, the moments of the training rows, coordinate descent over the coefficients one
    after the other, and ``scored``, every wine row with its prediction by each run."""
    p = len(WINE)
    gram = ", ".join("[" + ", ".join(f"covar_pop({a}, {b})" for b in WINE) + "]" for a in WINE)
    known = " AND ".join(f"{c} IS NOT NULL" for c in WINE)
    values = ", ".join(f"({i}, CAST({a} AS DOUBLE), CAST({x} AS DOUBLE))" for i, (a, x) in enumerate(runs_wanted))
    rest = "t[k] - list_dot_product(g[k], b) + g[k][k] * b[k]"
    soft = f"sign({rest}) * greatest(abs({rest}) - l1, 0) / (g[k][k] + l2)"
    prediction = " + ".join(f"b[{i + 1}] * (w.{c} - m[{i + 1}])" for i, c in enumerate(WINE))
    return f"""
WITH RECURSIVE split AS (SELECT *, row_number() OVER (ORDER BY md5(CAST(wine_id AS STRING) || ':42'), wine_id) <= floor(0.75 * count(*) OVER ()) AS is_train FROM wine),
mom AS (SELECT [{gram}] AS g, [{", ".join(f"covar_pop({c}, quality)" for c in WINE)}] AS t, [{", ".join(f"avg({c})" for c in WINE)}] AS m, avg(quality) AS my, stddev_pop(quality) AS sy
  FROM split WHERE is_train AND {known}),
wanted AS (SELECT run, alpha, lam, g, t, m, my, lam * alpha AS l1, lam * (1 - alpha) / sy AS l2 FROM (VALUES {values}) AS v(run, alpha, lam), mom),
cd AS (SELECT run, 0 AS i, [{", ".join(["0::DOUBLE"] * p)}] AS b FROM wanted
  UNION ALL SELECT cd.run, i + 1, list_transform(b, lambda old, place: CASE WHEN place = k THEN step ELSE old END)
  FROM (SELECT run, i, b, k, {soft} AS step FROM (SELECT cd.run, i, b, i % {p} + 1 AS k, g, t, l1, l2 FROM cd JOIN wanted ON wanted.run = cd.run WHERE i < {p * sweeps})) cd),
scored AS (SELECT w.*, v.run, alpha, lam, my + {prediction} AS prediction FROM split w, cd JOIN wanted v ON v.run = cd.run WHERE i = {p * sweeps}),
held AS (SELECT run, any_value(alpha) AS alpha, any_value(lam) AS lam, sqrt(avg(pow(prediction - quality, 2))) AS rmse, avg(abs(prediction - quality)) AS mae,
  pow(corr(prediction, quality), 2) AS r2 FROM scored WHERE NOT is_train AND prediction IS NOT NULL GROUP BY run)
"""


ROUNDED_METRICS = "round(rmse, 6) AS rmse, round(mae, 6) AS mae, round(r2, 6) AS r2"
BEST_SQL = net_sql(views.WINE_RUNS) + "SELECT wine_id, round(prediction, 4) AS wine_quality_pred FROM scored WHERE run = (SELECT run FROM held ORDER BY round(r2, 9) DESC, run LIMIT 1)"


@query("fit_elastic_net", net_sql(views.WINE_RUNS[:1]) + "SELECT wine_id, quality, round(prediction, 4) AS prediction FROM scored WHERE NOT is_train", ("wine",))
def fit_elastic_net(spark, base):
    train, test = wine_split(spark, base)
    model = models.fit_elastic_net(train, WINE, "quality", *views.WINE_RUNS[0])
    return rounded(models.predict(model, test).select("wine_id", "quality", "prediction"), 4, "prediction")


@query("predict_append", net_sql(views.WINE_RUNS[1:2]) + f"SELECT {ROUNDED_METRICS} FROM held", ("wine",))
def predict_append(spark, base):
    train, test = wine_split(spark, base)
    model = models.fit_elastic_net(train, WINE, "quality", *views.WINE_RUNS[1])
    return rounded(regression_metrics(models.predict(model, test), "prediction", "quality"), 6, "rmse", "mae", "r2")


CV_ALPHA, CV_FOLDS, CV_POINTS, CV_SWEEPS = 0.14, 10, 100, 15


def cv_sql() -> str:
    """SQL of the cross-validated curve: moments with and without each fold, coordinate descent along the falling penalties for
    all folds side by side, and the held-out errors from the moments of the fold."""
    p = len(WINE)
    known = " AND ".join(f"{c} IS NOT NULL" for c in WINE)
    cov = "[" + ", ".join("[" + ", ".join(f"covar_pop({a}, {b})" for b in (*WINE, "quality")) + "]" for a in (*WINE, "quality")) + "]"
    mean = "[" + ", ".join(f"avg({c})" for c in (*WINE, "quality")) + "]"
    gram = "[" + ", ".join("[" + ", ".join(f"c[{i + 1}][{j + 1}] / (s[{i + 1}] * s[{j + 1}])" for j in range(p)) + "]" for i in range(p)) + "]"
    target = "[" + ", ".join(f"c[{i + 1}][{p + 1}] / s[{i + 1}]" for i in range(p)) + "]"
    sds = "[" + ", ".join(f"sqrt(c[{i + 1}][{i + 1}])" for i in range(p + 1)) + "]"
    slopes = "[" + ", ".join(f"b[{i + 1}] / s[{i + 1}]" for i in range(p)) + "]"
    rest = "t[k] - list_dot_product(g[k], b) + g[k][k] * b[k]"
    soft = f"sign({rest}) * greatest(abs({rest}) - lam * {CV_ALPHA}, 0) / (g[k][k] + lam * {1 - CV_ALPHA!r} / s[{p + 1}])"
    quad = " + ".join(f"d[{i + 1}] * list_dot_product(d, hc[{i + 1}][1:{p}])" for i in range(p))
    cross = " + ".join(f"d[{i + 1}] * hc[{i + 1}][{p + 1}]" for i in range(p))
    shift = " - ".join([f"(hm[{p + 1}] - m[{p + 1}])", *(f"d[{i + 1}] * (hm[{i + 1}] - m[{i + 1}])" for i in range(p))])
    key = "CAST('0x' || substr(md5(CAST(wine_id AS STRING) || ':42'), 1, 8) AS BIGINT)"
    per = p * CV_SWEEPS
    return f"""
WITH RECURSIVE split AS (SELECT *, row_number() OVER (ORDER BY md5(CAST(wine_id AS STRING) || ':42'), wine_id) <= floor(0.75 * count(*) OVER ()) AS is_train FROM wine),
used AS (SELECT *, CAST({key} % {CV_FOLDS} AS INT) AS fold FROM split WHERE is_train AND {known}),
folds AS (SELECT fold, count(*) AS n, {cov} AS hc, {mean} AS hm FROM used GROUP BY fold),
rest AS (SELECT *, {sds} AS s FROM (SELECT f.fold, {cov} AS c, {mean} AS m FROM used u, folds f WHERE u.fold <> f.fold GROUP BY f.fold)),
whole AS (SELECT {cov} AS c FROM used),
top AS (SELECT greatest({", ".join(f"abs(c[{i + 1}][{p + 1}]) / sqrt(c[{i + 1}][{i + 1}])" for i in range(p))}) / {CV_ALPHA} AS top FROM whole),
lams AS (SELECT i, exp(ln(top) + i * ln(1e-4) / {CV_POINTS - 1}) AS lam FROM top, (SELECT unnest(range({CV_POINTS})) AS i)),
scaled AS (SELECT fold, m, s, {gram} AS g, {target} AS t FROM rest),
cd AS (SELECT fold, 0 AS i, [{", ".join(["0::DOUBLE"] * p)}] AS b FROM scaled
  UNION ALL SELECT fold, i + 1, list_transform(b, lambda old, place: CASE WHEN place = k THEN step ELSE old END)
  FROM (SELECT fold, i, b, k, {soft} AS step FROM (SELECT cd.fold, cd.i, b, cd.i % {p} + 1 AS k, g, t, s, lam FROM cd JOIN scaled ON scaled.fold = cd.fold JOIN lams ON lams.i = cd.i // {per}) x) y),
path AS (SELECT lam, n, hc, hm, m, {slopes} AS d FROM cd JOIN scaled ON scaled.fold = cd.fold JOIN folds ON folds.fold = cd.fold JOIN lams ON lams.i = cd.i // {per} - 1 WHERE cd.i > 0 AND cd.i % {per} = 0),
err AS (SELECT lam, n, hc[{p + 1}][{p + 1}] + pow({shift}, 2) - 2 * ({cross}) + {quad} AS mse FROM path),
curve AS (SELECT lam, sum(n * mse) / sum(n) AS cvm, sqrt(greatest(sum(n * mse * mse) / sum(n) - pow(sum(n * mse) / sum(n), 2), 0) / (count(*) - 1)) AS cvsd FROM err GROUP BY lam)
"""


@query("cv_lambda_curve", cv_sql() + "SELECT round(lam, 6) AS lam, round(cvm, 6) AS cvm, round(cvsd, 6) AS cvsd FROM curve", ("wine",))
def cv_lambda_curve(spark, base):
    return rounded(wine_curve(spark, base), 6, "lam", "cvm", "cvsd")


def wine_curve(spark, base) -> DataFrame:
    errors = lambda_path.fold_errors(wine_split(spark, base)[0], WINE, "quality", "wine_id", alpha=CV_ALPHA, folds=CV_FOLDS, points=CV_POINTS)
    return lambda_path.error_curve(errors)


@query(
    "cv_lambda_1se",
    cv_sql() + ", least AS (SELECT * FROM curve ORDER BY cvm, lam DESC LIMIT 1) SELECT round(any_value(l.lam), 6) AS lambda_min, round(max(c.lam), 6) AS lambda_1se"
    " FROM curve c, least l WHERE c.cvm <= l.cvm + l.cvsd",
    ("wine",),
)
def cv_lambda_1se(spark, base):
    return rounded(lambda_path.one_se_rule(wine_curve(spark, base)), 6, "lambda_min", "lambda_1se")


def elastic_runs(spark, base) -> tuple[str, str]:
    """Fit, log and store the three elastic-net runs, at the same time and on one kept split; the log path and the name of the models.

    Metrics are logged with nine decimals: fits that keep the same feature have the same ``r2``, and noise should not rank them.
    """
    log, name = work_path(spark, "runs"), "wine-model"
    kept = written(sampling.mark_split(views.wine(spark, base), "wine_id"), "split")
    train, test = kept.where("is_train").drop("is_train"), kept.where("not is_train").drop("is_train")
    signature = tables.signature_json(train.select(*WINE))

    def one(alpha: float, lam: float) -> tuple[str, dict, dict, str]:
        model = models.fit_elastic_net(train, WINE, "quality", alpha, lam)
        artifacts = work_path(spark, "artifacts")
        models.save_model(model, f"{artifacts}/{name}")
        files.write_results(signature, f"{artifacts}/signature")
        return f"alpha {alpha} lambda {lam}", {"alpha": alpha, "lambda": lam}, {k: round(v, 9) for k, v in models.evaluate(model, test, "quality").items()}, artifacts

    found = grids.run_all(spark, {f"{a}-{x}": partial(one, a, x) for a, x in views.WINE_RUNS})
    runs.log_runs(spark, log, list(found.values()))
    remove_path(spark, kept.tallyforge_path)
    return log, name


def run_table(spark, log: str) -> DataFrame:
    return spark.read.schema(runs.LOG_SCHEMA).parquet(log)


@query(
    "grid_runs",
    net_sql(views.WINE_RUNS) + f"SELECT 'alpha ' || alpha || ' lambda ' || lam AS run_id, alpha, lam AS lambda, {ROUNDED_METRICS} FROM held ORDER BY held.r2 DESC, run_id",
    ("wine",),
)
def grid_runs(spark, base):
    log, _ = elastic_runs(spark, base)
    return rounded(runs.run_search(run_table(spark, log), ("alpha", "lambda", "rmse", "mae", "r2"), "r2"), 6, "rmse", "mae", "r2")


@query("score_saved", BEST_SQL, ("wine",))
def score_saved(spark, base):
    log, name = elastic_runs(spark, base)
    rows = run_table(spark, log)
    best = runs.top_run(rows, ("r2",), "r2").select("run_id")
    uri = rows.where("kind = 'artifact'").join(best, "run_id").select(runs.model_uri(F.col("value"), F.lit(name)).alias("uri"))
    wine = views.wine(spark, base).drop("quality")
    scored = models.score_saved(uri.first()["uri"], wine, "wine_quality_pred").select("wine_id", "wine_quality_pred")
    return rounded(scored, 4, "wine_quality_pred")


def register_best(spark, base) -> str:
    """From the runs to a version: the best run's model becomes the next version of its name; the path of the versions."""
    log, name = elastic_runs(spark, base)
    rows, versions = run_table(spark, log), work_path(spark, "versions")
    best = runs.top_run(rows, ("r2",), "r2").select("run_id")
    found = rows.where("kind = 'artifact'").join(best, "run_id").select("run_id", runs.model_uri(F.col("value"), F.lit(name)).alias("uri")).first()
    runs.register_version(spark, versions, name, found["run_id"], found["uri"])
    return versions


@query("register_version", "SELECT 'wine-model' AS name, CAST(1 AS BIGINT) AS version")
def register_version(spark, base):
    return runs.versions(spark, register_best(spark, base)).select("name", "version")


@query("score_registered", BEST_SQL, ("wine",))
def score_registered(spark, base):
    """All wine rows scored with the model of the last registered version."""
    uri = runs.versions(spark, register_best(spark, base)).orderBy(F.desc("version")).first()["uri"]
    scored = models.score_saved(uri, views.wine(spark, base).drop("quality"), "wine_quality_pred").select("wine_id", "wine_quality_pred")
    return rounded(scored, 4, "wine_quality_pred")


@query(
    "score_text",
    net_sql(views.WINE_RUNS[:1]) + "SELECT string_agg(CAST(round(prediction, 4) AS VARCHAR), ', ' ORDER BY wine_id) AS predictions FROM (SELECT * FROM scored ORDER BY wine_id LIMIT 5)",
    ("wine",),
)
def score_text(spark, base):
    train, _ = wine_split(spark, base)
    model = models.fit_elastic_net(train, WINE, "quality", *views.WINE_RUNS[0])
    scored = models.predict(model, row_slice(views.wine(spark, base), "wine_id", 5))
    return join_rows(rounded(scored, 4, "prediction"), "wine_id", "prediction", "predictions")


@query("fit_gbt_reg")
def fit_gbt_reg(spark, base):
    train, test = sampling.split_exact(features.rate_rows(views.loans(spark, base)), "member_id")
    model, _ = models.fit_rate_model(train)
    return models.predict(model, test, "rate_pred").select("member_id", "int_rate", "rate_pred")


@query("fit_gbt_grid")
def fit_gbt_grid(spark, base):
    """Boosted trees for the grid of tree numbers, held-out metrics, best run first.

    One fit of the largest number gives all the others, which are its first trees. Each run is logged with its
    parameters, metrics, model and signature.
    """
    log, name = work_path(spark, "runs"), "rate-model"
    train, test = sampling.split_exact(features.rate_rows(views.loans(spark, base)), "member_id")
    whole, _ = models.fit_rate_model(train, trees=max(TREE_GRID))
    scored, fits = test, {}
    for trees in TREE_GRID:
        fits[trees] = models.shorter(whole, trees)
        scored = models.predict(fits[trees], scored, f"p{trees}")
    long = scored.unpivot(["int_rate"], [f"p{t}" for t in TREE_GRID], "trees", "prediction")
    found = {r["trees"]: r.asDict() for r in regression_metrics(long, "prediction", "int_rate", ("trees",)).collect()}
    for trees, model in fits.items():
        artifacts = work_path(spark, "artifacts")
        models.save_model(model, f"{artifacts}/{name}")
        files.write_results(tables.signature_json(train), f"{artifacts}/signature")
        values = {k: v for k, v in found[f"p{trees}"].items() if k != "trees"}
        runs.log_run(spark, log, f"trees-{trees}", {"trees": trees, "engine": "gbt"}, values, artifacts)
    return runs.run_search(run_table(spark, log), ("trees", "engine", "rmse", "mae", "r2"), "r2")


def breast_split(spark, base) -> tuple[DataFrame, DataFrame]:
    return sampling.split_ordered(views.breast_like(spark, base), "vec_id")


def breast_classifier(spark, base):
    train, valid = breast_split(spark, base)
    model = models.fit_boosted_classifier(train, BREAST, BREAST[:2])
    return model, joins.union_all(train.withColumn("part", F.lit("train")), valid.withColumn("part", F.lit("valid")))


@query("fit_gbt_cls")
def fit_gbt_cls(spark, base):
    model, rows = breast_classifier(spark, base)
    return binary_metrics(models.predict_probability(model, rows).select("part", "probability", "target"), "probability", "target", ("part",))


@query("fit_gbt_cls_rounds")
def fit_gbt_cls_rounds(spark, base):
    """Log loss and error of both parts after each round."""
    model, rows = breast_classifier(spark, base)
    return boosted.round_curve(model, rows, "target", ("part",))


def breast_forest(spark, base) -> DataFrame:
    rows = views.breast_like(spark, base)
    return models.importances(models.fit_forest(rows, BREAST, "target"), BREAST, rows)


@query("fit_forest_importance")
def fit_forest_importance(spark, base):
    return breast_forest(spark, base)


@query("topk_importance")
def topk_importance(spark, base):
    return models.top_importances(breast_forest(spark, base))


@query("fit_survival")
def fit_survival(spark, base):
    rows = views.kidney_like(spark, base)
    return survival.fit_survival(rows).frame(rows)


# Run tables


def monthly_runs(spark, base) -> DataFrame:
    """A run log derived from the wine rows: one run per month and colour with its metrics."""
    scored = views.wine(spark, base).withColumn("p", 2.0 + F.col("alcohol"))
    run = F.concat_ws("-", "color", F.col("sulphates").cast("int").cast("string")).alias("run")
    wide = regression_metrics(scored.select(run, "p", "quality"), "p", "quality", ("run",))
    metrics = runs.metric_rows(rounded(wide, 6, "rmse", "mae", "r2"), "run", ("rmse", "mae", "r2"))
    params = runs.metric_rows(wide.select("run", F.substring_index("run", "-", -1).alias("month")), "run", ("month",), "param")
    return joins.union_all(params, metrics)


MONTHLY_SQL = """
WITH m AS (SELECT color || '-' || CAST(CAST(sulphates AS INT) AS STRING) AS run_id, sulphates AS month, 2 + alcohol AS p, quality FROM wine),
r AS (SELECT run_id, any_value(month) AS month, round(sqrt(avg((p - quality) * (p - quality))), 6) AS rmse, round(avg(abs(p - quality)), 6) AS mae,
  round(corr(p, quality) * corr(p, quality), 6) AS r2 FROM m GROUP BY run_id)
"""


@query("run_search", MONTHLY_SQL + "SELECT run_id, month, rmse, mae, r2 FROM r ORDER BY r2 DESC, run_id", ("wine",))
def run_search(spark, base):
    return runs.run_search(monthly_runs(spark, base), ("month", "rmse", "mae", "r2"), "r2")


@query("topk_runs", MONTHLY_SQL + "SELECT run_id, rmse, mae, r2 FROM r ORDER BY r2 DESC, run_id LIMIT 1", ("wine",))
def topk_runs(spark, base):
    return runs.top_run(monthly_runs(spark, base), ("rmse", "mae", "r2"), "r2")


@query("filter_metric", MONTHLY_SQL + "SELECT run_id, CAST(rmse AS STRING) AS value FROM r", ("wine",))
def filter_metric_rows(spark, base):
    return filter_metric(monthly_runs(spark, base), "key", "rmse").select("run_id", "value")


@query("model_uri", "SELECT DISTINCT 'runs:/' || color || '/wine-model' AS uri FROM wine", ("wine",))
def model_uri(spark, base):
    names = views.wine(spark, base).select("color").distinct()
    return names.select(runs.model_uri(F.concat(F.lit("runs:/"), "color"), F.lit("wine-model")).alias("uri"))


@query(
    "model_version",
    "SELECT color AS name, CAST(max(sulphates) AS BIGINT) + 1 AS version, 'next' AS run_id, 'runs:/' || color AS uri FROM wine GROUP BY color"
    " UNION ALL SELECT 'new', 1, 'next', 'runs:/new'",
    ("wine",),
)
def model_version(spark, base):
    wine = views.wine(spark, base)
    known = wine.select(F.col("color").alias("name"), F.col("sulphates").cast("bigint").alias("version"))
    names = joins.union_all(wine.select(F.col("color").alias("name")).distinct(), spark.createDataFrame([("new",)], "name string"))
    ready = names.select("name", F.lit("next").alias("run_id"), runs.model_uri(F.lit("runs:"), F.col("name")).alias("uri"))
    return runs.next_versions(known, ready)


@query(
    "run_log",
    MONTHLY_SQL
    + "SELECT run_id, 'metric' AS kind, 'rmse' AS key, CAST(rmse AS STRING) AS value FROM r UNION ALL SELECT run_id, 'metric', 'mae', CAST(mae AS STRING) FROM r"
    " UNION ALL SELECT run_id, 'metric', 'r2', CAST(r2 AS STRING) FROM r UNION ALL SELECT run_id, 'param', 'month', CAST(CAST(month AS INT) AS STRING) FROM r",
    ("wine",),
)
def run_log(spark, base):
    """Metric rows of all runs appended to a log table, then read back."""
    path = work_path(spark, "runs")
    runs.append_rows(monthly_runs(spark, base), path)
    return run_table(spark, path).select("run_id", "kind", "key", "value")


# Grids


@query(
    "cross_grid",
    "SELECT quality, lam, centre, round(n * m / (n + lam) + lam * centre / (n + lam), 6) AS shrunk"
    " FROM (SELECT quality, count(*) AS n, avg(alcohol) AS m FROM wine GROUP BY quality),"
    " (SELECT unnest([100, 150, 200, 250, 300]) AS lam), (SELECT unnest([0, 1]) AS centre)",
    ("wine",),
)
def cross_grid(spark, base):
    groups = views.wine(spark, base).groupBy("quality").agg(F.count(F.lit(1)).alias("n"), F.avg("alcohol").alias("m"))
    cells = grids.with_grid(groups, lam=list(range(100, 301, 50)), centre=[0, 1])
    shrunk = (F.col("n") * F.col("m") + F.col("lam") * F.col("centre")) / (F.col("n") + F.col("lam"))
    return cells.select("quality", "lam", "centre", F.round(shrunk, 6).alias("shrunk"))


@query(
    "grid_objective",
    "SELECT a, b, round(avg(quality) - a * avg(alcohol) - b, 6) AS bias, round(avg((quality - b - a * alcohol) * (quality - b - a * alcohol)), 6) AS score"
    " FROM wine, (SELECT unnest([0.001, 0.01, 0.1, 1.0])::DOUBLE AS a), (SELECT unnest([1, 2, 3]) AS b) GROUP BY a, b ORDER BY score, a LIMIT 1",
    ("wine",),
)
def grid_objective(spark, base):
    q, x = F.col("quality"), F.col("alcohol")
    sums = views.wine(spark, base).agg(
        F.avg(q).alias("q"), F.avg(x).alias("x"), F.var_pop(q).alias("qq"), F.var_pop(x).alias("xx"), F.covar_pop(q, x).alias("qx")
    )
    grid = grids.with_grid(sums, a=[0.001, 0.01, 0.1, 1.0], b=[1, 2, 3])
    a, bias = F.col("a"), F.col("q") - F.col("a") * F.col("x") - F.col("b")
    score = F.col("qq") - 2.0 * a * F.col("qx") + a * a * F.col("xx") + bias * bias
    best = grids.best_of_grid(grid.withColumn("bias", bias), score, "a")
    return rounded(best.select("a", "b", "bias", "score"), 6, "bias", "score")


# Group fits, tasks and batches


@query(
    "fit_per_group",
    "SELECT sulphates, count(*) AS n, round(regr_intercept(quality, alcohol), 6) AS intercept, round(regr_slope(quality, alcohol), 6) AS alcohol"
    " FROM wine GROUP BY sulphates",
    ("wine",),
)
def fit_per_group(spark, base):
    out = group_fits.fit_per_group(views.wine(spark, base), "sulphates", ("alcohol",), "quality")
    return rounded(out, 6, "intercept", "alcohol")


def _count_labels(pdf):
    return pdf.groupby("quality", as_index=False).agg(n=("wine_id", "size"), top=("alcohol", "max"))


@query("rowwise_side_effect", MONTHLY_SQL + "SELECT run_id || ' rmse ' || CAST(rmse AS STRING) AS line FROM r", ("wine",))
def rowwise_side_effect(spark, base):
    """One text line per metric row."""
    return filter_metric(monthly_runs(spark, base), "key", "rmse").select(F.concat_ws(" ", "run_id", "key", "value").alias("line"))


@query("udf_task_map", "SELECT quality, count(*) AS n, max(alcohol) AS top FROM wine GROUP BY quality", ("wine",))
def udf_task_map(spark, base):
    rows = views.wine(spark, base).select("wine_id", "quality", "alcohol")
    parts = group_fits.task_map(rows, _count_labels, "quality int, n bigint, top double")
    return parts.groupBy("quality").agg(F.sum("n").alias("n"), F.max("top").alias("top"))


def _longest_rise(state: tuple, rows) -> tuple:
    """Number of rows, the longest stretch of rising values, and where the present one stands."""
    n, best, length, last = state
    for value in rows.column(2).to_pylist():
        length = length + 1 if last is not None and value > last else 1
        n, best, last = n + 1, max(best, length), value
    return n, best, length, last


@query(
    "udf_group_stream",
    """
WITH s AS (SELECT quality, wine_id, CASE WHEN alcohol > lag(alcohol) OVER w THEN 0 ELSE 1 END AS begins FROM wine WINDOW w AS (PARTITION BY quality ORDER BY wine_id)),
g AS (SELECT quality, sum(begins) OVER (PARTITION BY quality ORDER BY wine_id) AS stretch FROM s)
SELECT quality, CAST(sum(c) AS BIGINT) AS n, max(c) AS longest FROM (SELECT quality, stretch, count(*) AS c FROM g GROUP BY 1, 2) GROUP BY quality
""",
    ("wine",),
)
def udf_group_stream(spark, base):
    """The longest stretch of rising values per group: state is carried over the batches of a group."""
    rows = views.wine(spark, base).select("quality", "wine_id", "alcohol")
    return group_fits.group_stream(
        rows, "quality", lambda _: (0, 0, 0, None), _longest_rise, lambda key, s: {"quality": key, "n": s[0], "longest": s[1]}, "quality int, n bigint, longest bigint",
        batch=500, order=("wine_id",),
    )


@query(
    "udf_crate",
    "SELECT wine_id, round(i + s * alcohol, 6) AS prediction FROM wine,"
    " (SELECT regr_intercept(quality, alcohol) AS i, regr_slope(quality, alcohol) AS s FROM wine)",
    ("wine",),
)
def udf_crate(spark, base):
    wine = views.wine(spark, base)
    fit = wine.agg(F.regr_intercept("quality", "alcohol").alias("i"), F.regr_slope("quality", "alcohol").alias("s")).first()
    score = group_fits.linear_scorer(fit["i"], (fit["s"],))
    return wine.select("wine_id", F.round(score("alcohol"), 6).alias("prediction"))


@query(
    "udf_objective",
    "SELECT sulphates, a, round(avg((quality - a * alcohol) * (quality - a * alcohol)), 6) AS score FROM wine,"
    " (SELECT unnest([0.001, 0.01, 0.1, 1.0])::DOUBLE AS a) GROUP BY sulphates, a",
    ("wine",),
)
def udf_objective(spark, base):
    """The objective of every grid value per month, as a column expression over the month's moments."""
    q, x = F.col("quality"), F.col("alcohol")
    sums = views.wine(spark, base).groupBy("sulphates").agg(
        F.avg(q * q).alias("qq"), F.avg(q * x).alias("qx"), F.avg(x * x).alias("xx")
    )
    a = F.col("a")
    score = F.col("qq") - 2.0 * a * F.col("qx") + a * a * F.col("xx")
    return grids.with_grid(sums, a=[0.001, 0.01, 0.1, 1.0]).select("sulphates", "a", F.round(score, 6).alias("score"))


RATIO_SQL = """
SELECT count(*) AS batches, CAST(sum(hits) AS BIGINT) AS hits, CAST(sum(n) AS BIGINT) AS n, round({scale} * sum(hits) / sum(n), 9) AS estimate,
  round({scale} * sqrt((sum(hits) / sum(n)) * (1 - sum(hits) / sum(n)) / sum(n)), 9) AS se
"""


@query(
    "agg_batch_ratio",
    RATIO_SQL.format(scale=100)
    + " FROM (SELECT member_id % 8 AS batch, sum(CASE WHEN loan_status IN ('Current','Fully Paid','Charged Off') THEN 0 ELSE 1 END) AS hits, count(*) AS n"
    " FROM loans GROUP BY 1)",
    ("loans",),
)
def agg_batch_ratio(spark, base):
    at_risk = C.not_in_keep_null("loan_status", lookups.SETTLED_STATUSES)
    batches = group_fits.batch_hits(views.loans(spark, base), F.col("member_id") % 8, at_risk)
    return rounded(group_fits.batch_ratio(batches, 100.0), 9, "estimate", "se")


# Posterior checks


@query(
    "agg_draws_summary",
    "SELECT param, count(*) AS n, round(avg(value), 4) AS mean, round(stddev_samp(value), 4) AS sd, round(stddev_samp(value) / sqrt(count(*)), 4) AS se, "
    + ", ".join(f"round(quantile_cont(value, {p}), 4) AS {n}" for n, p in draws.SUMMARY_QUANTILES.items())
    + " FROM draws GROUP BY param",
    ("draws",),
)
def agg_draws_summary(spark, base):
    out = draws.draws_summary(views.draws(spark, base))
    return rounded(out, 4, "mean", "sd", "se", *draws.SUMMARY_QUANTILES)


@query(
    "agg_rhat",
    """
WITH r AS (SELECT param, chain, value, row_number() OVER (PARTITION BY param, chain ORDER BY iter) - 1 AS i, count(*) OVER (PARTITION BY param, chain) // 2 AS h FROM draws),
halves AS (SELECT param, chain, i // h AS half, count(*) AS n, avg(value) AS m, var_samp(value) AS v FROM r WHERE i < 2 * h GROUP BY 1, 2, 3)
SELECT param, round(sqrt(((avg(n) - 1) / avg(n) * avg(v) + var_samp(m)) / avg(v)), 6) AS rhat FROM halves GROUP BY param
""",
    ("draws",),
)
def agg_rhat(spark, base):
    return rounded(draws.split_rhat(views.draws(spark, base)), 6, "rhat")


RANK_PARTS = ", ".join(f"{name} AS (SELECT param, sqrt(((avg(n) - 1) / avg(n) * avg(v) + var_samp(m)) / avg(v)) AS {name} FROM"
    f" (SELECT param, chain, half, count(*) AS n, avg(z) AS m, var_samp(z) AS v FROM (SELECT *, {inverse_normal_sql('p')} AS z FROM"
    f" (SELECT *, (rank() OVER (PARTITION BY param ORDER BY {value}) + (count(*) OVER (PARTITION BY param, {value}) - 1) / 2 - 0.375) / (count(*) OVER (PARTITION BY param) + 0.25) AS p FROM split)) GROUP BY 1, 2, 3) GROUP BY param)"
    for name, value in (("rhat_bulk", "value"), ("rhat_tail", "distance")))


@query(
    "agg_rank_rhat",
    f"""
WITH r AS (SELECT param, chain, value, row_number() OVER (PARTITION BY param, chain ORDER BY iter) - 1 AS i, count(*) OVER (PARTITION BY param, chain) // 2 AS h FROM draws),
split AS (SELECT *, abs(value - median(value) OVER (PARTITION BY param)) AS distance FROM (SELECT param, chain, i // h AS half, value FROM r WHERE i < 2 * h)),
{RANK_PARTS}
SELECT param, round(rhat_bulk, 6) AS rhat_bulk, round(rhat_tail, 6) AS rhat_tail, round(greatest(rhat_bulk, rhat_tail), 6) AS rhat FROM rhat_bulk JOIN rhat_tail USING (param)
""",
    ("draws",),
)
def agg_rank_rhat(spark, base):
    return rounded(draws.rank_rhat(views.draws(spark, base)), 6, "rhat_bulk", "rhat_tail", "rhat")


@query(
    "agg_ess",
    """
WITH d AS (SELECT param, chain, iter, value - avg(value) OVER (PARTITION BY param, chain) AS x, count(*) OVER (PARTITION BY param, chain) AS n FROM draws),
lags AS (SELECT a.param, a.chain, a.n, t.lag, sum(a.x * b.x) / a.n AS acov FROM d a, (SELECT unnest(range((SELECT max(n) FROM d))) AS lag) t, d b
  WHERE b.param = a.param AND b.chain = a.chain AND b.iter = a.iter + t.lag GROUP BY 1, 2, 3, 4),
cm AS (SELECT param, var_samp(m) AS b FROM (SELECT param, chain, avg(value) AS m FROM draws GROUP BY 1, 2) GROUP BY 1),
pl AS (SELECT param, lag, avg(acov) AS acov, avg(n) AS n, sum(n) AS total, avg(acov * n / (n - 1)) AS w FROM lags GROUP BY 1, 2),
z AS (SELECT pl.param, w, total, (n - 1) / n * w + b AS v FROM pl JOIN cm ON cm.param = pl.param WHERE lag = 0),
rho AS (SELECT pl.param, pl.lag, z.total, CASE WHEN lag = 0 THEN 1 ELSE 1 - (z.w - acov) / v END AS rho FROM pl JOIN z ON z.param = pl.param),
pr AS (SELECT param, any_value(total) AS total, lag // 2 AS pair, sum(rho) AS r FROM rho GROUP BY param, lag // 2 HAVING count(*) = 2),
cut AS (SELECT *, min(CASE WHEN r < 0 THEN pair END) OVER (PARTITION BY param) AS stop FROM pr)
SELECT param, round(any_value(total) / (2 * sum(r) - 1), 4) AS ess FROM cut WHERE stop IS NULL OR pair < stop GROUP BY param
""",
    ("draws",),
)
def agg_ess(spark, base):
    return rounded(draws.effective_size(views.draws(spark, base)), 4, "ess")


@query(
    "agg_waic",
    """
WITH mx AS (SELECT *, max(ll) OVER (PARTITION BY obs) AS top FROM loglik),
pt AS (SELECT obs, ln(avg(exp(ll - top))) + any_value(top) AS lpd, var_samp(ll) AS p FROM mx GROUP BY obs)
SELECT round(sum(lpd), 4) AS lppd, round(sum(p), 4) AS p_waic, round(-2 * (sum(lpd) - sum(p)), 4) AS waic FROM pt
""",
    ("loglik",),
)
def agg_waic(spark, base):
    return rounded(draws.waic(views.loglik(spark, base)), 4, "lppd", "p_waic", "waic")


TAU_MAX, TAU_POINTS = 40.0, 200
POOL_SQL = f"""
WITH grid AS (SELECT (unnest(range(1, {TAU_POINTS} + 1)) - 0.5) * {TAU_MAX}::DOUBLE / {TAU_POINTS} AS tau),
t AS (SELECT tau, sum(1 / (sigma * sigma + tau * tau)) AS sw, sum(y / (sigma * sigma + tau * tau)) / sum(1 / (sigma * sigma + tau * tau)) AS m
  FROM customer_effects, grid GROUP BY tau),
l AS (SELECT t.tau, any_value(t.m) AS m, any_value(1 / t.sw) AS v,
  0.5 * any_value(ln(1 / t.sw)) + sum(-0.5 * ln(sigma * sigma + t.tau * t.tau) - 0.5 * (y - t.m) * (y - t.m) / (sigma * sigma + t.tau * t.tau)) AS lp
  FROM customer_effects, t GROUP BY t.tau),
p AS (SELECT tau, m, v, exp(lp - max(lp) OVER ()) / sum(exp(lp - (SELECT max(lp) FROM l))) OVER () AS p FROM l)
"""


@query(
    "agg_pool_groups",
    POOL_SQL
    + """
, th AS (SELECT id, y, sigma, p, (y / (sigma * sigma) + m / (tau * tau)) / (1 / (sigma * sigma) + 1 / (tau * tau)) AS e,
   1 / (1 / (sigma * sigma) + 1 / (tau * tau)) + v * pow((1 / (tau * tau)) / (1 / (sigma * sigma) + 1 / (tau * tau)), 2) AS w FROM customer_effects, p)
SELECT id, round(sum(p * e), 4) AS theta_mean, round(sqrt(sum(p * w) + sum(p * e * e) - sum(p * e) * sum(p * e)), 4) AS theta_sd FROM th GROUP BY id
""",
    ("customer_effects",),
)
def agg_pool_groups(spark, base):
    groups = written(views.customer_effects(spark, base), "effects")  # read by every step
    out = pooling.pooled_effects(groups, pooling.tau_posterior(groups, TAU_MAX, TAU_POINTS))
    return rounded(out.select("id", "theta_mean", "theta_sd"), 4, "theta_mean", "theta_sd")


@query(
    "agg_pool_hyper",
    POOL_SQL
    + "SELECT round(sum(p * m), 4) AS mu_mean, round(sqrt(sum(p * (v + m * m)) - pow(sum(p * m), 2)), 4) AS mu_sd,"
    " round(sum(p * tau), 4) AS tau_mean, round(sqrt(sum(p * tau * tau) - pow(sum(p * tau), 2)), 4) AS tau_sd FROM p",
    ("customer_effects",),
)
def agg_pool_hyper(spark, base):
    posterior = pooling.tau_posterior(written(views.customer_effects(spark, base), "effects"), TAU_MAX, TAU_POINTS)
    return rounded(pooling.pooled_hyper(posterior), 4, "mu_mean", "mu_sd", "tau_mean", "tau_sd")


# Sources and sinks

WINE_CSV = "wine_id bigint, `fixed.alcohol` double, color string, quality int"
WINE_SQL = "SELECT wine_id, alcohol AS fixed_alcohol, color, quality FROM wine"


def wine_file(spark, base, sep: str) -> str:
    rows = views.wine(spark, base).select("wine_id", F.col("alcohol").alias("fixed.alcohol"), "color", "quality")
    return files.write_csv(rows, work_path(spark, "csv"), sep)


@query("src_csv", WINE_SQL, ("wine",))
def src_csv(spark, base):
    return files.read_csv(spark, wine_file(spark, base, ";"), ";", WINE_CSV)


@query("src_csv_object", WINE_SQL, ("wine",))
def src_csv_object(spark, base):
    return files.read_csv(spark, wine_file(spark, base, ","), ",", WINE_CSV)


@query("src_csv_bad_records", "SELECT wine_id % 3 = 0 AS bad, count(*) AS n FROM wine GROUP BY 1", ("wine",))
def src_csv_bad_records(spark, base):
    """Good rows and bad records of a file in which every third record has no number where one should be, and a note with line breaks."""
    rows = views.wine(spark, base).select("wine_id", F.when(F.col("wine_id") % 3 == 0, "n/a").otherwise(F.col("alcohol").cast("string")).alias("alcohol"), F.concat("color", F.lit("\n\"x\";"), "quality").alias("note"))
    path = work_path(spark, "csv")
    rows.write.option("header", True).option("sep", ";").option("escape", '"').csv(path)
    good, bad = files.read_csv_split(spark, path, work_path(spark, "records"), ";", "wine_id bigint, alcohol double, note string")
    both = joins.union_all(good.select(F.lit(False).alias("bad")), bad.select(F.lit(True).alias("bad")))
    return both.groupBy("bad").agg(F.count(F.lit(1)).alias("n"))


@contextmanager
def linked_orders(spark, base) -> Iterator[str]:
    """The name of a catalog table over the orders; it is dropped afterwards, the files stay."""
    name = f"orders_{uuid.uuid4().hex}"
    tables.clone_parquet(spark, f"{base}/orders.parquet", name)
    try:
        yield name
    finally:
        spark.sql(f"DROP TABLE `{name}`")


@query("src_parquet_clone", "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1")
def src_parquet_clone(spark, base):
    with linked_orders(spark, base) as name:
        counts = spark.table(name).groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
        return spark.read.parquet(files.write_results(counts, work_path(spark, "counts")))


@query("src_table", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def src_table(spark, base):
    with linked_orders(spark, base) as name:
        rows = tables.read_table(spark, "spark_catalog", spark.catalog.currentDatabase(), name)
        counts = rows.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
        return spark.read.parquet(files.write_results(counts, work_path(spark, "counts")))


@query("sink_results", "SELECT color, quality, count(*) AS n FROM wine GROUP BY ALL", ("wine",))
def sink_results(spark, base):
    counts = views.wine(spark, base).groupBy("color", "quality").agg(F.count(F.lit(1)).alias("n"))
    return spark.read.parquet(files.write_results(counts, work_path(spark, "results")))
