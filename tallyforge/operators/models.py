"""Model fits with Spark ML: elastic net, boosted trees, forest; scoring and importances."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
from pyspark import SparkContext
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.common import _py2java
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, LinearRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from tallyforge.operators.features import (
    BINS,
    RECIPE_COLUMNS,
    add_columns,
    assembler,
    fit_bins,
    fit_filled,
    fit_recipe,
    replace_columns,
)
from tallyforge.operators.metrics import regression_metrics
from tallyforge.operators.moments import block_moments, elastic_net
from tallyforge.session import remove_path, work_path

#: Cells of a boosted fit that a task takes at least.
CELLS_EACH = 32_768


@contextmanager
def _training(df: DataFrame, each: int = 1) -> Iterator[DataFrame]:
    """Rows kept for the many passes of an iterative fit, spread over all cores when they lie in few files.

    A task takes at least about ``each`` rows: of short passes the tasks themselves are most of the time.

    They are written once to the shared folder, so that the passes plan a scan and not the whole preparation again, and
    a lost executor reads them there; the folder is removed after the fit.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:  # long fits cut their lineage there
        context.setCheckpointDir(work_path(spark, "fits"))
    path = work_path(spark, "training")
    df.write.parquet(path)
    written = spark.read.schema(df.schema).parquet(path)
    tasks, files = context.defaultParallelism, written.rdd.getNumPartitions()
    if each > 1:
        most = max(1, written.count() // each)
        tasks, written = min(tasks, most), written.coalesce(most)
    kept = (written.repartition(tasks) if files < tasks else written).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()
        remove_path(spark, path)


def fit_elastic_net(
    train: DataFrame, features: tuple[str, ...], label: str, alpha: float, lam: float, prediction: str = "prediction"
) -> PipelineModel:
    """Linear model with an elastic-net penalty, features not standardised.

    Rows with a missing value are left out of the fit; scored, they get a NULL prediction.
    ``alpha`` mixes L1 (1) and L2 (0), ``lam`` is the penalty weight, of L2 relative to the standard deviation of the label. The fit
    needs means and covariances only, two passes of block sums for any number of rows, and is solved by coordinate descent
    to the last digits; a few thousand features are its range. No complete row is an error.
    """
    n, mean, cov = block_moments(train, (*features, label))
    if n == 0:
        raise ValueError("no row without a missing value")
    p = len(features)
    sd = float(np.sqrt(cov[p, p])) or 1.0
    b = elastic_net(cov[:p, :p], cov[:p, p], lam * alpha, lam * (1.0 - alpha) / sd, np.zeros(p))
    context = SparkContext._active_spark_context
    java = context._jvm.org.apache.spark.ml.regression.LinearRegressionModel(f"elastic_net_{uuid.uuid4().hex[:12]}", _py2java(context, DenseVector(b)), float(mean[p] - b @ mean[:p]))
    model = LinearRegressionModel(java).setFeaturesCol("features").setPredictionCol(prediction)
    return PipelineModel([assembler(features, "keep"), model])


def fit_rate_model(
    train: DataFrame, trees: int = 100, seed: int = 42, label: str = "int_rate"
) -> tuple[PipelineModel, list[str]]:
    """Boosted regression trees on the prepared rate rows; preparation and trees are one model.

    The preparation works on copies, so scored rows keep their own columns. A missing term counts as
    none of the levels. Also returns the predictor names.

    Trees see a predictor only as one of its bins, so rows that share all bins always meet in a leaf, and their number and mean
    label say all a squared loss asks of them. Every row is counted into its cell once; the trees are fitted on the cells,
    whose number the bins bound, whatever the number of rows.
    """
    copy = add_columns({f"{c}_x": f"`{c}`" for c in (*RECIPE_COLUMNS, "term")})
    copied = copy.transform(train)
    recipe, names = fit_recipe(copied, tuple(f"{c}_x" for c in RECIPE_COLUMNS), "term_x")
    fill = replace_columns({c: f"coalesce(`{c}`, 0.0D)" for c in names})
    known = F.coalesce(F.col(label).cast("double"), F.lit(float("nan"))).alias(label)  # the fit refuses a missing label
    ready = fill.transform(recipe.transform(copied)).select(*names, known)
    with _training(ready) as rows:
        bins = fit_bins(rows, names, seed)
        binned = bins.getOutputCols()
        vector = assembler(binned, "keep")  # no gap is left
        ordered = [F.col(c).alias(c, metadata={}) for c in binned]  # bins are marked as categories, which trees split without order
        cells = bins.transform(rows).groupBy(*ordered).agg(F.avg(label).alias(label), F.count(F.lit(1)).cast("double").alias("_rows"))
        with _training(vector.transform(cells).select("features", label, "_rows"), CELLS_EACH) as kept:
            tried = max(BINS, math.isqrt(kept.count()) + 1)  # its square is the number of rows that Spark looks for bins in: all cells
            boosted = GBTRegressor(labelCol=label, weightCol="_rows", maxIter=trees, maxDepth=5, maxBins=tried, seed=seed).fit(kept)
    return PipelineModel([copy, *recipe.stages, fill, bins, vector, boosted]), names


def shorter(model: PipelineModel, trees: int) -> PipelineModel:
    """The model that a fit with fewer trees gives: boosting adds trees one by one, so it is the first ones of a longer fit."""
    long = model.stages[-1]
    context = SparkContext._active_spark_context
    java = context._jvm.org.apache.spark.ml
    some = context._gateway.new_array(java.regression.DecisionTreeRegressionModel, trees)
    weights = context._gateway.new_array(context._jvm.double, trees)
    for i, (tree, weight) in enumerate(zip(long._java_obj.trees()[:trees], long.treeWeights[:trees], strict=True)):
        some[i], weights[i] = tree, float(weight)
    short = GBTRegressionModel(java.regression.GBTRegressionModel(f"{long.uid}_{trees}", some, weights))
    return PipelineModel([*model.stages[:-1], short])


def fit_boosted_classifier(
    train: DataFrame, features: tuple[str, ...], scaled: tuple[str, ...], label: str = "target", rounds: int = 100,
    seed: int = 42,
) -> PipelineModel:
    """Scaler (population sd) and boosted classification trees as one model; a missing value counts as the training mean.

    The preparation works on copies, so scored rows keep their own columns.
    """
    fill, vector = fit_filled(train, features, scaled), assembler([f"{c}_x" for c in features], "keep")
    labelled = train.where(F.col(label).isNotNull()).select(*dict.fromkeys([*features, label]))
    ready = vector.transform(fill.transform(labelled)).select("features", F.col(label).cast("double").alias(label))
    with _training(ready) as rows:
        boosted = GBTClassifier(labelCol=label, maxIter=rounds, seed=seed).fit(rows)
    return PipelineModel([fill, vector, boosted])


def fit_forest(
    train: DataFrame, features: tuple[str, ...], label: str, trees: int = 500, seed: int = 42
) -> PipelineModel:
    """Random forest whose impurity importances are read by :func:`importances`; missing values count as training means."""
    fill, vector = fit_filled(train, features), assembler([f"{c}_x" for c in features], "keep")
    labelled = train.where(F.col(label).isNotNull()).select(*dict.fromkeys([*features, label]))
    ready = vector.transform(fill.transform(labelled))
    with _training(ready.select("features", F.col(label).cast("double").alias(label))) as rows:
        forest = RandomForestClassifier(labelCol=label, numTrees=trees, seed=seed).fit(rows)
    return PipelineModel([fill, vector, forest])


def importances(model: PipelineModel, features: list[str] | tuple[str, ...], df: DataFrame) -> DataFrame:
    """Feature importances, one row per feature with its position."""
    values = model.stages[-1].featureImportances.toArray()
    rows = [(i, name, float(v)) for i, (name, v) in enumerate(zip(features, values, strict=True))]
    return df.sparkSession.createDataFrame(rows, "position int, feature string, importance double")


def top_importances(frame: DataFrame, n: int = 10, mode: str = "top") -> DataFrame:
    """The ``n`` largest importances (``top``) or those of the first ``n`` columns (``first``)."""
    if mode == "first":
        return frame.orderBy("position").limit(n)
    return frame.orderBy(F.col("importance").desc(), "position").limit(n)


def predict(model: PipelineModel, df: DataFrame, name: str = "prediction") -> DataFrame:
    """The input rows with the prediction as one more column; NULL where the model needs a value that is missing."""
    known = F.when(~F.isnan("prediction"), F.col("prediction"))
    return model.transform(df).select(*[F.col(f"`{c}`") for c in df.columns], known.alias(name))


def predict_probability(model: PipelineModel, df: DataFrame, name: str = "probability") -> DataFrame:
    """The input rows with the probability of class 1."""
    out = model.transform(df)
    return out.select(*[F.col(f"`{c}`") for c in df.columns], vector_to_array("probability")[1].alias(name))


def save_model(model: PipelineModel, uri: str) -> str:
    model.write().overwrite().save(uri)
    return uri


def score_saved(uri: str, df: DataFrame, name: str) -> DataFrame:
    """Load a stored model and score rows with it."""
    return predict(PipelineModel.load(uri), df, name)


def evaluate(model: PipelineModel, test: DataFrame, label: str) -> dict[str, float]:
    """``rmse``, ``mae`` and ``r2`` of a model on other rows than it was fitted on."""
    return regression_metrics(predict(model, test), "prediction", label).first().asDict()
