"""Feature preparation, fitted on training rows and stored as ordinary pipeline stages.

Fitting reads one row of statistics. The fitted step is a SQL statement with those numbers, so it runs
inside code generation, can be saved with the model, and never looks at the training rows again.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.feature import Bucketizer, SQLTransformer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.columns import NUMBER, parse_rate
from tallyforge.sources.naming import safe_name

RECIPE_COLUMNS = ("bc_open_to_buy", "bc_util", "all_util")

#: Most levels that are turned into indicator columns.
MAX_LEVELS = 1000

#: Bins of a predictor of boosted trees: what Spark's trees have by default.
BINS = 32
#: A predictor's edges are taken from all rows when it has at most this many values, else from a sample of about as many
#: rows as Spark's trees look at.
EDGE_VALUES, EDGE_ROWS = 65_536, 10_000


def _number(value: float | None) -> str:
    return "CAST(NULL AS DOUBLE)" if value is None else f"{float(value)!r}D"


def _known(column: str) -> Column:
    """A column for fitted statistics: NaN counts as missing."""
    value = F.col(f"`{column}`").cast("double")
    return F.when(~F.isnan(value), value)


def _stage(columns: dict[str, str], dropped: tuple[str, ...] = ()) -> SQLTransformer:
    """A stage that adds ``columns`` (name to SQL over the input) after removing ``dropped``.

    A column that is both dropped and added is replaced.
    """
    rest = f"* EXCEPT ({', '.join(f'`{c}`' for c in dropped)})" if dropped else "*"
    return SQLTransformer(statement=f"SELECT {', '.join([rest, *[f'{q} AS `{c}`' for c, q in columns.items()]])} FROM __THIS__")


def replace_columns(columns: dict[str, str]) -> SQLTransformer:
    return _stage(columns, tuple(columns))


def add_columns(columns: dict[str, str]) -> SQLTransformer:
    return _stage(columns)


def fit_scaler(train: DataFrame, columns: tuple[str, ...], ddof: int = 0, suffix: str = "") -> SQLTransformer:
    """Centre and scale columns by training mean and sd (``ddof`` 0 population, 1 sample).

    A column without spread is only centred. With a suffix new columns are added, else they are replaced.
    """
    sd = F.stddev_samp if ddof else F.stddev_pop
    stats = train.agg(
        *[F.avg(_known(c)).alias(f"m{i}") for i, c in enumerate(columns)], *[sd(_known(c)).alias(f"s{i}") for i, c in enumerate(columns)]
    ).first()
    sql = {
        f"{c}{suffix}": f"(CAST(`{c}` AS DOUBLE) - {_number(stats[f'm{i}'])}) / {_number(stats[f's{i}'] or 1.0)}"
        for i, c in enumerate(columns)
    }
    return add_columns(sql) if suffix else replace_columns(sql)


def levels(train: DataFrame, column: str) -> list[str]:
    """Distinct non-null levels in alphabetical order; too many to become columns is an error."""
    found = train.select(column).where(F.col(column).isNotNull()).distinct().limit(MAX_LEVELS + 1).collect()
    if len(found) > MAX_LEVELS:
        raise ValueError(f"column {column} has more than {MAX_LEVELS} levels")
    return sorted(row[0] for row in found)


def fit_dummy(train: DataFrame, column: str) -> SQLTransformer:
    """Indicators for all levels but the first; a NULL stays NULL, an unseen level is all zeros.

    Levels whose safe names are equal get a number at the end, in alphabetical order of the levels.
    """
    sql: dict[str, str] = {}
    for level in levels(train, column)[1:]:
        name, again = f"{column}_{safe_name(level)}", 2
        while name in sql:
            name, again = f"{column}_{safe_name(level)}_{again}", again + 1
        text = level.replace("\\", "\\\\").replace("'", "\\'")
        sql[name] = (
            f"CASE WHEN `{column}` IS NULL THEN NULL WHEN `{column}` = '{text}' THEN 1.0D ELSE 0.0D END"
        )
    return _stage(sql, (column,))


def fit_impute_mean(train: DataFrame, columns: tuple[str, ...]) -> SQLTransformer:
    """Fill NULL and NaN by the training mean."""
    means = train.agg(*[F.avg(_known(c)).alias(f"m{i}") for i, c in enumerate(columns)]).first()
    sql = {c: f"coalesce(nanvl(CAST(`{c}` AS DOUBLE), NULL), {_number(means[f'm{i}'])})" for i, c in enumerate(columns)}
    return replace_columns(sql)


def fit_filled(train: DataFrame, columns: tuple[str, ...], scaled: tuple[str, ...] = (), suffix: str = "_x") -> SQLTransformer:
    """Copies ``<column><suffix>`` as numbers without a gap: NULL and NaN become the training mean, ``scaled`` ones are centred
    by it and divided by the population sd.

    One step and not several on top of each other: each further projection of many columns multiplies what the optimizer
    derives from them.
    """
    stats = train.agg(
        *[F.avg(_known(c)).alias(f"m{i}") for i, c in enumerate(columns)], *[F.stddev_pop(_known(c)).alias(f"s{i}") for i, c in enumerate(columns) if c in scaled]
    ).first()
    sql = {}
    for i, c in enumerate(columns):
        mean, known = _number(stats[f"m{i}"]), f"nanvl(CAST(`{c}` AS DOUBLE), NULL)"
        sql[f"{c}{suffix}"] = f"coalesce(({known} - {mean}) / {_number(stats[f's{i}'] or 1.0)}, 0.0D)" if c in scaled else f"coalesce({known}, {mean})"
    return add_columns(sql)


def bin_edges(values: np.ndarray, counts: np.ndarray, most: int = BINS - 1) -> list[float]:
    """At most ``most`` thresholds half-way between distinct values in rising order, by the rule of Spark's trees: all of them, or
    those that come nearest to equal shares of the rows."""
    middle, upto = (values[:-1] + values[1:]) / 2.0, np.cumsum(counts)
    if len(middle) <= most:
        return middle.tolist()
    stride = target = upto[-1] / (most + 1)
    edges = []
    for value, before, after in zip(middle.tolist(), upto[:-1].tolist(), upto[1:].tolist(), strict=True):
        if abs(before - target) < abs(after - target):
            edges.append(value)
            target += stride
    return edges


def fit_bins(train: DataFrame, columns: list[str] | tuple[str, ...], seed: int = 42, suffix: str = "_bin") -> Bucketizer:
    """Number columns without a gap to the numbers of their bins, which are new columns.

    A value at an edge belongs to the lower bin. The edges are those Spark's trees would try, but of tables of more than
    :data:`EDGE_ROWS` rows the values are counted in all rows, not in a sample, unless they are too many. Binning
    covers every row.
    """
    splits = []
    for c in columns:
        count = lambda rows, c=c: rows.groupBy(F.col(f"`{c}`").alias("v")).agg(F.count(F.lit(1)).alias("n"))
        found = count(train).limit(EDGE_VALUES + 1).toArrow()
        if found.num_rows > EDGE_VALUES:
            found = count(train.sample(min(1.0, EDGE_ROWS / train.count()), seed)).toArrow()
        found = found.sort_by("v")
        inner = bin_edges(found["v"].to_numpy(), found["n"].to_numpy()) or [0.0]  # a constant has one bin
        splits.append([-math.inf, *dict.fromkeys(math.nextafter(e, math.inf) for e in inner), math.inf])
    return Bucketizer(splitsArray=splits, inputCols=list(columns), outputCols=[f"{c}{suffix}" for c in columns], handleInvalid="keep")


def rate_rows(loans: DataFrame) -> DataFrame:
    """Rows for the rate model: numeric rate (rows without one are dropped), term and utilisation columns."""
    return (
        loans.select("member_id", "int_rate", "term", "bc_util", "bc_open_to_buy", "all_util")
        .withColumn("int_rate", parse_rate("int_rate"))
        .where(F.col("int_rate").isNotNull())
    )


def fit_recipe(
    train: DataFrame, numeric: tuple[str, ...] = RECIPE_COLUMNS, dummy: str = "term"
) -> tuple[PipelineModel, list[str]]:
    """The preparation of the rate model and the names of its predictors.

    In this order: cast to numbers, centre and scale by the sample sd of the known values, indicators
    for the term, then fill NULLs by the training mean. The mean of a scaled column is 0, so that is the
    fill. A row without a term keeps NULL indicators.
    """
    number = NUMBER.replace("\\", "\\\\")
    cast = replace_columns({c: f"CASE WHEN CAST(`{c}` AS STRING) RLIKE '{number}' THEN try_cast(`{c}` AS DOUBLE) END" for c in numeric})
    numbers = cast.transform(train)
    scale = fit_scaler(numbers, numeric, ddof=1)
    scaled = scale.transform(numbers)
    dummies = fit_dummy(scaled, dummy)
    ready = dummies.transform(scaled)
    fill = replace_columns({c: f"coalesce(`{c}`, 0.0D)" for c in numeric})
    indicators = [c for c in ready.columns if c not in scaled.columns]
    return PipelineModel([cast, scale, dummies, fill]), [*numeric, *indicators]


def assembler(columns: list[str] | tuple[str, ...], invalid: str = "skip", name: str = "features") -> VectorAssembler:
    """Columns as one feature vector; rows with a NULL are skipped, kept or an error."""
    return VectorAssembler(inputCols=list(columns), outputCol=name, handleInvalid=invalid)
