"""Parameter grids and objectives evaluated over them."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.operators.metrics import best_row


def with_grid(df: DataFrame, **choices: list) -> DataFrame:
    """Every row with every combination of the listed choices; for short frames such as group totals."""
    for name, values in choices.items():
        df = df.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
    return df


def parameter_grid(spark: SparkSession, **choices: list) -> DataFrame:
    """All combinations of the listed choices, one row each."""
    return with_grid(spark.range(1), **choices).drop("id")


def best_of_grid(grid: DataFrame, objective: Column, tie_break: str, mode: str = "min") -> DataFrame:
    """The grid row with the best value of the objective, which is added as ``score``."""
    return best_row(grid.withColumn("score", objective), "score", tie_break, mode)


def run_all(spark: SparkSession, jobs: dict[Any, Callable[[], Any]], workers: int = 4) -> dict[Any, Any]:
    """The results of independent jobs by name, several of them at a time.

    Each job runs in a thread of its own that inherits the settings of the caller, and in a scheduler pool of its own, so under
    fair scheduling none waits for the tasks of another. Jobs that fail are tried once more after the others have ended,
    one by one; an error then is raised.
    """

    def run(name: Any, job: Callable[[], Any]) -> Any:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"grid-{name}")
        return job()

    with ThreadPoolExecutor(max(1, workers)) as pool:
        begun = {name: pool.submit(inheritable_thread_target(spark)(run), name, job) for name, job in jobs.items()}
    return {name: jobs[name]() if f.exception() else f.result() for name, f in begun.items()}
