"""Exact order statistics without gathering a group in one task.

The built-in exact percentile keeps every distinct value of a group in one buffer, and a window over a
group sorts it in one task. Here a quantile sketch brackets each wanted rank, exact counts say how many
rows lie before each part of a bracket, and only the part that holds the rank is sorted.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyforge.operators.joins import attach, checked_broadcast

#: A wanted rank: roughly which fraction of the rows precedes it, and the exact 0-based rank given the row count.
Rank = tuple[float, Callable[[Column], Column]]

#: Sketch accuracy; its rank error is at most ``n / ACCURACY``, so a bracket holds about ``4 * n / ACCURACY`` rows.
#: A sharper sketch makes smaller brackets, but every task sends one sketch to be merged.
ACCURACY = 2_000

#: Equal steps a bracket is cut into, so that its rows are sorted by many tasks.
STEPS = 256

_LARGEST = 1e308


def _same(left: str, right: str, keys: list[str]) -> list[Column]:
    return [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys]


def _segment(value: Column, edges: list[Column]) -> Column:
    """A bucket number that never decreases with the value.

    It rises by one at and after every edge, so an edge value has a bucket of its own: a value that
    holds a large share of the rows becomes an edge, and its bucket is a single value. Between two
    edges it rises in equal steps.
    """
    x = value.cast("double")
    number = F.lit(0)
    for e in edges:
        number = number + (value > e).cast("int") + (value >= e).cast("int")
    for low, high in zip(edges, edges[1:]):
        lo, width = low.cast("double"), high.cast("double") - low.cast("double")
        part = F.least(F.greatest((x - lo) / width, F.lit(0.0)), F.lit(1.0))
        step = F.floor(part * F.lit(float(STEPS))).cast("int")
        number = number + F.when((width > 0) & (width < _LARGEST), step).otherwise(0)
    return number


def _in_segments(df: DataFrame, value: str, fractions: list[float], by: tuple[str, ...], accuracy: int) -> DataFrame:
    """Add ``_b``, the bucket of each row between the bracket edges of its group.

    The edges only balance the work; any edges give the same result.
    """
    margin = 2.0 / accuracy
    wanted = sorted({min(1.0, max(0.0, p + side)) for p in fractions for side in (-margin, margin)})
    edges = df.groupBy(*by).agg(F.percentile_approx(value, wanted, accuracy).alias("_e"))
    if not by:
        found = edges.first()["_e"] or []
        return df.withColumn("_b", _segment(F.col(value), [F.lit(e) for e in sorted(set(found))]))
    return attach(df, edges, by).withColumn("_b", _segment(F.col(value), [F.col("_e")[i] for i in range(len(wanted))])).drop("_e")


def segment_spans(df: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """Per group and bucket: ``_start`` (rows before it), ``_c`` (rows in it) and ``_n`` (rows of the group).

    The windows run over bucket totals, at most a few thousand rows per group.
    """
    whole = Window.partitionBy(*by)
    return (
        df.groupBy(*by, "_b")
        .agg(F.count(F.lit(1)).alias("_c"))
        .withColumn("_start", F.sum("_c").over(whole.orderBy("_b")) - F.col("_c"))
        .withColumn("_n", F.sum("_c").over(whole))
    )


def values_at_ranks(
    df: DataFrame, value: str, ranks: dict[str, Rank], by: tuple[str, ...] = (), accuracy: int = ACCURACY
) -> DataFrame:
    """The value at given 0-based ranks of every group: rows ``(*by, tag, n, value)``.

    NULL and NaN are left out. One pass finds the brackets, one counts, and one reads the bracketed
    rows, whose equal values are merged before the shuffle.
    """
    x = F.col(value)
    kept = df.where(x.isNotNull() & ~F.isnan(x.cast("double"))).select(*by, value)
    cut = _in_segments(kept, value, [p for p, _ in ranks.values()], by, accuracy)
    wanted = F.array(
        *[
            F.struct(F.lit(tag).alias("tag"), at(F.col("_n")).cast("bigint").alias("rank"))
            for tag, (_, at) in ranks.items()
        ]
    )
    at = F.col("t.rank") - F.col("_start")
    targets = (
        segment_spans(cut, by)
        .select(*by, "_b", "_n", "_start", "_c", F.explode(wanted).alias("t"))
        .where((at >= 0) & (at < F.col("_c")))
        .select(*by, "_b", "_n", "t.tag", at.alias("_at"))
    )
    side = checked_broadcast(targets)
    few, targets, keys = side is not targets, side.alias("t"), [*by, "_b"]

    def inside(rows: DataFrame) -> DataFrame:
        return rows.alias("d").join(targets, _same("d", "t", keys), "left_semi")

    def merged(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_m"))

    # With very many groups the targets are shuffled too; equal values are then merged before they meet.
    counts = merged(inside(cut)) if few else inside(merged(cut))
    upto = F.sum("_m").over(Window.partitionBy(*keys).orderBy(value))
    running = counts.withColumn("_upto", upto).alias("d")
    hit = (F.col("t._at") >= F.col("d._upto") - F.col("d._m")) & (F.col("t._at") < F.col("d._upto"))
    return running.join(targets, [*_same("d", "t", keys), hit]).select(
        *[F.col(f"d.{k}") for k in by], F.col("t.tag"), F.col("t._n").alias("n"), F.col(f"d.{value}").alias("value")
    )


def average_ranks(
    df: DataFrame, value: str, by: tuple[str, ...], also: tuple[str, ...] = (), parts: int = 8, accuracy: int = ACCURACY
) -> DataFrame:
    """Average 1-based ranks within the groups ``by``: rows ``(*by, *also, value, m, rank, n)``, ``m`` equal rows each.

    Rows are merged by value (and ``also``) before the shuffle. A group is cut at about ``parts`` of its quantiles, each part again
    into equal steps; counts per step tell where it begins, so a group that holds most rows is sorted by many tasks and a
    value that holds most rows is one row. NULL and NaN are left out.
    """
    x = F.col(value)
    kept = df.where(x.isNotNull() & ~F.isnan(x.cast("double"))).select(*by, *also, value)
    cut = _in_segments(kept, value, [i / parts for i in range(1, parts)], by, accuracy)
    cells = cut.groupBy(*by, *also, "_b", value).agg(F.count(F.lit(1)).alias("m"))
    upto = F.sum("m").over(Window.partitionBy(*by, "_b").orderBy(value).rangeBetween(Window.unboundedPreceding, Window.currentRow))
    same = F.sum("m").over(Window.partitionBy(*by, "_b", value))
    ranked = cells.withColumn("_rank", upto - same + (same + 1) / 2.0)
    spans = segment_spans(cut, by).select(*by, "_b", "_start", F.col("_n").alias("n"))
    placed = attach(ranked, spans, (*by, "_b"))
    return placed.select(*by, *also, value, "m", (F.col("_start") + F.col("_rank")).alias("rank"), "n")


def exact_quantiles(
    df: DataFrame, value: str, probabilities: dict[str, float], by: tuple[str, ...] = (), accuracy: int = ACCURACY
) -> DataFrame:
    """Exact interpolated quantiles per group, one column per entry of ``probabilities``."""
    ranks: dict[str, Rank] = {}
    for name, p in probabilities.items():
        ranks[f"{name}|lo"] = (p, lambda n, p=p: F.floor(F.lit(float(p)) * (n - 1)))
        ranks[f"{name}|hi"] = (p, lambda n, p=p: F.ceil(F.lit(float(p)) * (n - 1)))
    columns = []
    for name, p in probabilities.items():
        lo, hi = (
            F.max(F.when(F.col("tag") == f"{name}|{side}", F.col("value").cast("double"))) for side in ("lo", "hi")
        )
        at = F.lit(float(p)) * (F.max("n") - 1)
        columns.append((lo + (hi - lo) * (at - F.floor(at))).alias(name))
    return values_at_ranks(df, value, ranks, by, accuracy).groupBy(*by).agg(*columns)


def exact_median(df: DataFrame, value: str, name: str = "median", by: tuple[str, ...] = ()) -> DataFrame:
    return exact_quantiles(df, value, {name: 0.5}, by)
