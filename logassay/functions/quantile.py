"""Exact nearest-rank quantiles without sorting or collecting the column.

The k-th smallest value, k = floor((n - 1) * p + 0.5) counted from 0, is found
by narrowing: count rows per coarse bucket of a monotone key, keep the one
bucket that holds rank k, split its value range, and repeat. Every pass is a
narrow scan with a partial aggregate. The number of buckets is fixed by the
bucket function and not by the data, so the running counts over them are small
on any input, and a value that fills a third of the table is one bucket row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

QUARTILES_AND_TAIL = (0.25, 0.50, 0.75, 0.90, 0.99)
SPLITS = 4096


def label(p: float) -> str:
    return f"p{round(p * 100)}"


def nearest_rank(n: Column, p: Column) -> Column:
    """0-based rank of the quantile among n sorted values."""
    return F.floor((n - 1) * p + F.lit(0.5))


def _coarse(v: Column) -> Column:
    """Monotone integer key of a number: 64 steps per power of two, split by sign.

    Declared never null (``coalesce``), or the joins on it would push an
    is-not-null test of the whole expression into every scan.
    """
    magnitude = (F.floor(F.log2(F.abs(v)) * 64) + 100_000).cast("int")
    key = (
        F.when(F.isnan(v), 300_000)
        .when(v == float("inf"), 250_000)
        .when(v == float("-inf"), -250_000)
        .when(v > 0, magnitude)
        .when(v < 0, -magnitude)
    )
    return F.coalesce(key, F.lit(0))


def _with_running(counts: DataFrame, order: str, within: Sequence[str] = ()) -> DataFrame:
    ahead = Window.partitionBy(*within).orderBy(order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return counts.withColumn("_upto", F.sum("_n").over(ahead))


def _holding_rank() -> Column:
    return (F.col("_k") >= F.col("_upto") - F.col("_n")) & (F.col("_k") < F.col("_upto"))


def nearest_quantiles(
    df: DataFrame,
    column: str,
    probabilities: Sequence[float] = QUARTILES_AND_TAIL,
    refinements: int = 2,
) -> DataFrame:
    """Rows (p, value), one per probability; no rows when the column is all null.

    Each refinement is a further scan that cuts the candidate range by ``SPLITS``.
    A coarse bucket spans at most 2^46 distinct doubles, so two refinements leave
    at most 2^22 distinct values per probability for the last window, on any data;
    values spread over an octave or more need only one.
    """
    values = (
        df.select(F.col(column).alias("_v"))
        .where(F.col("_v").isNotNull())
        .withColumn("_b", _coarse(F.col("_v").cast("double")))
    )
    coarse = values.groupBy("_b").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")
    )
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    target = (
        _with_running(coarse.withColumn("_total", F.sum("_n").over(whole)), "_b")
        .withColumn("p", F.explode(F.array(*[F.lit(float(p)) for p in probabilities])))
        .withColumn("_k", nearest_rank(F.col("_total"), F.col("p")))
        .where(_holding_rank())
        .select("p", "_b", "_lo", "_hi", (F.col("_k") - F.col("_upto") + F.col("_n")).alias("_k"))
    )
    for _ in range(refinements):
        span = (F.col("_hi") - F.col("_lo")).cast("double")
        step = F.floor((F.col("_v") - F.col("_lo")).cast("double") / span * SPLITS).cast("int")
        pieces = (
            _inside(values, target)
            .withColumn("_s", F.when(F.col("_lo") == F.col("_hi"), 0).otherwise(step))
            .groupBy("p", "_b", "_k", "_s")
            .agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
        )
        target = (
            _with_running(pieces, "_s", ["p"])
            .where(_holding_rank())
            .select("p", "_b", "_lo", "_hi", (F.col("_k") - F.col("_upto") + F.col("_n")).alias("_k"))
        )
    candidates = _inside(values, target).groupBy("p", "_k", "_v").agg(F.count(F.lit(1)).alias("_n"))
    return (
        _with_running(candidates, "_v", ["p"])
        .where(_holding_rank())
        .select("p", F.col("_v").alias("value"))
    )


def _inside(values: DataFrame, target: DataFrame) -> DataFrame:
    # One row per probability, so the broadcast side never grows with the data.
    return values.join(F.broadcast(target), "_b").where(F.col("_v").between(F.col("_lo"), F.col("_hi")))


def histogram_quantiles(
    value: str, probabilities: Sequence[float] = QUARTILES_AND_TAIL
) -> list[Column]:
    """Aggregates over ``with_running_weight(...)`` giving nearest-rank quantiles."""
    return [
        F.min(
            F.when(F.col("_upto") > nearest_rank(F.col("_total"), F.lit(float(p))), F.col(value))
        ).alias(label(p))
        for p in probabilities
    ]


def with_running_weight(histogram: DataFrame, value: str, weight: str) -> DataFrame:
    """Adds ``_upto`` (running weight) and ``_total``.

    One window task over the distinct values: for group sizes there are at most
    sqrt(2 * rows) of them, since distinct sizes must sum to no more than the rows.
    """
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ahead = Window.orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return histogram.withColumn("_upto", F.sum(weight).over(ahead)).withColumn(
        "_total", F.sum(weight).over(whole)
    )
