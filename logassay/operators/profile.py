"""Scale, distribution, long-tail and daily profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logassay.functions import quantile
from logassay.functions.numeric import filtered_sum, nulls, percent, rows_where, total
from logassay.operators.verdict import merge_facts
from logassay.roles import Roles
from logassay.sources.scratch import materialize


def _row_count(weight: str | None) -> Column:
    """Rows of a table, or of the table behind a folded one whose counts are in ``weight``."""
    return F.sum(weight) if weight else F.count(F.lit(1))


def scale_profile(df: DataFrame, roles: Roles, rsd: float | None = None) -> DataFrame:
    """One row: rows, distinct users / items / days, day range, and nulls of each key.

    Distinct counts leave null out; where null should count as a value of its
    own, add 1 when the matching ``*_nulls`` column is above 0. Giving ``rsd``
    swaps the exact counts for sketches of that relative error and no shuffle of keys.
    """
    user, item, day = F.col(roles.user), F.col(roles.item), F.col(roles.day)
    if rsd is not None:
        return df.agg(
            F.count(F.lit(1)).alias("rows"),
            *[F.approx_count_distinct(c, rsd).alias(n) for c, n in ((user, "users"), (item, "items"), (day, "days"))],
            F.min(day).alias("day_min"),
            F.max(day).alias("day_max"),
            *[nulls(c).alias(f"{n}_nulls") for c, n in ((user, "user"), (item, "item"), (day, "day"))],
        )
    # Rows fold to their keys first; the distinct counts then work on the folded rows.
    grain = df.groupBy(roles.day, *roles.pair).agg(F.count(F.lit(1)).alias("_rows"))
    return grain.agg(
        total(F.col("_rows")).alias("rows"),
        F.count_distinct(user).alias("users"),
        F.count_distinct(item).alias("items"),
        F.count_distinct(day).alias("days"),
        F.min(day).alias("day_min"),
        F.max(day).alias("day_max"),
        *[
            filtered_sum(c.isNull(), F.col("_rows")).alias(f"{n}_nulls")
            for c, n in ((user, "user"), (item, "item"), (day, "day"))
        ],
    )


def scale_from_folds(
    daily: DataFrame, user_tail: DataFrame, item_tail: DataFrame, roles: Roles
) -> DataFrame:
    """``scale_profile`` from the day table and the two ``long_tail`` rows, without reading the log."""
    day = F.col(roles.day)
    named = F.col("keys") - (F.col("null_key_rows") > 0).cast("bigint")
    return merge_facts(
        daily.agg(
            total(F.col("rows")).alias("rows"),
            F.count(day).alias("days"),
            F.min(day).alias("day_min"),
            F.max(day).alias("day_max"),
            filtered_sum(day.isNull(), F.col("rows")).alias("day_nulls"),
        ),
        user_tail.select(named.alias("users"), F.col("null_key_rows").alias("user_nulls")),
        item_tail.select(named.alias("items"), F.col("null_key_rows").alias("item_nulls")),
    ).select(
        "rows", "users", "items", "days", "day_min", "day_max", "user_nulls", "item_nulls", "day_nulls"
    )


def measure_counts(df: DataFrame, measure: str, more: Sequence[Column] = ()) -> DataFrame:
    """One map-side scan: measured and null rows, rows above 1 and at 0, and any further aggregates."""
    m = F.col(measure)
    return df.agg(
        F.count(m).alias("measured"),
        nulls(m).alias("null_count"),
        rows_where(m > 1).alias("gt1_count"),
        rows_where(m == 0).alias("eq0_count"),
        *more,
    )


def measure_profile(
    df: DataFrame,
    measure: str,
    probabilities: Sequence[float] = quantile.QUARTILES_AND_TAIL,
    digits: int = 6,
) -> DataFrame:
    """One row: min, max, mean, exact quantiles, and shares above 1 and at 0 among non-null.

    The measure is written once and every pass reads that column alone.
    """
    m = F.col(measure)
    df = materialize(df.select(measure), "measure")
    stats = measure_counts(
        df,
        measure,
        [
            F.round(F.min(m), digits).alias("min"),
            F.round(F.max(m), digits).alias("max"),
            F.round(F.avg(m), digits).alias("mean"),
        ],
    )
    found = quantile.nearest_quantiles(df, measure, probabilities).agg(
        *[
            F.round(F.max(F.when(F.col("p") == float(p), F.col("value"))), 4).alias(quantile.label(p))
            for p in probabilities
        ]
    )
    return (
        merge_facts(stats, found)
        .withColumn("gt1_pct", percent(F.col("gt1_count"), F.col("measured")))
        .withColumn("eq0_pct", percent(F.col("eq0_count"), F.col("measured")))
    )


def measure_quantiles(
    df: DataFrame, measure: str, probabilities: Sequence[float] = quantile.QUARTILES_AND_TAIL
) -> DataFrame:
    """Rows (p, value); the measure is written once, so that the passes read eight bytes a row."""
    return quantile.nearest_quantiles(materialize(df.select(measure), "measure"), measure, probabilities)


def approximate_quantiles(
    df: DataFrame,
    measure: str,
    probabilities: Sequence[float] = quantile.QUARTILES_AND_TAIL,
    accuracy: int = 10_000,
) -> DataFrame:
    """One pass instead of three; rank error at most rows / accuracy."""
    found = df.agg(
        F.approx_percentile(measure, [float(p) for p in probabilities], accuracy).alias("v")
    )
    pairs = F.arrays_zip(
        F.array(*[F.lit(float(p)) for p in probabilities]).alias("p"), F.col("v").alias("value")
    )
    return found.select(F.inline(pairs).alias("p", "value"))


def key_counts(df: DataFrame, key: str, weight: str | None = None) -> DataFrame:
    return df.groupBy(key).agg(_row_count(weight).alias("n"))


def long_tail(
    df: DataFrame,
    key: str,
    threshold: int = 10,
    probabilities: Sequence[float] = quantile.QUARTILES_AND_TAIL,
    weight: str | None = None,
) -> DataFrame:
    """One row about interactions per key: quantiles, maximum, and keys below the threshold.

    A null key counts as one key; ``null_key_rows`` tells how many rows it has.

    Counts per key are folded into a histogram of counts first, so only the
    distinct count values ever meet in one task.
    """
    unnamed = F.sum(F.when(F.col(key).isNull(), F.col("n")))
    histogram = (
        key_counts(df, key, weight)
        .groupBy("n")
        .agg(F.count(F.lit(1)).alias("keys"), unnamed.alias("unnamed"))
    )
    few = F.coalesce(F.sum(F.when(F.col("n") < threshold, F.col("keys"))), F.lit(0))
    return (
        quantile.with_running_weight(histogram, "n", "keys")
        .agg(
            F.coalesce(F.sum("keys"), F.lit(0)).alias("keys"),
            *quantile.histogram_quantiles("n", probabilities),
            F.max("n").alias("max"),
            few.alias("below_count"),
            F.coalesce(F.sum("unnamed"), F.lit(0)).alias("null_key_rows"),
        )
        .withColumn("below_pct", percent(F.col("below_count"), F.col("keys"), 2))
    )


def rare_keys(df: DataFrame, key: str, threshold: int = 10) -> DataFrame:
    """The keys behind the tail: every key with fewer than ``threshold`` rows."""
    return key_counts(df, key).where(F.col("n") < threshold)


def daily_activity(df: DataFrame, roles: Roles, weight: str | None = None) -> DataFrame:
    """Rows, active users and active items per day; the null day stays as a group.

    Rows fold to (day, user, item) first, so the distinct counts expand folded rows only.
    """
    grain = df.groupBy(roles.day, *roles.pair).agg(_row_count(weight).alias("_rows"))
    return grain.groupBy(roles.day).agg(
        F.sum("_rows").alias("interactions"),
        F.count_distinct(roles.user).alias("active_users"),
        F.count_distinct(roles.item).alias("active_items"),
    )


def daily_activity_stats(
    df: DataFrame, roles: Roles, include_null_day: bool = False, weight: str | None = None
) -> DataFrame:
    """One row over the per-day counts. The null day is left out unless asked for."""
    per_day = df.groupBy(roles.day).agg(_row_count(weight).alias("n"))
    kept: Column = F.lit(True) if include_null_day else F.col(roles.day).isNotNull()
    n = F.when(kept, F.col("n"))
    return per_day.agg(
        F.count(n).alias("days"),
        F.coalesce(F.sum(F.when(F.col(roles.day).isNull(), F.col("n"))), F.lit(0)).alias("null_rows"),
        F.min(n).alias("min_rows"),
        F.max(n).alias("max_rows"),
        F.round(F.avg(n), 4).alias("mean_rows"),
        F.median(n).alias("median_rows"),
    )


def label_shares(df: DataFrame, measure: str, thresholds: Sequence[float] = (0.5, 1.0)) -> DataFrame:
    """Share of measured rows above (and at or above) each label threshold. One scan."""
    m = F.col(measure)
    counted = df.agg(
        F.count(m).alias("measured"),
        *[rows_where(m > t).alias(f"gt_{i}") for i, t in enumerate(thresholds)],
        *[rows_where(m >= t).alias(f"ge_{i}") for i, t in enumerate(thresholds)],
    )
    each = F.array(
        *[
            F.struct(
                F.lit(float(t)).alias("threshold"),
                F.col(f"gt_{i}").alias("above"),
                F.col(f"ge_{i}").alias("at_or_above"),
            )
            for i, t in enumerate(thresholds)
        ]
    )
    return (
        counted.select("measured", F.inline(each))
        .withColumn("above_pct", percent(F.col("above"), F.col("measured")))
        .withColumn("at_or_above_pct", percent(F.col("at_or_above"), F.col("measured")))
    )
