"""Runs of consecutive days, the gaps between them, and date splits.

Without keys the windows have no partition: they run over one row per
distinct calendar day, a number the calendar bounds whatever the table's size.
With keys (say, per user) each group is at most one row per calendar day.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logassay.functions import clock


def _could_be_a_day(key: Column) -> Column:
    """Months 1 to 12 and days 1 to 31: some 3.3 million integers at most, by arithmetic alone."""
    return (
        key.between(10000101, 99991231)
        & F.pmod(key, F.lit(100)).between(1, 31)
        & F.pmod(F.floor(key / 100), F.lit(100)).between(1, 12)
    )


def day_steps(df: DataFrame, day: str, keys: Sequence[str] = ()) -> DataFrame:
    """Each active day with the days passed since the previous one (null for the first).

    Days are folded while they are still integers; integers that cannot be days go,
    so the window holds a bounded number of rows whatever the column holds, and only
    then they are turned into dates. That test asks for the folded row count as well,
    as a plain one would be pushed below the fold and run on every row. The dates
    that do not exist are null and are dropped after the window for the same reason.
    """
    earlier = Window.partitionBy(*keys).orderBy(F.col("day_date").asc_nulls_first())
    step = F.datediff("day_date", F.lag("day_date").over(earlier)).cast("bigint")
    return (
        df.groupBy(*keys, day)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .where(F.when(F.col("_rows") > 0, _could_be_a_day(F.col(day))))
        .select(*keys, clock.day_key_to_date(F.col(day)).alias("day_date"))
        .withColumn("days_since_previous", step)
        .where(F.col("day_date").isNotNull())
    )


def day_segments(
    df: DataFrame, day: str, keys: Sequence[str] = (), max_step: int = 1
) -> DataFrame:
    """Each active day with the number (from 1) of the run it belongs to."""
    opens = F.coalesce(F.col("days_since_previous") > max_step, F.lit(True))
    running = Window.partitionBy(*keys).orderBy("day_date").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return day_steps(df, day, keys).select(
        *keys, "day_date", F.sum(opens.cast("bigint")).over(running).alias("segment")
    )


def date_segments(
    df: DataFrame, day: str, keys: Sequence[str] = (), max_step: int = 1
) -> DataFrame:
    """Runs of days: first, last and number of active days."""
    return (
        day_segments(df, day, keys, max_step)
        .groupBy(*keys, "segment")
        .agg(
            F.min("day_date").alias("_first"),
            F.max("day_date").alias("_last"),
            F.count(F.lit(1)).alias("days"),
        )
        .select(
            *keys,
            "segment",
            clock.day_key(F.col("_first")).alias("first_day"),
            clock.day_key(F.col("_last")).alias("last_day"),
            "days",
        )
    )


def date_gaps(df: DataFrame, day: str, keys: Sequence[str] = (), max_step: int = 1) -> DataFrame:
    """Empty stretches between runs: first and last missing day and length."""
    ordered = Window.partitionBy(*keys).orderBy("segment")
    bounds = (
        date_segments(df, day, keys, max_step)
        .withColumn("_end", clock.day_key_to_date(F.col("last_day")))
        .withColumn("_next", F.lead(clock.day_key_to_date(F.col("first_day"))).over(ordered))
    )
    return bounds.where(F.col("_next").isNotNull()).select(
        *keys,
        F.col("segment").alias("gap"),
        clock.day_key(F.date_add("_end", 1)).alias("gap_first"),
        clock.day_key(F.date_sub("_next", 1)).alias("gap_last"),
        (F.datediff("_next", "_end") - 1).cast("bigint").alias("gap_days"),
    )


@dataclass(frozen=True)
class DayRange:
    """A named, inclusive range of YYYYMMDD days; one name may own several ranges."""

    name: str
    first: int
    last: int


def split_of(day: Column, ranges: Sequence[DayRange], outside: str = "quarantine") -> Column:
    """Name of the range a day falls in. Ranges must not overlap."""
    ordered = sorted(ranges, key=lambda r: r.first)
    for a, b in zip(ordered, ordered[1:]):
        if b.first <= a.last:
            raise ValueError(f"split ranges overlap: {a} and {b}")
    chain = reduce(
        lambda c, r: c.when(day.between(r.first, r.last), r.name), ordered, F
    )
    return chain.otherwise(outside)


def time_split(df: DataFrame, day: str, ranges: Sequence[DayRange]) -> DataFrame:
    """The table with a ``split`` column; a plain expression, no join."""
    return df.withColumn("split", split_of(F.col(day), ranges))


def split_summary(df: DataFrame, day: str, user: str, ranges: Sequence[DayRange]) -> DataFrame:
    """Rows, users and days per split.

    Rows fold to (day, user) first; users of a split are counted from its distinct
    (split, user) pairs and days from (split, day), each a fold of the one before,
    so no row of the log is expanded for a distinct count.
    """
    grain = df.groupBy(day, user).agg(F.count(F.lit(1)).alias("rows"))
    split = time_split(grain, day, ranges)
    by_day = split.groupBy("split", day).agg(F.sum("rows").alias("rows"))
    by_user = split.select("split", user).distinct()
    days = by_day.groupBy("split").agg(
        F.sum("rows").alias("rows"),
        F.count(day).alias("days"),
        F.min(day).alias("first_day"),
        F.max(day).alias("last_day"),
    )
    users = by_user.groupBy(F.col("split").alias("_split")).agg(F.count(user).alias("users"))
    return days.join(users, F.col("split") == F.col("_split")).select(
        "split", "rows", "users", "days", "first_day", "last_day"
    )
