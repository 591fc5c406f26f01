"""Rules the audit sets for later use of the log: sequences cut at gaps, features from before the day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logassay.functions import clock
from logassay.functions.numeric import nulls, rows_where
from logassay.operators.calendar import day_segments
from logassay.roles import Roles


# Spark keeps a rank filter on the map side only up to this many rows per group.
GROUP_LIMIT = 1000


def with_run(df: DataFrame, roles: Roles, *more: str) -> DataFrame:
    """The rows with the number of the run of days theirs belongs to, and the columns ``more``.

    The broadcast table has one row per valid calendar day, at most 3.3 million
    whatever the log holds. Rows whose day is null or impossible get no run.
    """
    runs = day_segments(df, roles.day).select(
        clock.day_key(F.col("day_date")).alias(roles.day), "segment"
    )
    return df.select(roles.user, roles.item, roles.wall_time, roles.day, *more).join(
        F.broadcast(runs), roles.day, "left"
    )


def segment_sequences(df: DataFrame, roles: Roles) -> DataFrame:
    """Every event with its run of days, ordered by user, run and time within the partitions.

    Sequences never cross an empty stretch of the calendar. Nothing is grouped:
    the range partitioning cuts within a user, so a user that owns a third of
    the log is spread over many tasks. Events without a valid day have a null run.
    """
    order = (roles.user, "segment", roles.wall_time, roles.item)
    return (
        with_run(df, roles)
        .select(*order)
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
    )


def sequence_losses(df: DataFrame, roles: Roles) -> DataFrame:
    """One row: events, events in a run, and events without a null or an impossible day."""
    run = with_run(df, roles)
    return run.agg(
        F.count(F.lit(1)).alias("events"),
        F.count("segment").alias("in_a_run"),
        nulls(F.col(roles.day)).alias("null_day"),
        rows_where(F.col(roles.day).isNotNull() & F.col("segment").isNull()).alias("impossible_day"),
    )


def newest_sequences(df: DataFrame, roles: Roles, newest: int = 50) -> DataFrame:
    """Per user and run the ``newest`` items in time order, and how many events there are in all.

    A top-n report: the rank filter runs per task before the shuffle, which
    Spark does only up to ``GROUP_LIMIT`` rows; beyond that it is refused.
    """
    if not 1 <= newest <= GROUP_LIMIT:
        raise ValueError(f"newest must be 1 to {GROUP_LIMIT}, not {newest}; use segment_sequences")
    rows = with_run(df, roles).where(F.col("segment").isNotNull())
    latest = Window.partitionBy(roles.user, "segment").orderBy(
        F.col(roles.wall_time).desc_nulls_last(), F.col(roles.item).desc_nulls_last()
    )
    ranked = rows.withColumn("_rank", F.row_number().over(latest)).where(F.col("_rank") <= newest)
    oldest_first = F.array_sort(
        F.collect_list(F.struct((-F.col("_rank")).alias("r"), F.col(roles.item).alias("i")))
    )
    lists = ranked.groupBy(F.col(roles.user).alias("_u"), F.col("segment").alias("_s")).agg(
        F.count(F.lit(1)).alias("events"), oldest_first.alias("_items")
    )
    totals = rows.groupBy(roles.user, "segment").agg(F.count(F.lit(1)).alias("events_total"))
    same = F.col(roles.user).eqNullSafe(F.col("_u")) & (F.col("segment") == F.col("_s"))
    return totals.join(lists, same).select(
        roles.user,
        "segment",
        "events_total",
        "events",
        F.concat_ws(" ", F.transform("_items", lambda s: s["i"].cast("string"))).alias("items"),
    )


def point_in_time_features(
    log: DataFrame, roles: Roles, features: DataFrame, feature_item: str, feature_day: str,
    values: Sequence[str],
) -> DataFrame:
    """Per (item, exposure day): the newest feature row dated strictly before that day.

    Exposures are folded to (item, day) first, and features to one row per
    (item, day), so each window group holds at most two rows per calendar day
    however hot the item is. Join the result back on (item, day) if rows are wanted.
    """
    number = F.datediff(clock.day_key_to_date(F.col("_day")), F.lit("1970-01-01").cast("date"))
    shown = (
        log.where(F.col(roles.day).isNotNull() & F.col(roles.item).isNotNull())
        .groupBy(F.col(roles.item).alias("_item"), F.col(roles.day).alias("_day"))
        .agg(F.count(F.lit(1)).alias("exposures"))
    )
    offered = (
        features.select(
            F.col(feature_item).alias("_item"),
            F.col(feature_day).alias("_day"),
            F.struct(F.col(feature_day).alias("feature_day"), *values).alias("_f"),
        )
        .groupBy("_item", "_day")
        .agg(F.max("_f").alias("_f"))
    )
    before = Window.partitionBy("_item").orderBy("_n").rangeBetween(Window.unboundedPreceding, -1)
    # A feature with an impossible day is never seen.
    dated = F.when(F.col("_n").isNotNull(), F.col("_f"))
    return (
        shown.unionByName(offered, allowMissingColumns=True)
        .withColumn("_n", number)
        .withColumn("_seen", F.last(dated, ignorenulls=True).over(before))
        .where(F.col("exposures").isNotNull())
        .select(
            F.col("_item").alias(roles.item),
            F.col("_day").alias(roles.day),
            "exposures",
            "_seen.feature_day",
            *[F.col(f"_seen.{v}") for v in values],
        )
    )
