"""Dedupe policies for repeated rows and repeated pairs.

``keep_one`` filters ``row_number() = 1``, which Spark turns into a per-task
group limit ahead of the shuffle: at most one row per key and task is sent, so
a pair holding a third of the table arrives as a handful of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logassay.functions.keys import comparable
from logassay.roles import Roles


def drop_exact(df: DataFrame) -> DataFrame:
    """One row per distinct row; maps compare by their entries."""
    maps = {f.name for f in df.schema.fields if isinstance(f.dataType, T.MapType)}
    if not maps:
        return df.dropDuplicates()
    flat = df.select(*[comparable(f) for f in df.schema.fields]).distinct()
    return flat.select(*[F.map_from_entries(c).alias(c) if c in maps else F.col(c) for c in df.columns])


def keep_one(df: DataFrame, keys: Sequence[str], best_first: Sequence[Column]) -> DataFrame:
    """One row per key: the first by ``best_first``, then by all other columns, so the pick is fixed."""
    ties = [comparable(f).desc_nulls_last() for f in df.schema.fields if f.name not in keys]
    order = Window.partitionBy(*keys).orderBy(*best_first, *ties)
    return df.withColumn("_rank", F.row_number().over(order)).where("_rank = 1").drop("_rank")


def keep_last(df: DataFrame, roles: Roles, within_day: bool = False) -> DataFrame:
    """The latest row of each pair (of each day)."""
    keys = roles.day_pair if within_day else roles.pair
    return keep_one(df, keys, [F.col(roles.wall_time).desc_nulls_last()])


def keep_highest(df: DataFrame, roles: Roles, within_day: bool = False) -> DataFrame:
    """The row of each pair (of each day) with the largest ratio."""
    keys = roles.day_pair if within_day else roles.pair
    return keep_one(df, keys, [F.col(roles.ratio).desc_nulls_last()])


def fold_pairs(df: DataFrame, roles: Roles, within_day: bool = False) -> DataFrame:
    """One summary row per pair (and day): count, total numerator, largest ratio, first and last time."""
    keys = roles.day_pair if within_day else roles.pair
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(roles.numerator).alias("total_numerator"),
        F.max(roles.ratio).alias("max_ratio"),
        F.min(roles.wall_time).alias("first_time"),
        F.max(roles.wall_time).alias("last_time"),
    )
