"""Popularity of items before a day, and metrics of ranked lists against what users did later."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logassay.functions.numeric import ratio
from logassay.roles import Roles


def popular_items(df: DataFrame, roles: Roles, before: int, top: int) -> DataFrame:
    """The ``top`` items by distinct users on days before ``before`` (a top-n report), ranked from 1.

    Ties go to the smaller item. The rank is given to the ``top`` rows only.
    """
    counted = (
        df.where((F.col(roles.day) < before) & F.col(roles.item).isNotNull() & F.col(roles.user).isNotNull())
        .groupBy(*roles.pair)
        .agg(F.count(F.lit(1)).alias("rows"))
        .groupBy(roles.item)
        .agg(F.count(F.lit(1)).alias("users"), F.sum("rows").alias("rows"))
        .orderBy(F.desc("users"), roles.item)
        .limit(top)
    )
    listed = counted.agg(
        F.array_sort(F.collect_list(F.struct((-F.col("users")).alias("u"), F.col(roles.item).alias("i"), "rows"))).alias("l")
    )
    return listed.select(F.posexplode("l").alias("at", "x")).select(
        (F.col("at") + 1).cast("bigint").alias("rank"),
        F.col("x.i").alias(roles.item),
        (-F.col("x.u")).alias("users"),
        F.col("x.rows").alias("rows"),
    )


def ranked_relevant(later: DataFrame, ranked: DataFrame, roles: Roles, top: int) -> DataFrame:
    """Distinct later (user, item) pairs with the item's rank in one list for all, null if not in it.

    ``ranked`` has at most ``top`` rows, which bounds its broadcast.
    """
    pairs = (
        later.where(F.col(roles.user).isNotNull() & F.col(roles.item).isNotNull())
        .select(*roles.pair)
        .distinct()
    )
    return pairs.join(F.broadcast(ranked.where(F.col("rank") <= top).select(roles.item, "rank")), roles.item, "left")


def ranking_metrics(relevant: DataFrame, user: str, k: int) -> DataFrame:
    """One row: users, and the means over users of hit rate, recall, NDCG and reciprocal rank at ``k``.

    ``relevant`` holds each user's relevant items with their rank in the user's
    list (null when not listed). Users' rows are folded before the shuffle.
    """
    ideal = [sum(1 / math.log2(i + 1) for i in range(1, n + 1)) for n in range(1, k + 1)]
    listed = F.when(F.col("rank") <= k, F.col("rank"))
    per_user = relevant.groupBy(user).agg(
        F.count(F.lit(1)).alias("n"),
        F.count(listed).alias("hits"),
        F.coalesce(F.sum(1 / F.log2(listed + 1)), F.lit(0.0)).alias("dcg"),
        F.min(listed).alias("first"),
    )
    best = F.element_at(F.array(*[F.lit(x) for x in ideal]), F.least(F.col("n"), F.lit(k)).cast("int"))
    return per_user.agg(
        F.count(F.lit(1)).alias("users"),
        F.round(F.avg((F.col("hits") > 0).cast("double")), 6).alias("hit_rate"),
        F.round(F.avg(ratio(F.col("hits"), F.col("n"))), 6).alias("recall"),
        F.round(F.avg(ratio(F.col("dcg"), best)), 6).alias("ndcg"),
        F.round(F.avg(F.coalesce(ratio(F.lit(1), F.col("first")), F.lit(0.0))), 6).alias("reciprocal_rank"),
    )
