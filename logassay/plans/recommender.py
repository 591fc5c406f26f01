"""Registered queries on what users do with items: neighbours, metrics, samples, estimates."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logassay.functions import clock
from logassay.operators import (
    counterfactual, coverage, evaluation, neighbours, ranking, samples, sampling, vectors,
)
from logassay.plans import inputs
from logassay.plans.inputs import PURCHASE_ROLES, ROLES, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Fixed values of the registered queries.
NEIGHBOURS, ALPHA = 5, 1
TRAINED_BEFORE = 20240121
LIKED = 0.5
EVERY, NEAREST, SCALE, ROUNDS = 50, 10, 256, 3
SEED, QUOTAS = 17, (2, 2, 3)
WINDOW_START, WINDOW_DAYS, WINDOW_STEP, HORIZON_DAYS = 20240101, 8, 2, 4
PART = 16
POPULAR, CLIP, REPLICATES = 10, 0.05, 64
PROBES, CURVE = 32, (1, 2, 4, 8, 16, 32)


def query(f: Callable[[SparkSession, str], DataFrame]):
    QUERIES[f.__name__] = f
    return f


# ---------------------------------------------------------------- neighbours


@query
def item_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.item_neighbours(inputs.log(spark, sf_dir), ROLES, NEIGHBOURS)


@query
def item_neighbours_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.item_neighbours(inputs.purchases(spark, sf_dir), PURCHASE_ROLES, NEIGHBOURS)


@query
def swing_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.swing_neighbours(inputs.purchases(spark, sf_dir), PURCHASE_ROLES, NEIGHBOURS, ALPHA)


# ---------------------------------------------------------------- areas under the curve


def later_exposures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exposures from a day on, scored by the item's users before it, labelled by the share played.

    Items without earlier users have no score, and rows without a ratio no label.
    """
    log = inputs.log(spark, sf_dir)
    popular = (
        log.where(F.col("day") < TRAINED_BEFORE)
        .groupBy("item_id", "user_id")
        .agg(F.max("played_ms").alias("_p"))
        .groupBy("item_id")
        .agg(F.count("user_id").alias("score"))
    )
    later = log.where(F.col("day") >= TRAINED_BEFORE)
    return later.join(popular, "item_id", "left").select(
        "user_id", "item_id", "score", "played_ms", (F.col("ratio") > LIKED).alias("liked")
    )


@query
def auc_popularity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Few distinct scores: most pairs are ties."""
    return evaluation.auc(later_exposures(spark, sf_dir), "score", "liked")


@query
def auc_played(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many distinct scores."""
    return evaluation.auc(later_exposures(spark, sf_dir), "played_ms", "liked")


@query
def user_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.user_auc(later_exposures(spark, sf_dir), "user_id", "played_ms", "liked")


@query
def gauc(spark: SparkSession, sf_dir: str) -> DataFrame:
    exposures = later_exposures(spark, sf_dir)
    return evaluation.gauc(evaluation.user_auc(exposures, "user_id", "score", "liked"))


# ---------------------------------------------------------------- nearest vectors


@query
def vector_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vecs = table(spark, sf_dir, "embeddings")
    return vectors.top_k(vecs, "vec_id", "embedding", EVERY, NEAREST, PROBES, SCALE, ROUNDS)


@query
def vector_recall_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    vecs = table(spark, sf_dir, "embeddings")
    return vectors.recall_curve(vecs, "vec_id", "embedding", EVERY, NEAREST, CURVE, SCALE, ROUNDS)


# ---------------------------------------------------------------- samples


@query
def negative_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of few items, half of them touched: draws often meet touched ones."""
    return sampling.negative_samples(inputs.log(spark, sf_dir), ROLES, QUOTAS, SEED)


@query
def negative_samples_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.negative_samples(inputs.purchases(spark, sf_dir), PURCHASE_ROLES, QUOTAS, SEED)


@query
def sliding_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples.sliding_samples(
        inputs.log(spark, sf_dir), ROLES, WINDOW_START, WINDOW_DAYS, WINDOW_STEP, HORIZON_DAYS
    )


@query
def sequence_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples.sequence_texts(inputs.log(spark, sf_dir), ROLES, PART)


@query
def gap_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.gap_cells(inputs.log(spark, sf_dir), ROLES)


# ---------------------------------------------------------------- estimates


def study(spark: SparkSession, sf_dir: str) -> counterfactual.Study:
    """Later exposures: was a popular item shown, and was it liked, given the user's past and the hour."""
    log = inputs.log(spark, sf_dir)
    popular = ranking.popular_items(log, ROLES, TRAINED_BEFORE, POPULAR).select("item_id", F.lit(1).alias("_p"))
    past = log.where(F.col("day") < TRAINED_BEFORE).groupBy("user_id").agg(F.count(F.lit(1)).alias("_n"))
    later = log.where(F.col("day") >= TRAINED_BEFORE)
    # The list has ``POPULAR`` rows.
    rows = later.join(F.broadcast(popular), "item_id", "left").join(past, "user_id", "left").select(
        (F.coalesce("_n", F.lit(0)) / 100).alias("past"),
        (F.hour("wall_time") / 24).alias("hour"),
        F.coalesce("_p", F.lit(0)).alias("popular"),
        (F.col("ratio") > LIKED).cast("int").alias("liked"),
        F.concat_ws(":", "user_id", "item_id", clock.epoch_micros(F.col("wall_time"))).alias("key"),
    )
    return counterfactual.Study(rows, ("past", "hour"), "popular", "liked", "key", CLIP)


@query
def propensity_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counterfactual.propensity_model(study(spark, sf_dir))


@query
def policy_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counterfactual.policy_values(study(spark, sf_dir))


@query
def doubly_robust(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counterfactual.doubly_robust(study(spark, sf_dir), REPLICATES, SEED)
