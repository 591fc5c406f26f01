"""What a policy would have earned, from a log of another: propensities, weights, doubly robust estimates.

Models are small: a few features. Each step of a fit is one pass that sums a
gradient and a Hessian (or normal equations); the driver gets those k x k sums,
never rows. Intervals come from a Poisson bootstrap: every row gets, for every
replicate, a count from a hash of its key, and all replicates are summed up in
one pass.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logassay.functions.numeric import ratio
from logassay.sources.scratch import materialize

ROUNDS, TOLERANCE = 25, 1e-12
# Replicates that share one hash: each takes four of its hexadecimal digits.
PER_HASH = 8


def _dot(features: Sequence[Column], weights: Sequence[float]) -> Column:
    return sum((x * F.lit(float(w)) for x, w in zip(features[1:], weights[1:], strict=True)), features[0] * F.lit(float(weights[0])))


def _sums(df: DataFrame, vector: Sequence[Column], matrix: Sequence[Sequence[Column]]) -> tuple[np.ndarray, np.ndarray]:
    """Sums of k columns and of the upper triangle of k x k columns, in one pass."""
    k = len(vector)
    cells = [(i, j) for i in range(k) for j in range(i, k)]
    row = df.agg(
        *[F.coalesce(F.sum(v), F.lit(0.0)).alias(f"v{i}") for i, v in enumerate(vector)],
        *[F.coalesce(F.sum(matrix[i][j]), F.lit(0.0)).alias(f"m{i}_{j}") for i, j in cells],
    ).first()
    square = np.zeros((k, k))
    for i, j in cells:
        square[i, j] = square[j, i] = row[f"m{i}_{j}"]
    return np.array([row[f"v{i}"] for i in range(k)]), square


def logistic(df: DataFrame, features: Sequence[Column], treated: Column) -> np.ndarray:
    """Coefficients of the chance of ``treated`` (0 or 1), by Newton steps until they rest.

    A singular Hessian (constant features, one class only) is solved by least
    squares; without rows all coefficients are 0.
    """
    beta = np.zeros(len(features))
    for _ in range(ROUNDS):
        chance = 1 / (1 + F.exp(-_dot(features, beta)))
        spread = chance * (1 - chance)
        slope, curve = _sums(
            df, [(treated - chance) * x for x in features], [[spread * x * y for y in features] for x in features]
        )
        move = np.linalg.lstsq(curve, slope, rcond=None)[0]
        # One class only drives coefficients to infinity; they stop where chances are 0 or 1 in doubles.
        beta = np.clip(beta + move, -40, 40)
        if np.abs(move).max() < TOLERANCE:
            break
    return beta


def least_squares(df: DataFrame, features: Sequence[Column], outcome: Column) -> np.ndarray:
    """Coefficients of a linear fit of ``outcome``."""
    right, square = _sums(df, [x * outcome for x in features], [[x * y for y in features] for x in features])
    return np.linalg.lstsq(square, right, rcond=None)[0]


@dataclass
class Study:
    """A log as features, treatment (0 or 1), outcome and key.

    Rows with a null or NaN in any of these columns are left out.
    """

    rows: DataFrame
    names: Sequence[str]
    treated: str
    outcome: str
    key: str
    clip: float = 0.05

    def __post_init__(self):
        columns = [*self.names, self.treated, self.outcome, self.key]
        # Every step of a fit reads these columns again, so they are written once.
        self.rows = materialize(self.rows.select(*columns).dropna(subset=columns), "study")
        self.features = [F.lit(1.0), *[F.col(c).cast("double") for c in self.names]]
        self.t = F.col(self.treated).cast("double")
        self.y = F.col(self.outcome).cast("double")
        self.beta = logistic(self.rows, self.features, self.t)

    @property
    def chance(self) -> Column:
        return 1 / (1 + F.exp(-_dot(self.features, self.beta)))

    @property
    def clipped(self) -> Column:
        return F.least(F.greatest(self.chance, F.lit(self.clip)), F.lit(1 - self.clip))


def propensity_model(study: Study) -> DataFrame:
    """One row per feature: its coefficient in the chance of treatment, rounded to six digits."""
    rows = [(i, n, round(float(b), 6) + 0.0) for i, (n, b) in enumerate(zip(("intercept", *study.names), study.beta, strict=True))]
    return study.rows.sparkSession.createDataFrame(rows, "position int, feature string, coefficient double")


def policy_values(study: Study) -> DataFrame:
    """One row per policy (treat all, treat none): what it would earn by IPS and by SNIPS.

    ``clipped_rows`` counts propensities outside [clip, 1 - clip], which are cut to
    these bounds; ``effective_rows`` is (sum of weights)^2 / sum of squared weights.
    """
    e, t, y = study.clipped, study.t, study.y
    n = F.count(F.lit(1))
    cut = F.count_if(study.chance != e)
    weights = {"treat_all": t / e, "treat_none": (1 - t) / (1 - e)}
    sums = [n.alias("rows"), cut.alias("clipped_rows")]
    for name, w in weights.items():
        sums += [
            F.count_if(w > 0).alias(f"{name}_n"), F.sum(w).alias(f"{name}_w"), F.sum(w * w).alias(f"{name}_ww"),
            F.sum(w * y).alias(f"{name}_wy"), F.sum(F.when(w > 0, y)).alias(f"{name}_y"),
        ]
    cells = [
        F.struct(
            F.lit(p).alias("policy"),
            "rows",
            F.col(f"{p}_n").alias("logged_rows"),
            "clipped_rows",
            F.round(ratio(F.col(f"{p}_y"), F.col(f"{p}_n")), 6).alias("observed"),
            F.round(ratio(F.col(f"{p}_wy"), F.col("rows")), 6).alias("ips"),
            F.round(ratio(F.col(f"{p}_wy"), F.col(f"{p}_w")), 6).alias("snips"),
            F.round(ratio(F.col(f"{p}_w") * F.col(f"{p}_w"), F.col(f"{p}_ww")), 3).alias("effective_rows"),
        )
        for p in weights
    ]
    return study.rows.agg(*sums).select(F.inline(F.array(*cells)))


def _effect(study: Study) -> Column:
    """A row's share in the doubly robust effect: model difference plus weighted residuals."""
    treated, rest = study.rows.where(study.t == 1), study.rows.where(study.t == 0)
    one = _dot(study.features, least_squares(treated, study.features, study.y))
    zero = _dot(study.features, least_squares(rest, study.features, study.y))
    e, t, y = study.clipped, study.t, study.y
    return one - zero + t * (y - one) / e - (1 - t) * (y - zero) / (1 - e)


def poisson_steps() -> list[int]:
    """Of 65,536 equally likely hash values, how many lie at or below each count's cumulative chance."""
    out, chance, total, k = [], math.exp(-1), 0.0, 0
    while math.floor(65536 * total) < 65535:
        total += chance
        out.append(math.floor(65536 * total))
        k += 1
        chance /= k
    return out


def bootstrap(rows: DataFrame, value: Column, key: Column, replicates: int, seed: int) -> DataFrame:
    """replicate, weight, total: counts and weighted sums of ``value`` for Poisson(1) resamples of the rows.

    A replicate's count of a row is read from four digits of the MD5 of
    ``seed:key:number``; rows with equal keys are drawn together.
    """
    groups = -(-replicates // PER_HASH)
    hashed = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("_key").cast("string"), F.col("_g").cast("string")))
    dealt = rows.select(value.alias("_v"), key.alias("_key")).withColumn(
        "_g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    ).withColumn("_h", hashed)
    steps = poisson_steps()
    sums = []
    for r in range(PER_HASH):
        digits = F.conv(F.substring("_h", 4 * r + 1, 4), 16, 10).cast("int")
        count = sum((F.when(digits >= s, 1).otherwise(0) for s in steps[1:]), F.when(digits >= steps[0], 1).otherwise(0))
        sums += [F.sum(count).alias(f"w{r}"), F.sum(count * F.col("_v")).alias(f"t{r}")]
    cells = F.array(*[
        F.struct((F.col("_g") * PER_HASH + r).alias("replicate"), F.col(f"w{r}").alias("weight"), F.col(f"t{r}").alias("total"))
        for r in range(PER_HASH)
    ])
    return dealt.groupBy("_g").agg(*sums).select(F.inline(cells)).where(F.col("replicate") < replicates)


def doubly_robust(study: Study, replicates: int, seed: int, level: float = 0.95) -> DataFrame:
    """One row: rows, effect of treating all over treating none, its standard error and interval.

    The interval holds the middle ``level`` of the replicates' means (nearest rank).
    """
    share = study.rows.select(_effect(study).alias("_v"), F.col(study.key).alias("_key"))
    means = bootstrap(share, F.col("_v"), F.col("_key"), replicates, seed).withColumn(
        "mean", ratio(F.col("total"), F.col("weight"))
    ).where("mean IS NOT NULL")
    # One row for each replicate is ordered here.
    place = Window.orderBy("mean")
    at = lambda p: F.floor((F.col("n") - 1) * F.lit(p) + 0.5) + 1
    placed = means.withColumn("at", F.row_number().over(place)).withColumn("n", F.count(F.lit(1)).over(Window.partitionBy()))
    tails = ((1 - level) / 2, (1 + level) / 2)
    spread = placed.agg(
        F.count(F.lit(1)).alias("replicates"),
        F.round(F.stddev_samp("mean"), 6).alias("standard_error"),
        *[F.round(F.max(F.when(F.col("at") == at(p), F.col("mean"))), 6).alias(n) for p, n in zip(tails, ("low", "high"), strict=True)],
    ).first()
    whole = share.agg(F.count(F.lit(1)).alias("rows"), F.round(F.avg("_v"), 6).alias("effect"))
    return whole.select(
        "rows", "effect", *[F.lit(spread[c]).cast("double" if c != "replicates" else "long").alias(c) for c in ("standard_error", "low", "high", "replicates")]
    )
