"""How well scores order the rows that count: area under the ROC curve, whole and by user.

An area is the share of (positive, negative) pairs whose positive has the higher
score, a tie counting half. Rows are folded to one for each score (and user)
before anything is ordered, the order is global and cut by range, and a score's
pairs follow from the negatives before it. No window holds a user or a table:
a user with a third of the log lies in as many ranges as its scores fill.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logassay.functions.numeric import ratio, rows_where
from logassay.operators.order import running_sums

# Pairs of 10^13 rows and more do not fit 64 bits.
WIDE = "decimal(38,0)"


def _folded(df: DataFrame, score: str, label: str, *keys: str) -> DataFrame:
    """Positives, negatives and unusable rows by keys and ``_score``, which is null for unusable ones."""
    number, hit = F.col(score).cast("double"), F.col(label).cast("boolean")
    usable = hit.isNotNull() & number.isNotNull() & ~F.isnan(number)
    return df.groupBy(*keys, F.when(usable, F.col(score)).alias("_score")).agg(
        rows_where(usable & hit).alias("pos"), rows_where(usable & ~hit).alias("neg"), rows_where(~usable).alias("off")
    )


def _twice_won() -> Column:
    """Twice the pairs that the positives of one score win, over all negatives before it."""
    return F.col("pos").cast(WIDE) * (2 * F.col("before") + F.col("neg")).cast(WIDE)


def auc(df: DataFrame, score: str, label: str) -> DataFrame:
    """One row: rows, positives, negatives, unscored_rows and auc (null unless both classes occur).

    Rows whose score is null or NaN or whose label is null are left out and
    counted as ``unscored_rows``. The result is rounded to nine digits.
    """
    counted = running_sums(_folded(df, score, label), [F.col("_score")], {"before": "neg"})
    sums = counted.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(n) for c, n in
          (("pos", "positives"), ("neg", "negatives"), ("off", "unscored_rows"))],
        F.sum(_twice_won()).alias("_won"),
    )
    pairs = 2 * F.col("positives").cast("double") * F.col("negatives")
    return sums.select(
        (F.col("positives") + F.col("negatives") + F.col("unscored_rows")).alias("rows"),
        "positives",
        "negatives",
        "unscored_rows",
        F.round(ratio(F.col("_won"), pairs), 9).alias("auc"),
    )


def user_auc(df: DataFrame, user: str, score: str, label: str) -> DataFrame:
    """One row per user with usable rows: impressions, positives, negatives and auc (null if of one class)."""
    folded = _folded(df.where(F.col(user).isNotNull()), score, label, user).where("_score IS NOT NULL")
    counted = running_sums(folded, [F.col(user), F.col("_score")], {"before": "neg"})
    # The running sum goes through all users; what stood before the user's first row comes off.
    sums = counted.groupBy(user).agg(
        F.sum("pos").alias("positives"),
        F.sum("neg").alias("negatives"),
        F.min("before").alias("_start"),
        F.sum(_twice_won()).alias("_won"),
    )
    off = 2 * F.col("positives").cast(WIDE) * F.col("_start").cast(WIDE)
    pairs = 2 * F.col("positives").cast("double") * F.col("negatives")
    return sums.select(
        user,
        (F.col("positives") + F.col("negatives")).alias("impressions"),
        "positives",
        "negatives",
        F.round(ratio(F.col("_won") - off.cast(WIDE), pairs), 9).alias("auc"),
    )


def gauc(users: DataFrame) -> DataFrame:
    """One row from ``user_auc``: the mean of the users' areas weighted by impressions.

    Users of one class have no area; they are left out and counted with their impressions.
    """
    counts = F.col("auc").isNotNull()
    weight = F.when(counts, F.col("impressions"))
    return users.agg(
        F.count(F.lit(1)).alias("users"),
        rows_where(~counts).alias("one_class_users"),
        F.coalesce(F.sum("impressions"), F.lit(0)).alias("impressions"),
        F.coalesce(F.sum(F.when(~counts, F.col("impressions"))), F.lit(0)).alias("one_class_impressions"),
        F.round(ratio(F.sum(F.col("auc") * weight), F.sum(weight)), 6).alias("gauc"),
    )
