"""Negative samples: items a user never touched, drawn by popularity within strata.

Items are put in order of their users and cut into strata of equal exposure:
few items in the first, many in the last. Per user and stratum a quota is drawn
without replacement, an item with a chance in proportion to its users. Draw
number t of a user in a stratum is a hash of (seed, user, stratum, t), taken as
a place in the stratum's cumulative popularity; the item that lies there counts
unless the user touched it or an earlier draw gave it. So a sample depends on the
seed alone, not on partitions, and another engine gives the same rows.

Draws find their item by the bin of the place, a key of which an item holds as
many as its share, so no key is hot. Touched items are taken out by an anti join
on the pair, which spreads a user with a third of the log.

``draws`` draws are made for each item of the quota. Who touched most of a
stratum may still lack some; they get the rest, in the order of a hash of
(seed, user, item), from what is left of the stratum (``drawn`` is false).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logassay.operators.order import running_sums
from logassay.roles import Roles
from logassay.sources.scratch import materialize

DIGITS = 15  # hexadecimal digits of a hash that make its number


def hashed(*parts: Column) -> Column:
    """A number of 60 bits from the parts, the same in any engine that knows MD5."""
    text = F.concat_ws(":", *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, DIGITS), 16, 10).cast("long")


def popularity_strata(touched: DataFrame, strata: int) -> DataFrame:
    """i, users, stratum, start: where the item lies in its stratum's cumulative users.

    ``touched`` holds distinct (u, i). Items are ordered by users, most first, and
    belong to the stratum their cumulative share begins in.
    """
    items = touched.groupBy("i").agg(F.count(F.lit(1)).alias("users"))
    items = running_sums(items, [F.desc("users"), F.col("i")], {"before": "users"})
    total = items.agg(F.sum("users").alias("total")).first()["total"] or 1
    placed = items.withColumn("stratum", F.expr(f"before * {strata} div {total}").cast("int"))
    starts = placed.groupBy("stratum").agg(F.min("before").alias("_first"))
    # One row for each stratum.
    return placed.join(F.broadcast(starts), "stratum").select(
        "i", "users", "stratum", (F.col("before") - F.col("_first")).alias("start")
    )


def negative_samples(
    df: DataFrame, roles: Roles, quotas: Sequence[int], seed: int, draws: int = 8
) -> DataFrame:
    """user, stratum (0 the most popular), item, rank (from 1 within the stratum) and drawn.

    Users are those with a touched item; a user who has touched the whole stratum
    but for fewer than its quota gets what there is.
    """
    known = F.col(roles.user).isNotNull() & F.col(roles.item).isNotNull()
    touched = materialize(
        df.where(known).select(F.col(roles.user).alias("u"), F.col(roles.item).alias("i")).distinct(), "touched"
    )
    items = materialize(popularity_strata(touched, len(quotas)), "strata")
    sizes = items.groupBy("stratum").agg(F.sum("users").alias("weight"), F.count(F.lit(1)).alias("items"))
    quota = F.element_at(F.array(*[F.lit(q) for q in quotas]), F.col("stratum") + 1)
    sizes = F.broadcast(sizes.withColumn("quota", quota).withColumn("width", F.ceil(F.col("weight") / F.col("items"))))

    users = touched.select("u").distinct()
    wanted = users.select("u", F.explode(F.sequence(F.lit(0), F.lit(len(quotas) - 1))).alias("stratum")).join(
        sizes, "stratum"
    ).where("quota > 0")
    tries = wanted.select("u", "stratum", "weight", "width", "quota", F.explode(F.sequence(F.lit(1), F.col("quota") * draws)).alias("t"))
    place = F.pmod(hashed(F.lit(seed), F.col("u"), F.col("stratum"), F.col("t")), F.col("weight"))
    tries = tries.withColumn("place", place).withColumn("bin", F.expr("place div width"))
    bins = items.join(sizes, "stratum").select(
        "stratum", "i", "start", "users",
        F.explode(F.expr("sequence(start div width, (start + users - 1) div width)")).alias("bin"),
    )
    met = tries.join(bins, ["stratum", "bin"]).where("place >= start AND place < start + users")
    new = met.join(touched, ["u", "i"], "left_anti").groupBy("u", "stratum", "quota", "i").agg(F.min("t").alias("t"))
    order = Window.partitionBy("u", "stratum").orderBy("t")
    drawn = materialize(
        new.withColumn("rank", F.row_number().over(order)).where("rank <= quota").select("u", "stratum", "i", "rank"),
        "drawn",
    )

    left = items.select("i", "stratum").join(touched, "i").groupBy("u", "stratum").agg(F.count(F.lit(1)).alias("own"))
    got = drawn.groupBy("u", "stratum").agg(F.count(F.lit(1)).alias("got"))
    lack = (
        wanted.join(left, ["u", "stratum"], "left")
        .join(got, ["u", "stratum"], "left")
        .fillna(0, ["own", "got"])
        .withColumn("lack", F.least("quota", F.col("items") - F.col("own")) - F.col("got"))
        .where("lack > 0")
        .select("u", "stratum", "got", "lack")
    )
    # Only users whose draws met touched items again and again: they own most of the stratum.
    rest = (
        lack.join(items.select("i", "stratum"), "stratum")
        .join(touched, ["u", "i"], "left_anti")
        .join(drawn, ["u", "stratum", "i"], "left_anti")
    )
    by_hash = Window.partitionBy("u", "stratum").orderBy(hashed(F.lit(seed), F.col("u"), F.col("i")), "i")
    filled = rest.withColumn("_n", F.row_number().over(by_hash)).where("_n <= lack")
    filled = filled.select("u", "stratum", "i", (F.col("got") + F.col("_n")).cast("int").alias("rank"), F.lit(False).alias("drawn"))
    return (
        drawn.withColumn("drawn", F.lit(True))
        .unionByName(filled)
        .select(F.col("u").alias(roles.user), "stratum", F.col("i").alias(roles.item), "rank", "drawn")
    )
