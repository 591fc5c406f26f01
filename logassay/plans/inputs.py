"""Interaction logs derived from the driver's tables, always from all of their rows.

``log``       events as an exposure log with natural defects and two double-write days
``control``   the same events without double writes; rows of one kind have no time at all
``grid``      (user, event type): an almost fully observed matrix
``purchases`` lineitem with orders: (customer, part) with the order date as day
``raw_log``   ``log`` as the text cells of a CSV file
``damaged_cells``  ``control`` as text cells, some of them spoiled
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logassay.functions import clock
from logassay.functions.numeric import ratio
from logassay.roles import Roles

ROLES = Roles()
PURCHASE_ROLES = Roles(user="user_id", item="item_id", numerator="quantity", denominator="price")
GRID_ROLES = Roles(user="user_id", item="event_type")

ZONE_SHIFT_S = 28_800
# Fixed values of the views: which local days are moved on, and which are written twice.
OUTAGES = (("2024-01-11", 3), ("2024-01-21", 7))
PARTIAL_DOUBLE, WHOLE_DOUBLE = 20240105, 20240117
PEAKS = (PARTIAL_DOUBLE, WHOLE_DOUBLE)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _exposures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events with log columns plus the event kind. Days after an outage are moved on."""
    events = table(spark, sf_dir, "events")
    ts = F.col("ts").cast("timestamp_ntz")
    local = ts + F.expr("INTERVAL 8 HOURS")
    moved = F
    for start, days in reversed(OUTAGES):
        moved = moved.when(local >= F.expr(f"TIMESTAMP_NTZ '{start} 00:00:00'"), days)
    millis = F.floor(clock.epoch_micros(ts) / 1000).cast("bigint") + moved.otherwise(0) * 86_400_000
    item = F.regexp_extract("props", "([0-9]+)", 1).cast("bigint")
    length = F.when(F.col("event_type") != "signup", item * 250)
    played = F.floor(F.col("value") * 100).cast("bigint")
    utc = clock.from_epoch_millis(F.col("millis"))
    wall = clock.from_epoch_millis(F.col("millis") + ZONE_SHIFT_S * 1000)
    exact = ratio(played, length)
    return (
        events.select(
            F.col("event_type").alias("kind"),
            "user_id",
            item.alias("item_id"),
            played.alias("played_ms"),
            length.alias("length_ms"),
            millis.alias("millis"),
            # One kind stores its ratio cut to one decimal.
            F.when(F.col("event_type") == "error", F.floor(exact * 10) / 10).otherwise(exact).alias("ratio"),
        )
        .withColumn("wall_time", wall)
        # The same kind stamps the UTC day instead of the local one.
        .withColumn("day", clock.day_key(F.when(F.col("kind") == "error", utc).otherwise(wall)))
        .withColumn("epoch_s", F.col("millis").cast("double") / F.lit(1000.0))
    )


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exposure log. One day is written twice; on another, some kinds are, one of them altered."""
    partial = F.col("day") == PARTIAL_DOUBLE
    copies = F.when(F.col("day") == WHOLE_DOUBLE, 2).when(
        partial & F.col("kind").isin("view", "click", "purchase"), 2
    ).otherwise(1)
    altered = F.when(partial & (F.col("kind") == "purchase"), F.col("copy")).otherwise(0)
    return (
        _exposures(spark, sf_dir)
        .withColumn("copy", F.explode(F.sequence(F.lit(0), copies - 1)))
        .withColumn("played_ms", F.col("played_ms") + altered)
        .select(*ROLES.columns)
    )


def control(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events without double writes; sign-ups carry no clock, day or epoch."""
    timed = F.col("kind") != "signup"
    return (
        _exposures(spark, sf_dir)
        .withColumns({c: F.when(timed, F.col(c)) for c in ("wall_time", "day", "epoch_s")})
        .select(*ROLES.columns)
    )


def grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("user_id", "event_type")


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount"
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("item_id"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("wall_time"),
        clock.day_key(F.col("o_orderdate")).alias("day"),
        F.col("l_discount").alias("ratio"),
    )


def order_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(clock.day_key(F.col("o_orderdate")).alias("day"))


def ship_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(clock.day_key(F.col("l_shipdate")).alias("day"))


def raw_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``log`` as text cells: the clock keeps only the fraction digits it needs."""
    frame = log(spark, sf_dir)
    return frame.select(*[F.col(c).cast("string").alias(c) for c in frame.columns])


def damaged_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``control`` as text cells with spoiled days, clocks and epochs; its blanks stay blank."""
    frame = control(spark, sf_dir)
    text = frame.select(*[F.col(c).cast("string").alias(c) for c in frame.columns])
    turn = F.col("user_id").cast("bigint") % 11
    day = F.col("day")
    spoiled = (
        F.when(day.isNull(), day)
        .when(turn == 1, "1e30")
        .when(turn == 2, "NaN")
        .when(turn == 3, F.concat(day, F.lit(".7")))
        .when(turn == 4, F.concat(day, F.lit(".0")))
        .when(turn == 5, F.concat(F.lit("2024023"), (F.col("item_id").cast("bigint") % 3).cast("string")))
        .otherwise(day)
    )
    epoch = F.col("epoch_s")
    off = (
        F.when(epoch.isNull(), epoch)
        .when(turn == 6, "NaN")
        .when(turn == 7, "1e300")
        .when(turn == 8, "Infinity")
        .otherwise(epoch)
    )
    clock_cell = F.when(F.col("wall_time").isNotNull() & (turn == 9), "no clock").otherwise(F.col("wall_time"))
    return text.withColumns({"day": spoiled, "epoch_s": off, "wall_time": clock_cell})
