"""Table contract, parse-loss and clock-offset checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logassay.functions import clock
from logassay.functions.numeric import filtered_sum, nulls, percent, rows_where, total
from logassay.roles import Roles

# Type names that count as a whole-number or calendar day.
DAY_TYPES = ("tinyint", "smallint", "int", "bigint", "date")
CLOCK_TYPES = ("timestamp_ntz", "timestamp")


def table_contract(df: DataFrame, expected: Sequence[str], roles: Roles) -> DataFrame:
    """One row: exact column set, day and clock types, sizes, and the nulls of both clocks."""
    day, rows = F.col(roles.day), F.col("_rows")
    grain = df.groupBy(roles.day, *roles.pair).agg(
        F.count(F.lit(1)).alias("_rows"), nulls(F.col(roles.wall_time)).alias("_untimed")
    )
    sizes = grain.agg(
        total(rows).alias("rows"),
        F.count_distinct(roles.user).alias("users"),
        F.count_distinct(roles.item).alias("items"),
        filtered_sum(day.isNull(), rows).alias("day_nulls"),
        total(F.col("_untimed")).alias("time_nulls"),
    )
    return with_schema_facts(sizes, df, expected, roles)


def with_schema_facts(
    facts: DataFrame, df: DataFrame, expected: Sequence[str], roles: Roles
) -> DataFrame:
    """Adds what the schema alone tells about the table."""
    types = dict(df.dtypes)
    missing = sorted(set(expected) - set(types))
    surplus = sorted(set(types) - set(expected))
    return facts.select(
        F.lit(len(types)).cast("bigint").alias("columns"),
        F.lit(",".join(missing)).alias("missing"),
        F.lit(",".join(surplus)).alias("surplus"),
        F.lit(types.get(roles.day) in DAY_TYPES).alias("day_typed"),
        F.lit(types.get(roles.wall_time) in CLOCK_TYPES).alias("time_typed"),
        "*",
    )


def null_excess(df: DataFrame, parsed: str, baseline: str) -> DataFrame:
    """Nulls of a parsed column beyond those of a column that is blank on the same rows."""
    lost = F.greatest(F.col("parsed_nulls") - F.col("baseline_nulls"), F.lit(0))
    return (
        df.agg(
            F.count(F.lit(1)).alias("rows"),
            nulls(F.col(parsed)).alias("parsed_nulls"),
            nulls(F.col(baseline)).alias("baseline_nulls"),
        )
        .withColumn("lost_rows", lost)
        .withColumn("lost_pct", percent(F.col("lost_rows"), F.col("rows"), 2))
    )


def is_blank(raw: Column) -> Column:
    return raw.isNull() | (F.trim(raw) == "")


def parse_loss(df: DataFrame, raw: str, parsers: Mapping[str, Column]) -> DataFrame:
    """Per parser: rows whose text was present but whose parsed value is null. One scan."""
    text = F.col(raw)
    counted = df.agg(
        F.count(F.lit(1)).alias("rows"),
        rows_where(is_blank(text)).alias("blank_rows"),
        *[rows_where(~is_blank(text) & p.isNull()).alias(f"lost_{n}") for n, p in parsers.items()],
    )
    each = F.array(
        *[F.struct(F.lit(n).alias("parser"), F.col(f"lost_{n}").alias("lost_rows")) for n in parsers]
    )
    return counted.select("rows", "blank_rows", F.inline(each)).select(
        "parser",
        "rows",
        "blank_rows",
        (F.col("blank_rows") + F.col("lost_rows")).alias("parsed_nulls"),
        "lost_rows",
        percent(F.col("lost_rows"), F.col("rows"), 2).alias("lost_pct"),
    )


def parse_failure_by_length(df: DataFrame, raw: str, parsed: Column) -> DataFrame:
    """Rows and parse failures per text length; the shape of the failure names its cause."""
    text = F.col(raw)
    return (
        df.where(~is_blank(text))
        .groupBy(F.length(text).cast("bigint").alias("raw_length"))
        .agg(F.count(F.lit(1)).alias("rows"), rows_where(parsed.isNull()).alias("failed"))
    )


def _offsets(df: DataFrame, roles: Roles, zone_shift_s: int) -> DataFrame:
    """Rows per distinct (wall clock - epoch) offset, with the deviation from the zone rule.

    Rows are folded on the raw interval; conversions run once per distinct offset.
    """
    wall, utc = F.col(roles.wall_time), clock.epoch_to_clock(F.col(roles.epoch))
    spans = (
        df.where(wall.isNotNull() & F.col(roles.epoch).isNotNull())
        .groupBy((wall - utc).alias("_span"))
        .agg(F.count(F.lit(1)).alias("rows"))
        # An epoch that is no time has no offset; its rows stay, under null.
        .select(clock.interval_micros(F.col("_span")).alias("_us"), "rows")
    )
    deviation = F.abs(F.col("_us") - F.lit(zone_shift_s * 1_000_000))
    return spans.groupBy((F.col("_us") / 1000).cast("bigint").alias("offset_ms")).agg(
        F.sum("rows").alias("rows"),
        F.max(deviation).alias("max_deviation_us"),
        filtered_sum(deviation != 0, F.col("rows")).alias("deviating_rows"),
    )


def offset_profile(df: DataFrame, roles: Roles, zone_shift_s: int = 28_800) -> DataFrame:
    """One row: how many distinct offsets, their range, and the value check against the zone."""
    return _offsets(df, roles, zone_shift_s).agg(
        F.count("offset_ms").alias("distinct_offsets"),
        F.min("offset_ms").alias("min_offset_ms"),
        F.max("offset_ms").alias("max_offset_ms"),
        filtered_sum(F.col("offset_ms").isNotNull(), F.col("rows")).alias("compared_rows"),
        filtered_sum(F.col("offset_ms").isNull(), F.col("rows")).alias("invalid_rows"),
        F.coalesce(F.sum("deviating_rows"), F.lit(0)).alias("deviating_rows"),
        F.max("max_deviation_us").alias("max_deviation_us"),
    )


def first_offsets(df: DataFrame, roles: Roles, zone_shift_s: int = 28_800, n: int = 5) -> DataFrame:
    """The n smallest distinct offsets with their row counts (a top-n report)."""
    return (
        _offsets(df, roles, zone_shift_s)
        .where("offset_ms IS NOT NULL")
        .select("offset_ms", "rows")
        .orderBy("offset_ms")
        .limit(n)
    )
