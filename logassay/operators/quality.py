"""Row-level consistency checks. Each is one scan and one map-side aggregate, no shuffle of rows.

The ``*_counts`` functions return the aggregate columns so that an audit can
put several checks into a single scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logassay.functions import clock
from logassay.functions.numeric import nulls, percent, ratio, rows_where
from logassay.functions.text import invalid_utf8
from logassay.roles import Roles


def ratio_counts(roles: Roles, tolerance: float = 0.01) -> list[Column]:
    num, den, stored = F.col(roles.numerator), F.col(roles.denominator), F.col(roles.ratio)
    eligible = num.isNotNull() & stored.isNotNull() & (den > 0)
    off = F.abs(ratio(num, den) - stored) > tolerance
    return [
        rows_where(eligible).alias("ratio_eligible"),
        rows_where(eligible & off).alias("ratio_mismatch"),
    ]


def ratio_consistency(df: DataFrame, roles: Roles, tolerance: float = 0.01) -> DataFrame:
    """Stored ratio against numerator / denominator where the denominator is positive."""
    return _rated(df.agg(*ratio_counts(roles, tolerance)), "ratio")


def clock_counts(roles: Roles) -> list[Column]:
    wall, day = F.col(roles.wall_time), F.col(roles.day)
    both = wall.isNotNull() & day.isNotNull()
    return [
        rows_where(both).alias("clock_eligible"),
        rows_where(both & (clock.day_key(wall) != day)).alias("clock_mismatch"),
    ]


def date_time_consistency(df: DataFrame, roles: Roles) -> DataFrame:
    """Day column against the calendar day of the wall clock."""
    return _rated(df.agg(*clock_counts(roles)), "clock")


def epoch_counts(roles: Roles, zone_shift_s: int = 28_800) -> list[Column]:
    epoch, day = F.col(roles.epoch), F.col(roles.day)
    sound = clock.valid_epoch(epoch)
    both = sound & day.isNotNull()
    local_day = clock.day_key(clock.epoch_to_clock_seconds(epoch, zone_shift_s))
    return [
        rows_where(both).alias("epoch_eligible"),
        rows_where(both & (local_day != day)).alias("epoch_mismatch"),
        rows_where(epoch.isNotNull() & ~sound).alias("epoch_invalid"),
    ]


def epoch_date_consistency(df: DataFrame, roles: Roles, zone_shift_s: int = 28_800) -> DataFrame:
    """Day column against the zone-shifted calendar day of the epoch column."""
    return _rated(df.agg(*epoch_counts(roles, zone_shift_s)), "epoch")


def over_counts(roles: Roles) -> list[Column]:
    num, den = F.col(roles.numerator), F.col(roles.denominator)
    valid = num.isNotNull() & (den > 0)
    return [
        rows_where(valid).alias("over_eligible"),
        rows_where(valid & (num > den)).alias("over_rows"),
    ]


def over_duration(df: DataFrame, roles: Roles) -> DataFrame:
    """Rows whose numerator exceeds a positive denominator."""
    return df.agg(*over_counts(roles)).withColumn(
        "over_pct", percent(F.col("over_rows"), F.col("over_eligible"))
    )


def denominator_counts(roles: Roles) -> list[Column]:
    den = F.col(roles.denominator)
    return [
        F.count(F.lit(1)).alias("rows"),
        rows_where(den == 0).alias("zero_rows"),
        nulls(den).alias("null_rows"),
    ]


def zero_denominator(df: DataFrame, roles: Roles) -> DataFrame:
    """Zero and null denominators."""
    return df.agg(*denominator_counts(roles)).withColumn(
        "zero_pct", percent(F.col("zero_rows"), F.col("rows"))
    )


def utf8_validity(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per text column: rows, nulls and values that are not valid UTF-8. Whole texts, one scan."""
    counted = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[nulls(F.col(c)).alias(f"n_{i}") for i, c in enumerate(columns)],
        *[rows_where(invalid_utf8(F.col(c))).alias(f"bad_{i}") for i, c in enumerate(columns)],
    )
    each = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.col(f"n_{i}").alias("null_rows"),
                F.col(f"bad_{i}").alias("invalid_rows"),
            )
            for i, c in enumerate(columns)
        ]
    )
    return counted.select("rows", F.inline(each))


def _rated(facts: DataFrame, name: str) -> DataFrame:
    return facts.withColumn(
        f"{name}_pct", percent(F.col(f"{name}_mismatch"), F.col(f"{name}_eligible"))
    )
