"""Safe ratios, rounding and null-aware aggregates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(a: Column, b: Column) -> Column:
    """a / b as a double; null where b is 0 or null (also under ANSI mode)."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def percent(part: Column, whole: Column, digits: int = 4) -> Column:
    """Rounded percentage; 0.0 when the whole is 0."""
    return F.coalesce(F.round(ratio(part, whole) * 100, digits), F.lit(0.0))


def nulls(c: Column) -> Column:
    return F.count_if(c.isNull())


def rows_where(predicate: Column) -> Column:
    """Count of rows where the predicate is true; null counts as false."""
    return F.count_if(predicate)


def filtered_sum(predicate: Column, value: Column) -> Column:
    return F.coalesce(F.sum(F.when(predicate, value)), F.lit(0)).cast("bigint")


def total(value: Column) -> Column:
    """Sum as a bigint, 0 on no rows."""
    return F.coalesce(F.sum(value), F.lit(0)).cast("bigint")
