"""Clock and calendar expressions.

Everything works on TIMESTAMP_NTZ and plain intervals, so no result depends on
``spark.sql.session.timeZone`` (TIMESTAMPDIFF and DATE_TRUNC convert NTZ input
through the session zone and lose an hour at daylight-saving changes).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"
DAY_SECONDS = 86_400
# A day inside years 1 and 9999 on either side, so that no zone shift leaves them.
EPOCH_RANGE = (-62_135_510_400.0, 253_402_214_399.0)

# Fixed value: 'YYYY-MM-DD hh:mm:ss' with an optional fraction of any length.
WALL_CLOCK_PATTERN = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}(\.\d+)?$"


def parse_wall_clock(raw: Column) -> Column:
    """String to TIMESTAMP_NTZ with any number of fraction digits; bad text gives null.

    Spark keeps microseconds; further digits are cut.
    """
    return F.when(raw.rlike(WALL_CLOCK_PATTERN), raw.try_cast("timestamp_ntz"))


def parse_fixed_fraction(raw: Column, digits: int) -> Column:
    """As ``parse_wall_clock`` but only for exactly ``digits`` fraction digits.

    The narrow format that silently loses rows; kept so its loss can be measured.
    """
    return F.when(raw.rlike(rf"\.\d{{{digits}}}$"), parse_wall_clock(raw))


def interval_micros(span: Column) -> Column:
    """Microseconds of a day-time interval (the difference of two timestamps)."""
    return (span.cast("interval second").cast("decimal(18,6)") * F.lit(1_000_000)).cast("bigint")


def epoch_micros(ts: Column) -> Column:
    """Microseconds since 1970-01-01 of a zone-less timestamp."""
    minutes = F.unix_date(ts.cast("date")).cast("bigint") * 1440 + F.hour(ts) * 60 + F.minute(ts)
    fraction = F.extract(F.lit("SECOND"), ts) * F.lit(1_000_000)
    return minutes * 60_000_000 + fraction.cast("bigint")


def from_epoch_millis(millis: Column) -> Column:
    return F.timestamp_add("MILLISECOND", millis, F.expr(EPOCH))


def valid_epoch(epoch_s: Column) -> Column:
    """Seconds of a day in years 1 to 9999. NaN, infinities and anything beyond are not."""
    return F.coalesce(epoch_s.between(*EPOCH_RANGE), F.lit(False))


def epoch_to_clock(epoch_s: Column) -> Column:
    """UTC seconds with fraction to a timestamp, rounded to milliseconds; null when not valid."""
    sound = F.when(valid_epoch(epoch_s), epoch_s)
    return from_epoch_millis(F.round(sound * 1000).cast("bigint"))


def epoch_to_clock_seconds(epoch_s: Column, shift_s: int = 0) -> Column:
    """UTC seconds plus a zone shift to a timestamp, fraction cut off; null when not valid."""
    sound = F.when(valid_epoch(epoch_s), epoch_s)
    return F.timestamp_add("SECOND", (sound + F.lit(shift_s)).cast("bigint"), F.expr(EPOCH))


def micros_between(later: Column, earlier: Column) -> Column:
    return interval_micros(later - earlier)


def millis_between(later: Column, earlier: Column) -> Column:
    """Whole milliseconds, cut toward zero."""
    return (micros_between(later, earlier) / 1000).cast("bigint")


def day_key(ts: Column) -> Column:
    """Timestamp or date to a YYYYMMDD integer."""
    return (F.year(ts) * 10000 + F.month(ts) * 100 + F.day(ts)).cast("bigint")


def day_key_to_date(key: Column) -> Column:
    """YYYYMMDD integer to a date; an impossible day gives null. Arithmetic only, no parsing."""
    year = F.floor(key / 10000).cast("int")
    month = F.floor(F.pmod(key, F.lit(10000)) / 100).cast("int")
    day = F.pmod(key, F.lit(100)).cast("int")
    zero = F.lit(0)
    start = F.try_make_timestamp_ntz(year, month, day, zero, zero, zero.cast("decimal(16,6)"))
    return F.when(key.between(10000101, 99991231), start.cast("date"))
