"""Training samples from logs: sliding windows with targets, and runs of events as text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logassay.functions import clock
from logassay.operators.order import positions
from logassay.operators.sequences import with_run
from logassay.roles import Roles


def sliding_samples(
    df: DataFrame, roles: Roles, start: int, length: int, step: int, horizon: int
) -> DataFrame:
    """One row per user and window: what the user did in ``length`` days, and in the ``horizon`` days after.

    Windows begin every ``step`` days from day ``start`` (YYYYMMDD) on; ``length``
    and ``horizon`` are multiples of ``step``. Events are folded once to
    (user, step); a window is put together from the folded steps, so an event is
    counted once however many windows overlap it. Only windows that end, with
    their horizon, within the log's days are given, and only to users with an
    event in the window's days. Rows without a valid day take no part.
    """
    if step < 1 or length < step or length % step or horizon % step:
        raise ValueError("length and horizon must be multiples of step")
    wide, after = length // step, horizon // step
    first = clock.day_key_to_date(F.lit(start))
    days = df.where(F.col(roles.user).isNotNull()).groupBy(roles.user, roles.day).agg(
        F.count(F.lit(1)).alias("events"),
        F.coalesce(F.sum(roles.numerator), F.lit(0)).alias("played"),
    )
    days = days.withColumn("_n", F.datediff(clock.day_key_to_date(F.col(roles.day)), first)).where("_n >= 0")
    steps = days.groupBy(roles.user, F.expr(f"_n div {step}").alias("_s")).agg(
        F.sum("events").alias("events"),
        F.count(F.lit(1)).alias("days"),
        F.sum("played").alias("played"),
        F.max(roles.day).alias("last_day"),
        F.max("_n").alias("_last"),
    )
    end = days.agg(F.max("_n").alias("_end"))
    # A step is the (s - w)-th of window w; the last ``after`` of them are the target.
    windows = F.expr(f"sequence(greatest(_s - {wide + after - 1}, 0L), _s)")
    dealt = steps.withColumn("_w", F.explode(windows))
    seen = F.col("_s") - F.col("_w") < wide
    folded = dealt.groupBy(roles.user, "_w").agg(
        F.sum(F.when(seen, F.col("events"))).alias("events"),
        F.sum(F.when(seen, F.col("days"))).alias("active_days"),
        F.sum(F.when(seen, F.col("played"))).alias("played"),
        F.max(F.when(seen, F.col("last_day"))).alias("last_day"),
        F.coalesce(F.sum(F.when(~seen, F.col("events"))), F.lit(0)).alias("target_events"),
        F.coalesce(F.sum(F.when(~seen, F.col("played"))), F.lit(0)).alias("target_played"),
    )
    whole = F.col("_w") * step + length + horizon - 1 <= F.lit(end.first()["_end"])
    return folded.where(F.col("events").isNotNull() & whole).select(
        roles.user,
        clock.day_key(F.date_add(first, (F.col("_w") * step).cast("int"))).alias("first_day"),
        "events", "active_days", "played", "last_day", "target_events", "target_played",
    )


def sequence_texts(df: DataFrame, roles: Roles, size: int) -> DataFrame:
    """user, segment, part, events, first_time, last_time and text: runs of events told in parts.

    A user's run of days is told event by event, in the order of time, item and
    measures, as ``item:percent`` (``?`` without a ratio); parts hold ``size``
    events, so a user with a third of the log is many rows. Events are numbered by
    a range-partitioned sort, and no task or row ever holds a whole run. Events
    without a valid day or user are left out (``sequence_losses`` counts them).
    """
    told = F.concat_ws(
        ":", F.coalesce(F.col(roles.item).cast("string"), F.lit("?")),
        F.coalesce(F.floor(F.col(roles.ratio) * 100).cast("string"), F.lit("?")),
    )
    keys = [roles.user, "segment"]
    fine = [F.col(c).asc_nulls_first() for c in (roles.wall_time, roles.item, roles.ratio)]
    rows = with_run(df, roles, roles.ratio).where(F.col("segment").isNotNull() & F.col(roles.user).isNotNull())
    rows = rows.select(*keys, roles.wall_time, roles.item, roles.ratio, told.alias("_told"))
    placed = positions(rows, [*[F.col(k) for k in keys], *fine], "_at", salt=F.xxhash64(F.monotonically_increasing_id()))
    starts = placed.groupBy(*keys).agg(F.min("_at").alias("_start"))
    number = F.col("_at") - F.col("_start")
    parts = placed.join(starts, keys).select(
        *keys, F.expr(f"(_at - _start) div {size}").alias("part"), number.alias("_n"), roles.wall_time, "_told"
    )
    return (
        parts.groupBy(*keys, "part")
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.min(roles.wall_time).alias("first_time"),
            F.max(roles.wall_time).alias("last_time"),
            F.array_sort(F.collect_list(F.struct("_n", "_told"))).alias("_l"),
        )
        .select(*keys, "part", "events", "first_time", "last_time",
                F.concat_ws(" ", F.transform("_l", lambda x: x["_told"])).alias("text"))
    )
