"""Duplicate forensics: exact copies, repeated pairs, their daily shape and what dedupe removes.

Three grains, each a partial + final hash aggregate, so copies fold together
before any shuffle and one hot row, pair or day never travels whole to a task:

    row_copies   one row per distinct row       (all columns)
    pair_days    one row per (day, user, item)  from row_copies
    pair_totals  one row per (user, item)       from pair_days

All reports below are aggregates of one of these or of the per-day table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logassay.functions import clock
from logassay.functions.keys import comparable
from logassay.functions.numeric import filtered_sum, percent, ratio, total
from logassay.roles import Roles


# ---------------------------------------------------------------- grains


def row_copies(df: DataFrame) -> DataFrame:
    """Distinct rows with their number of copies. Null equals null; maps compare by entries."""
    return df.groupBy(*[comparable(f) for f in df.schema.fields]).agg(F.count(F.lit(1)).alias("copies"))


def pair_days(df: DataFrame, roles: Roles) -> DataFrame:
    """(day, user, item) with all rows and rows left after removing exact copies."""
    return (
        row_copies(df)
        .groupBy(*roles.day_pair)
        .agg(F.sum("copies").alias("rows"), F.count(F.lit(1)).alias("uniq_rows"))
    )


def pair_totals(grain: DataFrame, roles: Roles, peaks: Sequence[int] = ()) -> DataFrame:
    """(user, item) over all days, from ``pair_days``."""
    surplus = F.col("uniq_rows") - 1
    on_peak = F.coalesce(F.col(roles.day).isin(list(peaks)), F.lit(False))
    return grain.groupBy(*roles.pair).agg(
        F.sum("rows").alias("rows"),
        F.sum("uniq_rows").alias("uniq_rows"),
        F.count(F.lit(1)).alias("pair_days"),
        filtered_sum(on_peak, surplus).alias("peak_surplus"),
        filtered_sum(~on_peak, surplus).alias("normal_surplus"),
    )


def daily_from_grain(grain: DataFrame, roles: Roles) -> DataFrame:
    return (
        grain.groupBy(roles.day)
        .agg(
            F.sum("rows").alias("rows"),
            F.sum("uniq_rows").alias("uniq_rows"),
            F.count(F.lit(1)).alias("distinct_pairs"),
            filtered_sum(_repeated(), F.col("rows")).alias("dup_pair_rows"),
            F.count_if(_repeated()).alias("dup_pairs"),
        )
        .withColumn("removed_dups", F.col("rows") - F.col("uniq_rows"))
    )


def daily_dup_structure(df: DataFrame, roles: Roles) -> DataFrame:
    """Per day: rows, rows without exact copies, pairs, and what sits in repeated pairs."""
    return daily_from_grain(pair_days(df, roles), roles)


# ---------------------------------------------------------------- whole-table summaries


def exact_duplicates(df: DataFrame) -> DataFrame:
    """Total rows, distinct rows, and the surplus of exact copies."""
    return (
        row_copies(df)
        .agg(total(F.col("copies")).alias("rows"), F.count(F.lit(1)).alias("uniq_rows"))
        .withColumn("removed_dups", F.col("rows") - F.col("uniq_rows"))
        .withColumn("removed_pct", percent(F.col("removed_dups"), F.col("rows")))
    )


def duplicate_pairs(df: DataFrame, roles: Roles) -> DataFrame:
    """Repeated (user, item) pairs. Rows are rated against rows and pairs against pairs."""
    return (
        df.groupBy(*roles.pair)
        .agg(F.count(F.lit(1)).alias("rows"))
        .agg(
            total(F.col("rows")).alias("total_rows"),
            F.count(F.lit(1)).alias("distinct_pairs"),
            F.count_if(_repeated()).alias("dup_pairs"),
            filtered_sum(_repeated(), F.col("rows")).alias("dup_pair_rows"),
            F.max("rows").alias("max_repeat"),
        )
        .withColumn("dup_rows_pct", percent(F.col("dup_pair_rows"), F.col("total_rows")))
        .withColumn("dup_pairs_pct", percent(F.col("dup_pairs"), F.col("distinct_pairs")))
    )


def summary_from_grain(grain: DataFrame, roles: Roles, peaks: Sequence[int] = ()) -> DataFrame:
    """One row with every whole-table duplicate figure, from ``pair_days``."""
    return pair_totals(grain, roles, peaks).agg(
        total(F.col("rows")).alias("total_rows"),
        total(F.col("uniq_rows")).alias("uniq_rows"),
        total(F.col("pair_days")).alias("pair_days"),
        F.count(F.lit(1)).alias("distinct_pairs"),
        F.count_if(_repeated()).alias("dup_pairs"),
        filtered_sum(_repeated(), F.col("rows")).alias("dup_pair_rows"),
        F.max("rows").alias("max_repeat"),
        total(F.col("peak_surplus")).alias("peak_pair_removed"),
        total(F.col("normal_surplus")).alias("normal_pair_removed"),
    )


def dup_summary(
    df: DataFrame, roles: Roles, expected: Mapping[str, int] | None = None
) -> DataFrame:
    """Whole-table duplicate figures; ``reproduced`` tells whether expected constants came out."""
    found = summary_from_grain(pair_days(df, roles), roles).select(
        "total_rows",
        "uniq_rows",
        (F.col("total_rows") - F.col("uniq_rows")).alias("removed_dups"),
        "distinct_pairs",
        "dup_pairs",
        "dup_pair_rows",
        "max_repeat",
    )
    if expected is None:
        return found
    same = F.lit(True)
    for name, value in expected.items():
        same = same & (F.col(name) == value)
    return found.withColumn("reproduced", same)


def ladder_facts(summary: DataFrame) -> DataFrame:
    """``summary_from_grain`` plus the rows removed by each stage."""
    return summary.select(
        "*",
        (F.col("total_rows") - F.col("uniq_rows")).alias("exact_removed"),
        (F.col("uniq_rows") - F.col("pair_days")).alias("within_day_removed"),
        (F.col("pair_days") - F.col("distinct_pairs")).alias("cross_day_removed"),
        (F.col("total_rows") - F.col("distinct_pairs")).alias("all_removed"),
    )


def ladder_adds_up() -> Column:
    """Stages sum to the whole, and the peak / normal split sums to the within-day stage."""
    stages = F.col("exact_removed") + F.col("within_day_removed") + F.col("cross_day_removed")
    split = F.col("peak_pair_removed") + F.col("normal_pair_removed")
    return (stages == F.col("all_removed")) & (split == F.col("within_day_removed"))


def dedup_ladder(df: DataFrame, roles: Roles, peaks: Sequence[int] = ()) -> DataFrame:
    """Four rows: raw, then after exact, within-day pair and global pair dedupe."""
    facts = ladder_facts(summary_from_grain(pair_days(df, roles), roles, peaks))
    return ladder_rows(facts)


def ladder_rows(facts: DataFrame) -> DataFrame:
    def step(i: int, name: str, removed: Column, left: str) -> Column:
        return F.struct(
            F.lit(i).alias("step"),
            F.lit(name).alias("stage"),
            removed.cast("bigint").alias("removed_rows"),
            F.col(left).alias("remaining_rows"),
        )

    steps = F.array(
        step(0, "raw", F.lit(0), "total_rows"),
        step(1, "exact copies", F.col("exact_removed"), "uniq_rows"),
        step(2, "pair within a day", F.col("within_day_removed"), "pair_days"),
        step(3, "pair over all days", F.col("cross_day_removed"), "distinct_pairs"),
    )
    return facts.select(F.inline(steps), ladder_adds_up().alias("adds_up"))


def control_duplicates(df: DataFrame, roles: Roles, days: Sequence[int] = ()) -> DataFrame:
    """Rows, exact copies and repeated pairs overall and on each listed day."""
    days = list(dict.fromkeys(days))
    grain = pair_days(df, roles)

    def on(d: int) -> Column:
        return F.coalesce(F.col(roles.day) == d, F.lit(False))

    per_pair = grain.groupBy(*roles.pair).agg(
        F.sum("rows").alias("r"),
        F.sum("uniq_rows").alias("u"),
        *[filtered_sum(on(d), F.col("rows")).alias(f"r{d}") for d in days],
        *[filtered_sum(on(d), F.col("uniq_rows")).alias(f"u{d}") for d in days],
    )
    marks = ["", *[str(d) for d in days]]
    sums = per_pair.agg(
        *[total(F.col(f"r{m}")).alias(f"r{m}") for m in marks],
        *[total(F.col(f"u{m}")).alias(f"u{m}") for m in marks],
        *[F.count_if(F.col(f"r{m}") > 1).alias(f"p{m}") for m in marks],
    )
    scopes = F.array(
        *[
            F.struct(
                F.lit(m or "all").alias("scope"),
                F.col(f"r{m}").alias("rows"),
                (F.col(f"r{m}") - F.col(f"u{m}")).alias("removed_dups"),
                F.col(f"p{m}").alias("dup_pairs"),
            )
            for m in marks
        ]
    )
    return sums.select(F.inline(scopes))


# ---------------------------------------------------------------- reports on the per-day table


def pair_value_conflicts(daily: DataFrame, roles: Roles) -> DataFrame:
    """Per day: rows of a pair that differ in value, i.e. not explained by exact copies."""
    conflicts = F.col("uniq_rows") - F.col("distinct_pairs")
    return daily.select(
        roles.day,
        "rows",
        conflicts.alias("conflict_rows"),
        percent(conflicts, F.col("rows"), 3).alias("conflict_pct"),
    )


def repeat_intensity(daily: DataFrame, roles: Roles) -> DataFrame:
    """Per day: mean rows per repeated pair. Double writes pull it toward 2."""
    return daily.select(
        roles.day,
        "dup_pairs",
        "dup_pair_rows",
        F.round(ratio(F.col("dup_pair_rows"), F.col("dup_pairs")), 3).alias("rows_per_dup_pair"),
    )


def double_write_days(daily: DataFrame, roles: Roles) -> DataFrame:
    """Per day: does every row sit in a repeated pair, and are rows exactly doubled."""
    return daily.select(
        roles.day,
        "rows",
        "removed_dups",
        "dup_pair_rows",
        (F.col("dup_pair_rows") == F.col("rows")).alias("all_in_dup_pairs"),
        (F.col("removed_dups") * 2 == F.col("rows")).alias("exactly_doubled"),
    )


def peak_days(daily: DataFrame, roles: Roles) -> DataFrame:
    """The top day by copies, raw rows and distinct rows; a tie goes to the earliest day."""
    metrics = ("removed_dups", "rows", "uniq_rows")
    day = F.col(roles.day)
    tops = daily.where(day.isNotNull()).agg(
        *[F.max_by(day, F.struct(F.col(m), -day)).alias(f"{m}_day") for m in metrics],
        *[F.max(m).alias(m) for m in metrics],
    )
    each = F.array(
        *[
            F.struct(
                F.lit(m).alias("metric"),
                F.col(f"{m}_day").alias("peak_day"),
                F.col(m).alias("peak_value"),
            )
            for m in metrics
        ]
    )
    return tops.select(F.inline(each))


def calendar_neighbours(peaks: Sequence[int]) -> dict[int, tuple[int, ...]]:
    """The days before and after each listed day."""
    from datetime import datetime, timedelta

    around = {}
    for p in peaks:
        d = datetime.strptime(str(p), "%Y%m%d")
        around[p] = tuple(int((d + timedelta(days=s)).strftime("%Y%m%d")) for s in (-1, 1))
    return around


def peak_neighbors(
    daily: DataFrame,
    roles: Roles,
    peaks: Sequence[int] | Mapping[int, Sequence[int]],
    tolerance: float = 0.20,
) -> DataFrame:
    """Per listed day: are both neighbours free of copies, and is the deduped day like them.

    The listed days are parameters, so all of them are one aggregate over the day table.
    """
    around = peaks if isinstance(peaks, Mapping) else calendar_neighbours(peaks)
    day = F.col(roles.day)
    aggregates = []
    for p, near in around.items():
        beside = day.isin(list(near))
        aggregates += [
            F.max(F.when(day == p, F.col("uniq_rows"))).alias(f"u{p}"),
            F.count_if(beside).alias(f"n{p}"),
            filtered_sum(beside, F.col("removed_dups")).alias(f"r{p}"),
            F.avg(F.when(beside, F.col("uniq_rows"))).alias(f"m{p}"),
        ]
    each = []
    for p, near in around.items():
        mean = F.col(f"m{p}")
        deviation = ratio(F.abs(F.col(f"u{p}") - mean), mean)
        clean = (F.col(f"n{p}") == len(near)) & (F.col(f"r{p}") == 0)
        each.append(
            F.struct(
                F.lit(p).cast("bigint").alias("peak_day"),
                F.col(f"u{p}").alias("uniq_rows"),
                F.col(f"n{p}").alias("neighbours_found"),
                F.col(f"r{p}").alias("neighbours_removed"),
                F.round(mean, 4).alias("neighbour_mean"),
                F.round(deviation, 6).alias("deviation"),
                clean.alias("neighbours_clean"),
                F.coalesce(deviation <= tolerance, F.lit(False)).alias("close_to_neighbours"),
            )
        )
    return daily.agg(*aggregates).select(F.inline(F.array(*each)))


def neighbour_deviation(daily: DataFrame, roles: Roles, column: str = "uniq_rows") -> DataFrame:
    """For every day: mean of the calendar days beside it and the relative deviation from it.

    Only days that exist have neighbours; impossible ones are reported with none.
    They are partitioned apart from the valid days, each on its own, so the window
    over the calendar holds one row per valid day.
    """
    number = F.datediff(clock.day_key_to_date(F.col(roles.day)), F.lit("1970-01-01").cast("date"))
    known = daily.where(F.col(roles.day).isNotNull()).withColumn("_d", number)
    own = F.when(F.col("_d").isNull(), F.col(roles.day))
    around = Window.partitionBy(own).orderBy("_d").rangeBetween(-1, 1)
    dated = F.col("_d").isNotNull()
    others = F.when(dated, F.count(F.lit(1)).over(around) - 1).otherwise(0).cast("bigint")
    rest = F.sum(column).over(around) - F.col(column)
    mean = F.when(dated, ratio(rest, others))
    return known.select(
        roles.day,
        F.col(column),
        others.alias("neighbours"),
        F.round(mean, 4).alias("neighbour_mean"),
        F.round(ratio(F.abs(F.col(column) - mean), mean), 6).alias("deviation"),
    )


def outlier_ratio(daily: DataFrame, roles: Roles, limit: float = 2.0) -> DataFrame:
    """Largest day over the median day, before and after removing exact copies."""
    known = daily.where(F.col(roles.day).isNotNull())
    facts = known.agg(
        F.max("rows").alias("max_rows"),
        F.median("rows").alias("median_rows"),
        F.max("uniq_rows").alias("max_uniq"),
        F.median("uniq_rows").alias("median_uniq"),
    )
    after = ratio(F.col("max_uniq"), F.col("median_uniq"))
    return facts.select(
        "*",
        F.round(ratio(F.col("max_rows"), F.col("median_rows")), 6).alias("ratio_before"),
        F.round(after, 6).alias("ratio_after"),
        F.coalesce(after <= limit, F.lit(False)).alias("no_outlier_after"),
    )


def dup_localization(daily: DataFrame, roles: Roles, peaks: Sequence[int]) -> DataFrame:
    """Do the listed days hold all exact copies, and does pair dedupe reach beyond them."""
    on_peak = F.coalesce(F.col(roles.day).isin(list(peaks)), F.lit(False))
    surplus = F.col("uniq_rows") - F.col("distinct_pairs")
    facts = daily.agg(
        total(F.col("removed_dups")).alias("removed_dups"),
        filtered_sum(on_peak, F.col("removed_dups")).alias("peak_removed"),
        filtered_sum(~on_peak, F.col("removed_dups")).alias("other_removed"),
        total(F.col("rows") - F.col("distinct_pairs")).alias("pair_removed"),
        filtered_sum(on_peak, surplus).alias("peak_pair_removed"),
        filtered_sum(~on_peak, surplus).alias("other_pair_removed"),
    )
    return facts.select(
        "*",
        percent(F.col("other_pair_removed"), F.col("pair_removed"), 2).alias("other_pair_pct"),
        ((F.col("other_removed") == 0) & (F.col("peak_removed") == F.col("removed_dups"))).alias(
            "copies_localized"
        ),
        (F.col("other_pair_removed") > 0).alias("pair_dedupe_spreads"),
    )


def _repeated() -> Column:
    return F.col("rows") > 1
