"""The five acceptance suites: facts from few passes, then rules over them.

Thresholds are parameters fixed before a run. All suites about one log share an
``Audit``: the log is read once for the (day, user, item) grain, once for all
row-level counts and once for the clock offsets. Sizes, tails, daily counts,
segments and every duplicate figure then come from the grain or the day table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logassay.functions.numeric import nulls
from logassay.operators import calendar, contract, duplicates, profile, quality
from logassay.operators.verdict import Rule, merge_facts
from logassay.roles import Roles
from logassay.sources.scratch import materialize


@dataclass(frozen=True)
class Audit:
    """A log with the intermediate tables its suites share, each written once when first needed."""

    frame: DataFrame
    roles: Roles

    @cached_property
    def grain(self) -> DataFrame:
        return materialize(duplicates.pair_days(self.frame, self.roles), "grain")

    @cached_property
    def daily(self) -> DataFrame:
        return materialize(duplicates.daily_from_grain(self.grain, self.roles), "daily")

    @cached_property
    def counts(self) -> DataFrame:
        """One row with every count that needs no shuffle."""
        roles = self.roles
        more = [
            nulls(F.col(roles.wall_time)).alias("time_nulls"),
            *quality.ratio_counts(roles), *quality.clock_counts(roles), *quality.epoch_counts(roles),
            *quality.over_counts(roles), *quality.denominator_counts(roles),
        ]
        return materialize(profile.measure_counts(self.frame, roles.ratio, more), "counts")

    @cached_property
    def user_tail(self) -> DataFrame:
        return materialize(profile.long_tail(self.grain, self.roles.user, weight="rows"), "users")

    @cached_property
    def item_tail(self) -> DataFrame:
        return materialize(profile.long_tail(self.grain, self.roles.item, weight="rows"), "items")

    @property
    def scale(self) -> DataFrame:
        return profile.scale_from_folds(self.daily, self.user_tail, self.item_tail, self.roles)


def _prefixed(df: DataFrame, prefix: str, columns: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{prefix}{c}") for c in columns])


# ---------------------------------------------------------------- contract


CONTRACT_RULES = (
    Rule("columns", "the table has exactly the declared columns",
         "missing = '' AND surplus = ''", ("columns", "missing", "surplus", "rows", "users", "items")),
    Rule("day_type", "the day is a whole number or a date", "day_typed", ("day_nulls",)),
    Rule("time_loss", "the clock is typed and no row lost it in parsing",
         "time_typed AND time_nulls <= day_nulls", ("time_nulls", "day_nulls")),
    Rule("offset", "clock and epoch differ by one constant",
         "distinct_offsets = 1", ("distinct_offsets", "min_offset_ms", "max_offset_ms")),
    Rule("offset_value", "the clock equals epoch plus zone to the microsecond",
         "deviating_rows = 0", ("compared_rows", "deviating_rows", "max_deviation_us")),
)


def contract_facts(audit: Audit, expected: Sequence[str]) -> DataFrame:
    return merge_facts(
        contract.with_schema_facts(
            audit.scale.select("rows", "users", "items", "day_nulls"),
            audit.frame, expected, audit.roles,
        ),
        audit.counts.select("time_nulls"),
        contract.offset_profile(audit.frame, audit.roles),
    )


# ---------------------------------------------------------------- profile


PROFILE_RULES = (
    Rule("scale", "rows, users, items and day range are measured",
         "rows > 0 AND users > 0 AND items > 0 AND day_min IS NOT NULL",
         ("rows", "users", "items", "day_min", "day_max")),
    Rule("user_tail", "the user tail is measured", "user_keys > 0",
         ("user_p50", "user_max", "user_below_count")),
    Rule("item_tail", "the item tail is measured", "item_keys > 0",
         ("item_p50", "item_max", "item_below_count")),
    Rule("ratio_spread", "the ratio distribution is measured", "measured > 0",
         ("measured", "null_count", "gt1_count", "eq0_count")),
    Rule("ratio", "the ratio equals numerator over denominator", "ratio_mismatch = 0",
         ("ratio_eligible", "ratio_mismatch")),
    Rule("day_clock", "the day equals the day of the clock", "clock_mismatch = 0",
         ("clock_eligible", "clock_mismatch")),
    Rule("daily", "daily activity is measured", "days > 0", ("days", "min_rows", "max_rows")),
)


def profile_facts(audit: Audit) -> DataFrame:
    tail = ("keys", "p50", "max", "below_count")
    return merge_facts(
        audit.scale.drop("days"),
        _prefixed(audit.user_tail, "user_", tail),
        _prefixed(audit.item_tail, "item_", tail),
        audit.counts.select(
            "measured", "null_count", "gt1_count", "eq0_count",
            "ratio_eligible", "ratio_mismatch", "clock_eligible", "clock_mismatch",
        ),
        profile.daily_activity_stats(audit.daily, audit.roles, weight="rows").select(
            "days", "min_rows", "max_rows"
        ),
    )


def coverage_rules(least_pct: float = 99.0) -> tuple[Rule, ...]:
    return (
        Rule("observed", f"at least {least_pct} percent of the user x item pairs are observed",
             # Exact: a rounded percentage would pass just below the limit.
             f"cast(actual_pairs AS decimal(19,0)) * 100 >= cast({least_pct} AS decimal(5,2))"
             " * cast(users AS decimal(14,0)) * cast(items AS decimal(14,0))",
             ("actual_pairs", "expected_pairs", "gap")),
    )


FEATURE_RULES = (
    Rule("covers", "the feature source covers some of the base items", "covered_items > 0",
         ("rows", "items", "covered_items", "base_items")),
)

OVERLAP_RULES = (
    Rule("overlap", "both tables share at least one day", "shared_days > 0",
         ("left_days", "right_days", "shared_days")),
)


# ---------------------------------------------------------------- anomalies


ANOMALY_RULES = (
    Rule("copies", "exact copies are counted", "total_rows > 0", ("total_rows", "uniq_rows")),
    Rule("pairs", "repeated pairs are counted", "distinct_pairs > 0",
         ("dup_pairs", "dup_pair_rows", "max_repeat")),
    Rule("over", "rows above their denominator are counted", "over_eligible > 0",
         ("over_eligible", "over_rows")),
    Rule("zero", "zero denominators are counted", "total_rows > 0", ("zero_rows", "null_rows")),
    Rule("epoch_day", "the day equals the local day of the epoch", "epoch_mismatch = 0",
         ("epoch_eligible", "epoch_mismatch")),
)


def anomaly_facts(audit: Audit) -> DataFrame:
    return merge_facts(
        duplicates.summary_from_grain(audit.grain, audit.roles),
        audit.counts.select(
            "over_eligible", "over_rows", "zero_rows", "null_rows", "epoch_eligible", "epoch_mismatch"
        ),
    )


# ---------------------------------------------------------------- difference of two tables


SUBSET_RULES = (
    Rule("subset", "every key of the left table is in the right one", "left_only = 0",
         ("left_keys", "right_keys", "left_only")),
)

AVAILABILITY_RULES = (
    Rule("days", "the days of both tables are compared", "all_days > 0",
         ("all_days", "shared_days", "left_only", "right_only")),
)


def segment_rules(expected: int) -> tuple[Rule, ...]:
    return (
        Rule("segments", f"the days form {expected} runs with {expected - 1} gaps",
             f"segments = {expected} AND gaps = {expected - 1}", ("segments", "gaps", "gap_days")),
    )


def segment_facts(days: DataFrame, day: str) -> DataFrame:
    """From any table holding the days, best the day table itself."""
    gaps = calendar.date_gaps(days, day)
    return merge_facts(
        calendar.date_segments(days, day).agg(F.count(F.lit(1)).alias("segments")),
        gaps.agg(
            F.count(F.lit(1)).alias("gaps"),
            F.coalesce(F.sum("gap_days"), F.lit(0)).alias("gap_days"),
        ),
    )


# ---------------------------------------------------------------- peak days


def peak_rules(
    partial: int, whole: int, expected: Mapping[str, int], limit: float = 2.0
) -> tuple[Rule, ...]:
    """The double-write hypothesis about a partly and a wholly doubled day, fixed before the run."""
    rules = (
        Rule("top_copies", "the listed day holds the most exact copies",
             f"removed_dups_day = {partial}", ("removed_dups_day",)),
        Rule("partial_neighbours", "its neighbours hold none",
             "partial_clean", ("partial_neighbours_removed",)),
        Rule("top_rows", "the listed day has the most rows", f"rows_day = {partial}", ("rows_day",)),
        Rule("top_uniq", "without copies another day has the most rows",
             f"uniq_rows_day <> {partial}", ("uniq_rows_day",)),
        Rule("partial_close", "without copies the day is like its neighbours",
             "partial_close", ("partial_uniq_rows",)),
        Rule("whole_in_pairs", "every row of the doubled day is in a repeated pair",
             "whole_in_pairs", ("whole_rows",)),
        Rule("whole_doubled", "the doubled day holds every row twice",
             "whole_doubled", ("whole_removed",)),
        Rule("whole_close", "without copies the doubled day is like its neighbours",
             "whole_close", ("whole_uniq_rows",)),
        Rule("no_outlier", f"without copies no day exceeds {limit} medians",
             "no_outlier_after", ("max_uniq",)),
        Rule("localized", "the listed days hold all exact copies", "copies_localized",
             ("peak_removed", "other_removed")),
        Rule("spreads", "pair dedupe also removes rows of other days", "pair_dedupe_spreads",
             ("other_pair_removed",)),
        Rule("ladder", "the dedupe stages add up", "adds_up",
             ("exact_removed", "within_day_removed", "cross_day_removed")),
    )
    if not expected:
        return rules
    # Without published totals there is nothing to come out again, so there is no such rule.
    same = " AND ".join(f"{k} = {v}" for k, v in expected.items())
    return (*rules, Rule("reproduced", "the published totals come out again", same, tuple(expected)))


def peak_facts(
    audit: Audit, partial: int, whole: int, tolerance: float = 0.20, limit: float = 2.0
) -> DataFrame:
    """One row of peak-day facts, all but the dedupe stages from the day table."""
    grain, daily, roles = audit.grain, audit.daily, audit.roles
    peaks = (partial, whole)
    near = duplicates.peak_neighbors(daily, roles, peaks, tolerance)
    tops = duplicates.peak_days(daily, roles)
    double = duplicates.double_write_days(daily, roles).where(F.col(roles.day) == whole)
    ladder = duplicates.ladder_facts(duplicates.summary_from_grain(grain, roles, peaks))

    def of(day: int, prefix: str) -> DataFrame:
        return near.where(F.col("peak_day") == day).select(
            F.col("uniq_rows").alias(f"{prefix}_uniq_rows"),
            F.col("neighbours_removed").alias(f"{prefix}_neighbours_removed"),
            F.col("neighbours_clean").alias(f"{prefix}_clean"),
            F.col("close_to_neighbours").alias(f"{prefix}_close"),
        )

    return merge_facts(
        tops.agg(
            *[
                F.max(F.when(F.col("metric") == m, F.col("peak_day"))).alias(f"{m}_day")
                for m in ("removed_dups", "rows", "uniq_rows")
            ]
        ),
        of(partial, "partial"),
        of(whole, "whole"),
        double.select(
            F.col("rows").alias("whole_rows"),
            F.col("removed_dups").alias("whole_removed"),
            F.col("all_in_dup_pairs").alias("whole_in_pairs"),
            F.col("exactly_doubled").alias("whole_doubled"),
        ),
        duplicates.outlier_ratio(daily, roles, limit).select("max_uniq", "no_outlier_after"),
        duplicates.dup_localization(daily, roles, peaks).select(
            "removed_dups", "peak_removed", "other_removed", "other_pair_removed",
            "copies_localized", "pair_dedupe_spreads",
        ),
        ladder.select(
            "dup_pairs", "exact_removed", "within_day_removed", "cross_day_removed",
            duplicates.ladder_adds_up().alias("adds_up"),
        ),
    )


CONTROL_RULES = (
    Rule("clean", "the control table holds no exact copies", "removed_dups = 0", ("rows", "removed_dups")),
)


