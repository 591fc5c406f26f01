"""What the command line shows: named tables plus the verdicts about them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from logassay.operators import calendar, contract, coverage, duplicates, profile, quality, verdict
from logassay.plans import suites
from logassay.plans.suites import Audit


@dataclass
class Report:
    """Tables in reading order and the verdict frames; all lazy until shown or written."""

    tables: dict[str, DataFrame] = field(default_factory=dict)
    judged: list[DataFrame] = field(default_factory=list)

    @property
    def verdicts(self) -> DataFrame:
        return verdict.combine(self.judged)


def contract_report(name: str, audit: Audit, expected: Sequence[str]) -> Report:
    facts = suites.contract_facts(audit, expected)
    return Report(
        {
            f"{name}: offsets": contract.first_offsets(audit.frame, audit.roles),
        },
        [verdict.judge(facts, f"contract.{name}", suites.CONTRACT_RULES)],
    )


def profile_report(name: str, audit: Audit, observed: str = "natural") -> Report:
    """``observed='full'`` adds the rule that nearly every user x item pair is present."""
    frame, grain, roles = audit.frame, audit.grain, audit.roles
    report = Report(
        {
            f"{name}: scale": audit.scale,
            f"{name}: user tail": audit.user_tail,
            f"{name}: item tail": audit.item_tail,
            f"{name}: ratio": profile.measure_profile(frame, roles.ratio),
            f"{name}: label shares": profile.label_shares(frame, roles.ratio),
            f"{name}: daily activity": profile.daily_activity(grain, roles, weight="rows").orderBy(roles.day),
            f"{name}: daily statistics": profile.daily_activity_stats(audit.daily, roles, weight="rows"),
        },
        [verdict.judge(suites.profile_facts(audit), f"profile.{name}", suites.PROFILE_RULES)],
    )
    if observed == "full":
        seen = coverage.matrix_coverage(frame, roles)
        report.tables[f"{name}: coverage"] = seen
        report.judged.append(verdict.judge(seen, f"profile.{name}", suites.coverage_rules()))
    return report


def feature_report(
    base: DataFrame, item: str, sources: Mapping[str, tuple[DataFrame, str]]
) -> Report:
    report = Report()
    for name, (source, key) in sources.items():
        facts = coverage.feature_coverage(base, item, source, key, name)
        report.tables[f"{name}: coverage"] = facts
        report.judged.append(verdict.judge(facts, f"profile.{name}", suites.FEATURE_RULES))
    return report


def anomaly_report(name: str, audit: Audit) -> Report:
    return Report(
        {
            f"{name}: repeated pairs": duplicates.summary_from_grain(audit.grain, audit.roles),
            f"{name}: consistency": audit.counts,
        },
        [verdict.judge(suites.anomaly_facts(audit), f"anomaly.{name}", suites.ANOMALY_RULES)],
    )


def diff_report(left_name: str, left: Audit, right_name: str, right: Audit, segments: int) -> Report:
    user, day = (left.roles.user, right.roles.user), (left.roles.day, right.roles.day)
    users = coverage.key_subset(left.grain, user[0], right.grain, user[1])
    days = coverage.day_overlap(left.daily, day[0], right.daily, day[1])
    pair = f"{left_name}_{right_name}"
    return Report(
        {
            f"users of {left_name} missing in {right_name}": coverage.subset_offenders(
                left.grain, user[0], right.grain, user[1]
            ),
            "days": coverage.day_availability(left.daily, day[0], right.daily, day[1]).orderBy("day"),
            f"{right_name}: runs": calendar.date_segments(right.daily, day[1]).orderBy("segment"),
            f"{right_name}: gaps": calendar.date_gaps(right.daily, day[1]).orderBy("gap"),
        },
        [
            verdict.judge(users, f"diff.{pair}", suites.SUBSET_RULES),
            verdict.judge(days, f"diff.{pair}", suites.AVAILABILITY_RULES),
            verdict.judge(days, f"diff.{pair}", suites.OVERLAP_RULES),
            verdict.judge(
                suites.segment_facts(right.daily, day[1]), f"diff.{right_name}", suites.segment_rules(segments)
            ),
        ],
    )


def peak_report(
    name: str,
    audit: Audit,
    partial: int,
    whole: int,
    expected: Mapping[str, int],
    control: tuple[str, DataFrame] | None = None,
) -> Report:
    roles, daily = audit.roles, audit.daily
    facts = suites.peak_facts(audit, partial, whole)
    ladder = duplicates.ladder_facts(
        duplicates.summary_from_grain(audit.grain, roles, (partial, whole))
    )
    report = Report(
        {
            f"{name}: days": daily.orderBy(roles.day),
            f"{name}: conflicts": duplicates.pair_value_conflicts(daily, roles).orderBy(roles.day),
            f"{name}: repeats": duplicates.repeat_intensity(daily, roles).orderBy(roles.day),
            f"{name}: ladder": duplicates.ladder_rows(ladder).orderBy("step"),
        },
        [verdict.judge(facts, f"peak.{name}", suites.peak_rules(partial, whole, expected))],
    )
    if control:
        copies = duplicates.control_duplicates(control[1], roles, (partial, whole))
        report.tables[f"{control[0]}: copies"] = copies
        report.judged.append(
            verdict.judge(copies.where("scope = 'all'"), f"peak.{control[0]}", suites.CONTROL_RULES)
        )
    return report


def text_report(name: str, df: DataFrame) -> Report:
    """UTF-8 validity of every text column of a table."""
    columns = [c for c, t in df.dtypes if t == "string"]
    return Report({f"{name}: text": quality.utf8_validity(df, columns)}, [])
