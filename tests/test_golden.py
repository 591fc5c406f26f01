"""The planted fixture against the values recorded for it, and checks seen failing."""

import pytest
from conftest import FIXTURE_ROLES as R
from conftest import MIDDLE, SMALL, planted_log

from logassay.operators import calendar, contract, coverage, duplicates, profile, quality, verdict
from logassay.plans import suites
from logassay.plans.suites import Audit

PEAKS = (20240105, 20240115)


def row(df):
    (only,) = df.collect()
    return only.asDict()


def test_scale_and_ratio(planted):
    got = row(profile.scale_profile(planted, R))
    assert (got["rows"], got["users"], got["items"], got["days"]) == (8684, 150, 100, 26)
    stats = row(profile.measure_profile(planted, R.ratio))
    assert stats["gt1_count"] == 1043
    found = [stats[p] for p in ("p25", "p50", "p75", "p90", "p99")]
    assert found == [0.1182, 0.2916, 0.5971, 1.0994, 2.6894]


def test_wrong_days_are_found(planted):
    # 19 wrong rows, counted on the log as planted (copies included).
    assert row(quality.date_time_consistency(planted, R))["clock_mismatch"] == 19
    assert row(quality.epoch_date_consistency(planted, R))["epoch_mismatch"] == 19
    assert row(quality.ratio_consistency(planted, R))["ratio_mismatch"] == 0


def test_daily_structure(planted):
    days = {r["date"]: r.asDict() for r in duplicates.daily_dup_structure(planted, R).collect()}
    assert len(days) == 26

    def figures(d):
        r = days[d]
        return [r[k] for k in ("rows", "uniq_rows", "distinct_pairs", "dup_pairs", "dup_pair_rows")]

    assert figures(20240115) == [622, 311, 306, 306, 622]
    assert figures(20240105) == [646, 339, 321, 321, 646]
    assert all(r["removed_dups"] == 0 for d, r in days.items() if d not in PEAKS)


def test_ladder(planted):
    steps = {r["step"]: r for r in duplicates.dedup_ladder(planted, R, PEAKS).collect()}
    assert [steps[i]["remaining_rows"] for i in range(4)] == [8684, 8066, 7977, 6253]
    assert all(r["adds_up"] for r in steps.values())
    local = row(duplicates.dup_localization(duplicates.daily_dup_structure(planted, R), R, PEAKS))
    assert (local["other_pair_removed"], local["peak_pair_removed"]) == (66, 23)
    assert local["copies_localized"] and local["pair_dedupe_spreads"]


def test_summary_and_reproduction(planted):
    got = row(duplicates.dup_summary(planted, R, {"dup_pairs": 1910, "removed_dups": 618}))
    assert (got["dup_pairs"], got["dup_pair_rows"], got["max_repeat"]) == (1910, 4341, 6)
    assert got["distinct_pairs"] == 6253 and got["reproduced"]
    assert not row(duplicates.dup_summary(planted, R, {"dup_pairs": 1}))["reproduced"]


def test_daily_statistics_and_outliers(planted):
    stats = row(profile.daily_activity_stats(planted, R))
    assert (stats["min_rows"], stats["max_rows"], stats["mean_rows"], stats["median_rows"]) == (1, 646, 334.0, 334.5)
    out = row(duplicates.outlier_ratio(duplicates.daily_dup_structure(planted, R), R, 1.5))
    assert (round(out["ratio_before"], 5), round(out["ratio_after"], 5)) == (1.93124, 1.11544)
    assert out["no_outlier_after"]
    assert not row(duplicates.outlier_ratio(duplicates.daily_dup_structure(planted, R), R, 1.1))["no_outlier_after"]


def test_segments_and_gaps(planted):
    runs = calendar.date_segments(planted, R.day).orderBy("segment").collect()
    assert [(r["first_day"], r["last_day"]) for r in runs] == [
        (20231231, 20240107), (20240112, 20240121), (20240124, 20240131)]
    gaps = calendar.date_gaps(planted, R.day).orderBy("gap").collect()
    assert [(r["gap_first"], r["gap_last"], r["gap_days"]) for r in gaps] == [
        (20240108, 20240111, 4), (20240122, 20240123, 2)]


def test_argmax_day_depends_on_scale(spark, planted):
    def top(log):
        tops = duplicates.peak_days(duplicates.daily_dup_structure(log, R), R)
        return {r["metric"]: r["peak_day"] for r in tops.collect()}["rows"]

    assert top(planted) == 20240105
    assert top(planted_log(spark, SMALL)) == 20240115


@pytest.mark.parametrize("step,rows,observed", [(200, 397, True), (20, 380, False)])
def test_panel_coverage_rule(panel, step, rows, observed):
    grid = panel(step)
    facts = coverage.matrix_coverage(grid, R)
    got = row(facts)
    assert (got["users"], got["items"], got["actual_pairs"], got["gap"]) == (20, 20, rows, 400 - rows)
    (rule,) = verdict.judge(facts, "panel", suites.coverage_rules()).collect()
    assert rule["verdict"] == ("PASS" if observed else "FAIL")
    if observed:
        scale = row(profile.scale_profile(grid, R))
        assert (scale["day_nulls"], scale["days"]) == (15, 1)


def test_user_subset_passes_and_fails(spark, panel, planted):
    assert row(coverage.key_subset(panel(200), "user_id", planted, "user_id"))["is_subset"]
    small = planted_log(spark, SMALL)
    failing = row(coverage.key_subset(panel(200), "user_id", small, "user_id"))
    assert not failing["is_subset"] and failing["left_only"] == 5
    first = coverage.subset_offenders(panel(200), "user_id", small, "user_id", 3).collect()
    assert [r["key"] for r in first] == [15, 16, 17]


def test_suites_on_planted_log(planted):
    audit = Audit(planted, R)
    shown = {}
    for facts, name, rules in (
        (suites.contract_facts(audit, R.columns), "contract", suites.CONTRACT_RULES),
        (suites.profile_facts(audit), "profile", suites.PROFILE_RULES),
        (suites.anomaly_facts(audit), "anomaly", suites.ANOMALY_RULES),
        (suites.segment_facts(audit.daily, R.day), "diff", suites.segment_rules(3)),
        (suites.peak_facts(audit, *PEAKS), "peak", suites.peak_rules(*PEAKS, {"dup_pairs": 1910})),
    ):
        shown |= {r["check_id"]: r["verdict"] for r in verdict.judge(facts, name, rules).collect()}
    failed = {k for k, v in shown.items() if v == "FAIL"}
    # Planted: wrong days, a microsecond clock against a millisecond epoch rule, and the knife-edge argmax rules.
    assert {"profile.day_clock", "anomaly.epoch_day"} <= failed
    assert {"peak.whole_doubled", "peak.whole_in_pairs", "peak.reproduced", "peak.localized", "peak.ladder",
            "diff.segments", "contract.columns", "contract.day_type", "contract.time_loss"} <= set(shown) - failed


def test_contract_names_missing_and_surplus(planted):
    odd = planted.withColumnRenamed("watch_ratio", "extra").withColumn("date", planted["date"].cast("double"))
    got = row(contract.table_contract(odd, R.columns, R))
    assert (got["missing"], got["surplus"], got["day_typed"]) == ("watch_ratio", "extra", False)
