"""Every rule is seen passing on a sound log and failing on a planted defect, and only there."""

import datetime as dt

import pytest
from test_edges import LOG, event
from conftest import FIXTURE_ROLES as R

from logassay.operators import contract, coverage, verdict
from logassay.plans import suites
from logassay.plans.suites import Audit

PARTIAL, WHOLE = 20240105, 20240108
RUNS = 2


def sound():
    """Ten users on thirteen days in two runs; one day partly doubled, one wholly."""
    rows = [event(u, 100 * d + u, d) for d in (*range(1, 11), 14, 15, 16) for u in range(10)]
    rows += [event(u, 200 + u, 2) for u in (10, 11, 12)]
    rows += [event(1, 301, 3, play=150)]
    partial = [r for r in rows if r[5] == PARTIAL] + [event(10, 510, 5)]
    whole = [r for r in rows if r[5] == WHOLE]
    return rows + [event(10, 510, 5)] + partial + whole


EXPECTED = {"dup_pairs": 22, "removed_dups": 21}


def failing(spark, rows, schema=LOG):
    audit = Audit(spark.createDataFrame(rows, schema).repartition(2), R)
    judged = [
        verdict.judge(suites.contract_facts(audit, R.columns), "contract", suites.CONTRACT_RULES),
        verdict.judge(suites.profile_facts(audit), "profile", suites.PROFILE_RULES),
        verdict.judge(suites.anomaly_facts(audit), "anomaly", suites.ANOMALY_RULES),
        verdict.judge(suites.segment_facts(audit.daily, R.day), "diff", suites.segment_rules(RUNS)),
        verdict.judge(suites.peak_facts(audit, PARTIAL, WHOLE), "peak", suites.peak_rules(PARTIAL, WHOLE, EXPECTED)),
    ]
    table = verdict.combine(judged).collect()
    assert len(table) == len({r["check_id"] for r in table})
    return {r["check_id"] for r in table if r["verdict"] == "FAIL"}


def changed(rows, where, **values):
    names = [c.split()[0] for c in LOG.split(", ")]
    return [tuple((dict(zip(names, r)) | values).values()) if where(r) else r for r in rows]


def once(n):
    """True for one sound row of a plain day."""
    seen = []

    def pick(r):
        if r[5] == n and not seen:
            seen.append(r)
            return True
        return False

    return pick


def test_sound_log_passes_every_rule(spark):
    assert failing(spark, sound()) == set()


@pytest.mark.parametrize(
    "name,damage,expected",
    [
        ("time lost in parsing, a wrong ratio, a third run of days",
         lambda rows: changed(changed(rows, once(20240106), time=None), once(20240107), watch_ratio=0.52)
         + [event(1, 2001, 20)],
         {"contract.time_loss", "profile.ratio", "diff.segments"}),
        ("one clock off by a millisecond, a wrong day",
         lambda rows: changed(changed(rows, once(20240106), time=dt.datetime(2024, 1, 6, 8, 0, 0, 1000)),
                              once(20240107), date=20240106),
         {"contract.offset", "contract.offset_value", "profile.day_clock", "anomaly.epoch_day"}),
        ("every clock in another zone, no repeated pair on plain days",
         lambda rows: [(*r[:4], r[4] + dt.timedelta(hours=1), *r[5:]) for r in rows if r[2] != 150],
         {"contract.offset_value", "peak.spreads", "peak.reproduced"}),
        ("copies beside the peak and beyond it",
         lambda rows: rows + [event(u, 400 + u, 4) for u in range(10)],
         {"peak.partial_neighbours", "peak.localized", "peak.reproduced"}),
        ("the doubled day misses one copy",
         lambda rows: [r for i, r in enumerate(rows) if i != max(j for j, x in enumerate(rows) if x[5] == WHOLE)],
         {"peak.whole_in_pairs", "peak.whole_doubled", "peak.reproduced"}),
        ("a real burst on the peak day",
         lambda rows: rows + [event(u, 5000 + u, 5) for u in range(100, 140)],
         {"peak.partial_close", "peak.top_uniq", "peak.no_outlier"}),
        ("a busier plain day",
         lambda rows: rows + [event(u, 5000 + u, 9) for u in range(100, 115)],
         {"peak.top_rows", "peak.whole_close", "peak.no_outlier"}),
        ("more copies elsewhere",
         lambda rows: rows + [event(u, 1500 + u, 15) for u in range(10)] + [event(u, 1600 + u, 16) for u in range(10)] * 2,
         {"peak.top_copies", "peak.localized", "peak.reproduced", "peak.top_rows"}),
    ],
    ids=lambda v: v.replace(" ", "_") if isinstance(v, str) else "",
)
def test_planted_defects_fail_their_rules_only(spark, name, damage, expected):
    assert failing(spark, damage(sound())) == expected


def test_empty_log_fails_whatever_needs_rows(spark):
    failed = failing(spark, [])
    needs = {"profile.scale", "profile.user_tail", "profile.item_tail", "profile.ratio_spread", "profile.daily",
             "anomaly.copies", "anomaly.pairs", "anomaly.over", "anomaly.zero", "contract.offset", "diff.segments"}
    assert needs <= failed


def test_wrong_types_and_columns(spark):
    schema = LOG.replace("date bigint", "date double").replace("watch_ratio", "watch_ratio_pct")
    rows = [(*r[:5], float(r[5]), *r[6:]) for r in sound()]
    df = spark.createDataFrame(rows, schema)
    facts = contract.table_contract(df, R.columns, R)
    rules = [r for r in suites.CONTRACT_RULES if r.check_id in ("columns", "day_type", "time_loss")]
    got = {r["check_id"]: r["verdict"] for r in verdict.judge(facts, "t", rules).collect()}
    assert got == {"t.columns": "FAIL", "t.day_type": "FAIL", "t.time_loss": "PASS"}


def test_comparison_rules(spark):
    left = spark.createDataFrame([(1, 20240101), (2, 20240102)], "u bigint, d bigint")
    right = spark.createDataFrame([(1, 20240103)], "u bigint, d bigint")
    days = coverage.day_overlap(left, "d", right, "d")
    users = coverage.key_subset(left, "u", right, "u")
    assert verdict.judge(days, "x", suites.OVERLAP_RULES).first()["verdict"] == "FAIL"
    assert verdict.judge(days, "x", suites.AVAILABILITY_RULES).first()["verdict"] == "PASS"
    assert verdict.judge(users, "x", suites.SUBSET_RULES).first()["verdict"] == "FAIL"
    back = coverage.key_subset(right, "u", left, "u")
    assert verdict.judge(back, "x", suites.SUBSET_RULES).first()["verdict"] == "PASS"
