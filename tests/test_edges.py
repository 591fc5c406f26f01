"""Literal fixtures: clocks, nulls, ties, hot keys, empty and tiny inputs; quantiles by brute force."""

import datetime as dt
import math

import pytest
from conftest import FIXTURE_ROLES as R
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from logassay.functions import clock, numeric, quantile
from logassay.operators import calendar, contract, coverage, dedupe, duplicates, profile, quality, sequences, verdict
from logassay.roles import Roles

LOG = ("user_id bigint, video_id bigint, play_duration bigint, video_duration bigint, "
       "time timestamp_ntz, date bigint, timestamp double, watch_ratio double")


def row(df):
    (only,) = df.collect()
    return only.asDict()


def at(day, hour=8, second=0.0):
    return dt.datetime(2024, 1, day, hour, int(second), 0, round(second % 1 * 1e6))


def event(user, item, day, play=100, length=200, hour=8, **kw):
    local = at(day, hour)
    epoch = (local - dt.datetime(1970, 1, 1)).total_seconds() - 28800
    values = dict(user_id=user, video_id=item, play_duration=play, video_duration=length, time=local,
                  date=20240100 + day, timestamp=epoch, watch_ratio=play / length if play and length else None)
    return tuple((values | kw).values())


# ---------------------------------------------------------------- clocks


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Shanghai"])
def test_clock_does_not_depend_on_the_session_zone(spark, zone):
    texts = ["2020-03-08 02:30:00", "2020-03-08 02:30:00.5", "2020-03-08 02:30:00.25",
             "2020-03-08 02:30:00.125", "2020-03-08 02:30:00.123456", "", None, "bad", "2020-03-08",
             "2020-03-08 02:30:00.5Z", "2020-13-08 02:30:00"]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(t,) for t in texts], "raw string")
        got = [r[0] for r in df.select(clock.parse_wall_clock(F.col("raw"))).collect()]
        base = dt.datetime(2020, 3, 8, 2, 30)
        micro = [0, 500000, 250000, 125000, 123456]
        assert got == [base + dt.timedelta(microseconds=m) for m in micro] + [None] * 6
        moment = spark.sql("SELECT timestamp_ntz'2020-03-08 02:30:00.125' AS t, 1583634600.125D AS e, bigint(20200308) AS k")
        r = row(moment.select(
            clock.epoch_micros(F.col("t")).alias("us"),
            clock.epoch_to_clock(F.col("e")).alias("ms"),
            clock.epoch_to_clock_seconds(F.col("e"), 28800).alias("s"),
            clock.day_key(F.col("t")).alias("day"),
            clock.millis_between(F.col("t"), clock.epoch_to_clock_seconds(F.col("e"))).alias("cut"),
            clock.day_key_to_date(F.col("k")).alias("date"),
        ))
        assert r == {"us": 1583634600125000, "ms": dt.datetime(2020, 3, 8, 2, 30, 0, 125000),
                     "s": dt.datetime(2020, 3, 8, 10, 30), "day": 20200308, "cut": 125,
                     "date": dt.date(2020, 3, 8)}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_impossible_days_are_null(spark):
    keys = [20240229, 20230229, 20241301, 20240100, 0, -5, 2024011, 99991231, None]
    df = spark.createDataFrame([(k,) for k in keys], "k bigint").select(clock.day_key_to_date(F.col("k")))
    assert [r[0] for r in df.collect()] == [dt.date(2024, 2, 29), *[None] * 6, dt.date(9999, 12, 31), None]


def test_loss_is_measured_not_hidden(spark):
    texts = ["2024-01-01 00:00:00", "2024-01-01 00:00:00.5", "2024-01-01 00:00:00.25",
             "2024-01-01 00:00:00.125", "2024-01-01 00:00:00.123456", "", None, "bad"]
    df = spark.createDataFrame([(t,) for t in texts], "raw string")
    raw = F.col("raw")
    got = {r["parser"]: r for r in contract.parse_loss(
        df, "raw", {"any": clock.parse_wall_clock(raw), "three": clock.parse_fixed_fraction(raw, 3)}).collect()}
    assert (got["any"]["lost_rows"], got["three"]["lost_rows"], got["any"]["blank_rows"]) == (1, 5, 2)
    lengths = {r["raw_length"]: (r["rows"], r["failed"]) for r in contract.parse_failure_by_length(
        df, "raw", clock.parse_fixed_fraction(raw, 3)).collect()}
    assert lengths == {19: (1, 1), 21: (1, 1), 22: (1, 1), 23: (1, 0), 26: (1, 1), 3: (1, 1)}


def test_offset_rule_passes_breaks_and_needs_values(spark):
    rule = [verdict.Rule("offset", "constant", "distinct_offsets = 1")]

    def judged(rows):
        df = spark.createDataFrame(rows, LOG)
        facts = contract.offset_profile(df, R)
        return row(facts), row(verdict.judge(facts, "x", rule))["verdict"]

    facts, says = judged([event(1, 1, 1), event(1, 2, 2)])
    assert says == "PASS" and (facts["min_offset_ms"], facts["deviating_rows"]) == (28_800_000, 0)
    late = event(1, 2, 2, time=at(2) + dt.timedelta(milliseconds=1))
    facts, says = judged([event(1, 1, 1), late])
    assert says == "FAIL" and (facts["distinct_offsets"], facts["max_deviation_us"]) == (2, 1000)
    facts, says = judged([event(1, 1, 1, time=None)])
    assert says == "FAIL" and facts["compared_rows"] == 0


# ---------------------------------------------------------------- nulls, zeros, ties


def test_zero_and_null_denominators_under_ansi(spark):
    df = spark.createDataFrame([event(1, 1, 1), event(1, 2, 1, length=0), event(1, 3, 1, length=None),
                                event(1, 4, 1, play=None), event(1, 5, 1, play=500, watch_ratio=9.0)], LOG)
    assert row(quality.zero_denominator(df, R)) == {"rows": 5, "zero_rows": 1, "null_rows": 1, "zero_pct": 20.0}
    assert row(quality.over_duration(df, R)) == {"over_eligible": 2, "over_rows": 1, "over_pct": 50.0}
    assert row(quality.ratio_consistency(df, R)) == {"ratio_eligible": 2, "ratio_mismatch": 1, "ratio_pct": 50.0}


def test_null_keys_and_null_days(spark):
    rows = [event(1, 1, 1), event(None, 1, 1), event(1, None, 2),
            event(2, 2, 1, date=None, time=None, timestamp=None), event(2, 2, 1, date=None, time=None, timestamp=None)]
    df = spark.createDataFrame(rows, LOG)
    scale = row(profile.scale_profile(df, R))
    assert (scale["users"], scale["user_nulls"], scale["days"], scale["day_nulls"]) == (2, 1, 2, 2)
    assert row(duplicates.exact_duplicates(df))["removed_dups"] == 1
    days = {r["date"]: r["rows"] for r in duplicates.daily_dup_structure(df, R).collect()}
    assert days == {20240101: 2, 20240102: 1, None: 2}
    stats = row(profile.daily_activity_stats(df, R))
    assert (stats["days"], stats["null_rows"], stats["mean_rows"]) == (2, 2, 1.5)
    assert row(profile.daily_activity_stats(df, R, include_null_day=True))["mean_rows"] == round(5 / 3, 4)
    assert row(coverage.matrix_coverage(df, R))["actual_pairs"] == 2
    grain = duplicates.pair_days(df, R)
    folded = profile.scale_from_folds(
        duplicates.daily_from_grain(grain, R), profile.long_tail(grain, R.user, weight="rows"),
        profile.long_tail(grain, R.item, weight="rows"), R)
    assert row(folded) == scale == row(profile.scale_profile(df, R, rsd=0.01))


def test_argmax_tie_goes_to_the_earliest_day(spark):
    df = spark.createDataFrame([event(1, 1, 3), event(1, 2, 2), event(1, 3, 4)], LOG)
    tops = duplicates.peak_days(duplicates.daily_dup_structure(df, R), R).collect()
    assert {r["peak_day"] for r in tops} == {20240102}


def test_keep_one_is_fixed_under_ties(spark):
    rows = [event(1, 1, 1, play=p) for p in (100, 300, 200)] + [event(1, 1, 2, play=50)]
    df = spark.createDataFrame(rows, LOG)
    for n in (1, 3):
        assert row(dedupe.keep_last(df.repartition(n), R))["play_duration"] == 50
        first = {r["date"]: r["play_duration"] for r in dedupe.keep_last(df.repartition(n), R, True).collect()}
        assert first == {20240101: 300, 20240102: 50}
        assert row(dedupe.keep_highest(df.repartition(n), R))["play_duration"] == 300
    assert row(dedupe.fold_pairs(df, R))["total_numerator"] == 650
    assert dedupe.drop_exact(df.unionByName(df)).count() == 4


def test_map_columns_compare_by_entries(spark):
    df = spark.sql("SELECT map('a', 1, 'b', 2) AS m UNION ALL SELECT map('b', 2, 'a', 1) UNION ALL SELECT map('a', 1)")
    assert row(duplicates.exact_duplicates(df)) == {"rows": 3, "uniq_rows": 2, "removed_dups": 1, "removed_pct": 33.3333}


# ---------------------------------------------------------------- empty and tiny


def test_empty_table(spark):
    df = spark.createDataFrame([], LOG)
    assert row(profile.scale_profile(df, R))["rows"] == 0
    assert row(profile.long_tail(df, R.user))["keys"] == 0
    got = row(profile.measure_profile(df, R.ratio))
    assert (got["measured"], got["p50"], got["gt1_pct"]) == (0, None, 0.0)
    assert row(duplicates.exact_duplicates(df))["removed_pct"] == 0.0
    assert duplicates.dedup_ladder(df, R).count() == 4
    assert row(coverage.matrix_coverage(df, R))["coverage_pct"] == 0.0
    assert calendar.date_segments(df, R.day).count() == 0
    daily = duplicates.daily_dup_structure(df, R)
    assert not row(duplicates.outlier_ratio(daily, R))["no_outlier_after"]
    assert not row(duplicates.peak_neighbors(daily, R, [20240101]))["neighbours_clean"]


def test_one_day_has_no_neighbours(spark):
    daily = duplicates.daily_dup_structure(spark.createDataFrame([event(1, 1, 1)], LOG), R)
    got = row(duplicates.peak_neighbors(daily, R, [20240101]))
    assert (got["neighbours_found"], got["neighbours_clean"], got["close_to_neighbours"]) == (0, False, False)
    assert row(duplicates.neighbour_deviation(daily, R))["deviation"] is None
    assert calendar.date_gaps(spark.createDataFrame([event(1, 1, 1)], LOG), R.day).count() == 0


def test_peak_at_the_edge_and_given_neighbours(spark):
    rows = [event(u, 1, d) for d in (1, 2, 4) for u in range(10 if d == 1 else 5)]
    daily = duplicates.daily_dup_structure(spark.createDataFrame(rows, LOG), R)
    edge = row(duplicates.peak_neighbors(daily, R, [20240101]))
    assert (edge["neighbours_found"], edge["neighbours_clean"], edge["deviation"]) == (1, False, 1.0)
    given = row(duplicates.peak_neighbors(daily, R, {20240102: (20240104,)}))
    assert given["neighbours_clean"] and given["close_to_neighbours"]


# ---------------------------------------------------------------- hot keys


def test_hot_pair_keeps_whole_results(spark):
    """One pair holds well over a third of the rows, half of them exact copies."""
    hot = spark.range(6000).selectExpr(
        "bigint(1) AS user_id", "bigint(1) AS video_id", "id div 2 AS play_duration",
        "bigint(100) AS video_duration", "timestamp_ntz'2024-01-01 08:00:00' AS time",
        "bigint(20240101) AS date", "1704067200.0D AS timestamp", "0.5D AS watch_ratio")
    rest = spark.range(3000).selectExpr(
        "id AS user_id", "id AS video_id", "id AS play_duration", "bigint(100) AS video_duration",
        "timestamp_ntz'2024-01-02 08:00:00' AS time", "bigint(20240102) AS date",
        "1704153600.0D AS timestamp", "0.25D AS watch_ratio")
    df = hot.unionByName(rest)
    got = row(duplicates.dup_summary(df, R))
    assert got == {"total_rows": 9000, "uniq_rows": 6000, "removed_dups": 3000, "distinct_pairs": 3000,
                   "dup_pairs": 1, "dup_pair_rows": 6001, "max_repeat": 6001}
    assert dedupe.keep_last(df, R).count() == 3000
    kept = row(dedupe.keep_last(df, R, True).where("user_id = 1 AND date = 20240101"))
    assert kept["play_duration"] == 2999
    newest = sequences.newest_sequences(df, R, 7).where("user_id = 1").collect()
    assert [len(r["items"].split()) for r in newest] == [7]
    assert newest[0]["events"] == 7 and newest[0]["events_total"] == df.where("user_id = 1").count()
    assert sequences.segment_sequences(df, R).count() == df.count()


@pytest.mark.parametrize("name", ["keep_last", "newest_sequences"])
def test_rank_filters_are_limited_before_the_shuffle(spark, name):
    df = spark.createDataFrame([event(1, 1, 1)], LOG)
    plan = (dedupe.keep_last(df, R) if name == "keep_last" else sequences.newest_sequences(df, R, 5))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("WindowGroupLimit") == 2


def test_grains_are_folded_before_each_shuffle(spark):
    df = spark.createDataFrame([event(1, 1, 1)], LOG)
    text = duplicates.daily_dup_structure(df, R)._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 3
    assert text.count("partial_") >= 3 and "Join" not in text


# ---------------------------------------------------------------- sequences, features, splits


def test_sequences_stop_at_gaps(spark):
    rows = [event(1, i, d, hour=h) for i, d, h in ((10, 1, 8), (11, 1, 9), (12, 2, 8), (13, 5, 8))]
    log = spark.createDataFrame(rows, LOG)
    got = sequences.newest_sequences(log, R, 2).orderBy("segment").collect()
    assert [(r["segment"], r["events_total"], r["items"]) for r in got] == [(1, 3, "11 12"), (2, 1, "13")]
    assert [r["segment"] for r in sequences.segment_sequences(log, R).orderBy("video_id").collect()] == [1, 1, 1, 2]


def test_a_hot_user_loses_no_event_and_is_split(spark):
    rows = [event(1, i, 1 + i % 3) for i in range(5000)] + [event(2, 1, 1), event(2, 2, 1, date=None), event(2, 3, 1, date=20240230)]
    log = spark.createDataFrame(rows, LOG)
    got = sequences.segment_sequences(log, R)
    assert got.count() == 5003 and got.where("segment IS NULL").count() == 2
    assert sorted(r[0] for r in got.where("user_id = 1").select("video_id").collect()) == list(range(5000))
    assert "rangepartitioning" in got._jdf.queryExecution().executedPlan().toString()
    lost = sequences.sequence_losses(log, R).first()
    assert (lost.events, lost.in_a_run, lost.null_day, lost.impossible_day) == (5003, 5001, 1, 1)


@pytest.mark.parametrize("newest", [0, 1001])
def test_newest_beyond_the_group_limit_is_refused(spark, newest):
    with pytest.raises(ValueError, match="segment_sequences"):
        sequences.newest_sequences(spark.createDataFrame([event(1, 1, 1)], LOG), R, newest)


def test_impossible_days_have_no_neighbours(spark):
    days = spark.createDataFrame([(20240101, 10), (20240102, 30), (20240230, 50), (20240231, 70), (20241399, 90), (None, 5)], "date bigint, uniq_rows bigint")
    got = {r.date: (r.neighbours, r.neighbour_mean) for r in duplicates.neighbour_deviation(days, R).collect()}
    assert got == {20240101: (1, 30.0), 20240102: (1, 10.0), 20240230: (0, None), 20240231: (0, None), 20241399: (0, None)}


def test_impossible_days_never_reach_the_window(spark):
    days = [(20240101,), (20240230,), (20240231,), (20241301,), (20240100,), (7,), (10**12,), (-20240101,), (None,), (20240103,)]
    df = spark.createDataFrame(days, "date bigint")
    got = calendar.day_steps(df, "date")
    text = got._jdf.queryExecution().optimizedPlan().toString()
    # The test of the integers stands between the fold and the window.
    assert text.index("Window") < text.rindex("Filter") < text.index("Aggregate") and text.count("Aggregate") == 1
    assert sorted((str(r.day_date), r.days_since_previous) for r in got.collect()) == [("2024-01-01", None), ("2024-01-03", 2)]


def test_maps_do_not_stop_dedupe(spark):
    df = spark.sql("SELECT 1 AS user_id, 2 AS video_id, timestamp_ntz'2024-01-01' AS time, map('a', 1, 'b', 2) AS m UNION ALL SELECT 1, 2, timestamp_ntz'2024-01-01', map('b', 2, 'a', 1)")
    assert dedupe.drop_exact(df).count() == 1
    assert dedupe.keep_one(df, ["user_id"], [F.col("time")]).count() == 1


def test_features_come_from_strictly_earlier_days(spark):
    log = spark.createDataFrame([event(1, 1, d) for d in (1, 2, 3, 5)] + [event(2, 9, 2)], LOG)
    features = spark.createDataFrame(
        [(1, 20240101, 7.0), (1, 20240102, 8.0), (1, 20240105, 9.0)], "item bigint, day bigint, score double")
    got = sequences.point_in_time_features(log, R, features, "item", "day", ["score"]).collect()
    assert {(r["video_id"], r["date"]): r["score"] for r in got} == {
        (1, 20240101): None, (1, 20240102): 7.0, (1, 20240103): 8.0, (1, 20240105): 8.0, (9, 20240102): None}


def test_splits_must_not_overlap(spark):
    ranges = [calendar.DayRange("train", 20240101, 20240103), calendar.DayRange("test", 20240103, 20240105)]
    with pytest.raises(ValueError, match="overlap"):
        calendar.split_of(F.col("date"), ranges)
    df = spark.createDataFrame([event(1, 1, d) for d in (1, 2, 5)] + [event(1, 1, 1, date=None)], LOG)
    got = calendar.split_summary(df, "date", "user_id", [ranges[0]]).collect()
    assert {r["split"]: r["rows"] for r in got} == {"train": 2, "quarantine": 2}


def test_per_user_runs(spark):
    df = spark.createDataFrame([event(u, 1, d) for u, d in ((1, 1), (1, 2), (1, 9), (2, 4))], LOG)
    got = calendar.date_segments(df, R.day, [R.user]).collect()
    assert {(r["user_id"], r["segment"]): r["days"] for r in got} == {(1, 1): 2, (1, 2): 1, (2, 1): 1}
    wide = calendar.date_segments(df, R.day, [R.user], max_step=7).where("user_id = 1")
    assert row(wide)["days"] == 3


# ---------------------------------------------------------------- text and feature sources


def test_invalid_utf8_is_counted(spark):
    df = spark.sql("SELECT cast(x'41FF' AS string) AS a, 'ok' AS b UNION ALL SELECT 'ü', NULL")
    got = {r["column_name"]: (r["null_rows"], r["invalid_rows"]) for r in quality.utf8_validity(df, ["a", "b"]).collect()}
    assert got == {"a": (0, 1), "b": (1, 0)}


def test_feature_source_without_a_date_or_a_match(spark):
    base = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k bigint")
    source = spark.createDataFrame([(7, "x"), (8, "y")], "id bigint, note string")
    facts = coverage.feature_coverage(base, "k", source, "id", "notes")
    got = row(facts)
    assert (got["rows"], got["items"], got["base_items"], got["coverage_pct"], got["date_column"]) == (2, 2, 2, 0.0, None)
    rule = [verdict.Rule("covers", "covers", "coverage_pct > 0")]
    assert row(verdict.judge(facts, "x", rule))["verdict"] == "FAIL"
    dated = spark.createDataFrame([(1, 20240105), (3, 20240101)], "id bigint, upload_DATE bigint")
    got = row(coverage.feature_coverage(base, "k", dated, "id", "dated"))
    assert (got["date_column"], got["date_min"], got["date_max"], got["coverage_pct"]) == (
        "upload_DATE", "20240101", "20240105", 50.0)


# ---------------------------------------------------------------- verdicts


def test_verdict_table_summary_and_exit(spark):
    facts = spark.sql("SELECT bigint(3) AS n, cast(null AS bigint) AS m")
    rules = [verdict.Rule("a", "n is three", "n = 3", ("n", "m")), verdict.Rule("b", "m is known", "m > 0"),
             verdict.Rule("c", "n is four", "n = 4")]
    judged = verdict.judge(facts, "s", rules)
    assert [(r["check_id"], r["verdict"]) for r in judged.collect()] == [("s.a", "PASS"), ("s.b", "FAIL"), ("s.c", "FAIL")]
    assert judged.first()["evidence"] == "n=3, m=null"
    assert row(verdict.summarize(judged)) == {"checks": 3, "passed": 1, "failed": 2}
    assert verdict.exit_code(judged) == 1 and verdict.exit_code(judged.where("verdict = 'PASS'")) == 0


# ---------------------------------------------------------------- quantiles


def nearest(values, p):
    ordered = sorted(values)
    return ordered[math.floor((len(ordered) - 1) * p + 0.5)]


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.floats(allow_nan=False, width=64), st.sampled_from([0.0, 1.0, -1.0, 0.5])), min_size=1, max_size=60))
def test_quantiles_match_brute_force(spark, values):
    values = [v + 0.0 for v in values]
    df = spark.createDataFrame([(v,) for v in [*values, None]], "v double")
    got = {r["p"]: r["value"] for r in quantile.nearest_quantiles(df, "v").collect()}
    assert got == {p: nearest(values, p) for p in quantile.QUARTILES_AND_TAIL}


@pytest.mark.parametrize("refinements", [0, 1, 3])
def test_quantiles_of_crowded_and_hot_values(spark, refinements):
    # A narrow band far from zero, a value that fills a third of the rows, and far outliers.
    df = spark.range(3000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 1.7e9 WHEN id % 97 = 0 THEN id * 1e12 ELSE 1.7e9 + id / 7.0D END AS v")
    values = [r[0] for r in df.collect()]
    got = {r["p"]: r["value"] for r in quantile.nearest_quantiles(df, "v", refinements=refinements).collect()}
    assert got == {p: nearest(values, p) for p in quantile.QUARTILES_AND_TAIL}


def test_quantiles_of_whole_numbers(spark):
    df = spark.range(1, 1002).selectExpr("id * id AS v")
    got = {r["p"]: r["value"] for r in quantile.nearest_quantiles(df, "v", (0.0, 0.5, 1.0)).collect()}
    assert got == {0.0: 1, 0.5: 501**2, 1.0: 1001**2}


def test_long_tail_by_brute_force(spark):
    df = spark.range(500).selectExpr("floor(sqrt(id)) AS k")
    counts = [0] * 23
    for i in range(500):
        counts[math.isqrt(i)] += 1
    got = row(profile.long_tail(df, "k"))
    assert [got[f"p{q}"] for q in (25, 50, 75, 90, 99)] == [nearest(counts, q / 100) for q in (25, 50, 75, 90, 99)]
    assert (got["keys"], got["max"], got["below_count"]) == (23, max(counts), sum(c < 10 for c in counts))


def test_approximate_quantiles_stay_within_the_stated_rank(spark):
    df = spark.range(10_001).selectExpr("double(id) AS v")
    for r in profile.approximate_quantiles(df, "v", accuracy=1000).collect():
        assert abs(r["value"] - r["p"] * 10_000) <= 10_001 / 1000 + 1


def test_safe_arithmetic(spark):
    r = row(spark.sql("SELECT bigint(1) AS a, bigint(0) AS z").select(
        numeric.percent(F.col("a"), F.col("z")).alias("p"), numeric.ratio(F.col("a"), F.col("z")).alias("r")))
    assert r == {"p": 0.0, "r": None}


def test_roles_name_the_pair():
    assert Roles(user="u", item="i", day="d").day_pair == ["d", "u", "i"]
