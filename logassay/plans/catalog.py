"""Every registered query: (session, data folder) -> DataFrame over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logassay.functions import clock, text
from logassay.operators import (
    calendar, contract, coverage, dedupe, duplicates, profile, quality, ranking, sequences, verdict,
)
from logassay.operators.calendar import DayRange
from logassay.plans import inputs, recommender, suites
from logassay.plans.inputs import (
    GRID_ROLES, PARTIAL_DOUBLE, PEAKS, PURCHASE_ROLES, ROLES, WHOLE_DOUBLE, table,
)
from logassay.sources import scratch, storage, tables
from logassay.sources.registry import Registry, declared_outputs, is_readable
from logassay.streaming.ingest import ingest_new_files

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = dict(recommender.QUERIES)

# Fixed values of the registered checks.
SPLITS = (
    DayRange("train", 20240101, 20240107),
    DayRange("train", 20240114, 20240120),
    DayRange("validate", 20240121, 20240123),
    DayRange("test", 20240128, 20240207),
)
SEQUENCE_LENGTH = 10
SEGMENTS = 3
RATES = (0.5, 1.0)
CUT_BYTES = 40
GIVEN = (
    "benchmark", "conversations", "customer", "documents", "embeddings", "events", "labels", "lineitem",
    "nation", "orders", "pages", "part", "region", "supplier",
)
LACKING = "vanished"
TRAINED_BEFORE, TOP = 20240121, 10
# Totals measured once at sf0.01: there they must come out again, at other sizes the rule fails.
PUBLISHED = {"dup_pairs": 2407, "removed_dups": 456}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


# ---------------------------------------------------------------- ingest and contract


def _csv_folder(spark: SparkSession, sf_dir: str) -> str:
    path = scratch.scratch_path(spark, "csv")
    inputs.raw_log(spark, sf_dir).write.option("header", True).csv(path)
    return path


@query
def typed_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole log written as CSV, then ingested to typed Parquet."""
    source = _csv_folder(spark, sf_dir)
    return tables.ingest(spark, source, scratch.scratch_path(spark, "table"))


@query
def incremental_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through the file stream, which ends when all present files are in."""
    target = scratch.scratch_path(spark, "table")
    ingest_new_files(
        spark, _csv_folder(spark, sf_dir), target, scratch.scratch_path(spark, "progress")
    ).awaitTermination()
    return spark.read.parquet(target)


def _damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.typed(inputs.damaged_cells(spark, sf_dir), ROLES)


@query
def damaged_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The damaged cells written as CSV and ingested: bad cells become null, no row is lost."""
    path = scratch.scratch_path(spark, "csv")
    inputs.damaged_cells(spark, sf_dir).write.option("header", True).csv(path)
    return tables.ingest(spark, path, scratch.scratch_path(spark, "table"))


@query
def damaged_day_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = inputs.damaged_cells(spark, sf_dir)
    parsers = {"whole_number": tables.whole_day(F.col("day")), "any_number": F.col("day").try_cast("double")}
    return contract.parse_loss(raw, "day", parsers)


@query
def damaged_clock_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("wall_time")
    parsers = {"any_fraction": clock.parse_wall_clock(text), "three_digits": clock.parse_fixed_fraction(text, 3)}
    return contract.parse_loss(inputs.damaged_cells(spark, sf_dir), "wall_time", parsers)


@query
def damaged_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract.offset_profile(_damaged(spark, sf_dir), ROLES)


@query
def damaged_epoch_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.epoch_date_consistency(_damaged(spark, sf_dir), ROLES)


@query
def damaged_day_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Steps between the valid days of a column that also holds impossible ones."""
    steps = calendar.day_steps(_damaged(spark, sf_dir), "day")
    return steps.select(clock.day_key(F.col("day_date")).alias("day"), "days_since_previous")


@query
def damaged_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = duplicates.daily_dup_structure(_damaged(spark, sf_dir), ROLES)
    return duplicates.neighbour_deviation(daily, ROLES)


@query
def storage_footprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target = _csv_folder(spark, sf_dir), scratch.scratch_path(spark, "table")
    parquet = tables.ingest(spark, source, target)
    csv = tables.read_csv(spark, source, tables.raw_schema(ROLES))
    return storage.storage_footprint(csv, parquet)


@query
def table_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract.table_contract(inputs.log(spark, sf_dir), ROLES.columns, ROLES)


@query
def null_excess(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = inputs.raw_log(spark, sf_dir)
    narrow = raw.withColumn("wall_time", clock.parse_fixed_fraction(F.col("wall_time"), 3))
    return contract.null_excess(narrow, "wall_time", "day")


@query
def parse_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("wall_time")
    parsers = {
        "any_fraction": clock.parse_wall_clock(text),
        "three_digits": clock.parse_fixed_fraction(text, 3),
    }
    return contract.parse_loss(inputs.raw_log(spark, sf_dir), "wall_time", parsers)


@query
def parse_failure_by_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    narrow = clock.parse_fixed_fraction(F.col("wall_time"), 3)
    return contract.parse_failure_by_length(inputs.raw_log(spark, sf_dir), "wall_time", narrow)


@query
def offset_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract.offset_profile(inputs.log(spark, sf_dir), ROLES)


@query
def offset_profile_wrong_clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The check seen failing: the order date taken as clock of the ship date's epoch."""
    return contract.offset_profile(_shipping(spark, sf_dir), ROLES, 0)


@query
def first_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract.first_offsets(_shipping(spark, sf_dir), ROLES, 0)


def _shipping(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    shipped = clock.epoch_micros(F.col("l_shipdate").cast("timestamp_ntz")).cast("double")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("o_orderdate").cast("timestamp_ntz").alias("wall_time"),
        (shipped / F.lit(1_000_000.0)).alias("epoch_s"),
    )


@query
def clock_conversions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row-level clock arithmetic over all events."""
    epoch = F.col("epoch_s")
    seconds = clock.epoch_to_clock_seconds(epoch, inputs.ZONE_SHIFT_S)
    return inputs.log(spark, sf_dir).select(
        "user_id",
        "item_id",
        clock.epoch_to_clock(epoch).alias("utc_time"),
        seconds.alias("local_seconds"),
        clock.day_key(seconds).alias("local_day"),
        clock.day_key_to_date(F.col("day")).cast("string").alias("day_date"),
        clock.millis_between(F.col("wall_time"), seconds).alias("cut_ms"),
        F.datediff(clock.day_key_to_date(F.col("day")), F.lit("2024-01-01").cast("date"))
        .cast("bigint")
        .alias("days_since_new_year"),
    )


# ---------------------------------------------------------------- profile


@query
def scale_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.scale_profile(inputs.log(spark, sf_dir), ROLES)


@query
def scale_profile_control(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.scale_profile(inputs.control(spark, sf_dir), ROLES)


@query
def measure_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.measure_profile(inputs.log(spark, sf_dir), "ratio")


@query
def measure_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.measure_quantiles(table(spark, sf_dir, "lineitem"), "l_extendedprice")


@query
def approximate_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.approximate_quantiles(table(spark, sf_dir, "lineitem"), "l_extendedprice")


@query
def user_longtail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.long_tail(inputs.log(spark, sf_dir), "user_id")


@query
def item_longtail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.long_tail(inputs.purchases(spark, sf_dir), "item_id")


@query
def cold_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.rare_keys(inputs.purchases(spark, sf_dir), "item_id", 30)


@query
def ratio_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.ratio_consistency(inputs.log(spark, sf_dir), ROLES)


@query
def date_time_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.date_time_consistency(inputs.log(spark, sf_dir), ROLES)


@query
def daily_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.daily_activity(inputs.control(spark, sf_dir), ROLES)


@query
def daily_activity_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.daily_activity_stats(inputs.control(spark, sf_dir), ROLES)


@query
def label_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.label_shares(inputs.log(spark, sf_dir), "ratio", RATES)


# ---------------------------------------------------------------- coverage and comparison


@query
def matrix_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.matrix_coverage(inputs.grid(spark, sf_dir), GRID_ROLES)


@query
def matrix_coverage_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.matrix_coverage(inputs.purchases(spark, sf_dir), PURCHASE_ROLES)


@query
def feature_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers, parts = table(spark, sf_dir, "customer"), table(spark, sf_dir, "part")
    sold = table(spark, sf_dir, "lineitem").select("l_partkey")
    return coverage.feature_coverage(
        customers, "c_custkey", table(spark, sf_dir, "orders"), "o_custkey", "orders"
    ).unionByName(coverage.feature_coverage(sold, "l_partkey", parts, "p_partkey", "part"))


@query
def day_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.day_overlap(
        inputs.order_days(spark, sf_dir), "day", inputs.ship_days(spark, sf_dir), "day"
    )


@query
def day_availability(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.day_availability(
        inputs.order_days(spark, sf_dir), "day", inputs.ship_days(spark, sf_dir), "day"
    )


def _customers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str, DataFrame, str]:
    return table(spark, sf_dir, "customer"), "c_custkey", table(spark, sf_dir, "orders"), "o_custkey"


@query
def user_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.key_subset(*_customers(spark, sf_dir))


@query
def subset_offenders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.subset_offenders(
        table(spark, sf_dir, "documents"), "doc_id", table(spark, sf_dir, "labels"), "doc_id"
    )


@query
def key_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.key_union(*_customers(spark, sf_dir))


@query
def shared_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.shared_keys(
        table(spark, sf_dir, "documents"), "doc_id", table(spark, sf_dir, "labels"), "doc_id"
    )


@query
def missing_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.missing_keys(
        table(spark, sf_dir, "documents"), "doc_id", table(spark, sf_dir, "labels"), "doc_id"
    )


# ---------------------------------------------------------------- calendar


@query
def day_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = calendar.day_steps(inputs.log(spark, sf_dir), "day")
    return steps.select(clock.day_key(F.col("day_date")).alias("day"), "days_since_previous")


@query
def date_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar.date_segments(inputs.log(spark, sf_dir), "day")


@query
def date_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar.date_gaps(inputs.log(spark, sf_dir), "day")


@query
def user_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar.date_segments(inputs.log(spark, sf_dir), "day", ["user_id"])


@query
def user_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar.date_gaps(inputs.log(spark, sf_dir), "day", ["user_id"])


@query
def time_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar.split_summary(inputs.log(spark, sf_dir), "day", "user_id", SPLITS)


# ---------------------------------------------------------------- anomalies and duplicates


@query
def exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicates.exact_duplicates(inputs.log(spark, sf_dir))


@query
def duplicate_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicates.duplicate_pairs(inputs.log(spark, sf_dir), ROLES)


@query
def duplicate_pairs_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicates.duplicate_pairs(inputs.purchases(spark, sf_dir), PURCHASE_ROLES)


@query
def over_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.over_duration(inputs.log(spark, sf_dir), ROLES)


@query
def zero_denominator(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.zero_denominator(inputs.log(spark, sf_dir), ROLES)


@query
def epoch_date_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.epoch_date_consistency(inputs.log(spark, sf_dir), ROLES)


def given_tables(sf_dir: str) -> Registry:
    """All given tables as datasets of a registry, and one whose table was never written."""
    datasets = {n: {"csv": f"{n}.csv", "parquet": f"{n}.parquet"} for n in (*GIVEN, LACKING)}
    return Registry({"root": sf_dir, "datasets": datasets})


@query
def declared_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sweep over the registry: is each declared table there, and the rows and columns of those that are."""
    registry = given_tables(sf_dir)
    sizes = [
        registry.table(spark, n).agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(n).alias("dataset"), "rows", F.lit(len(registry.table(spark, n).columns)).cast("bigint").alias("columns")
        )
        for n in registry.names
        if is_readable(spark, registry.dataset(n).parquet)
    ]
    found = declared_outputs(spark, registry).select(
        F.regexp_extract("check_id", "[^.]+$", 0).alias("dataset"), "check_id", "verdict"
    )
    return found.join(verdict.combine(sizes), "dataset", "left").select("check_id", "verdict", "rows", "columns")


@query
def utf8_cut_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts in consecutive pieces of a fixed number of bytes, which may cut a character in two."""
    checked = []
    for name in ("documents", "conversations"):
        pieces = text.byte_pieces(F.col("text"), CUT_BYTES)
        cut = table(spark, sf_dir, name).select(F.explode_outer(pieces).alias("text"))
        checked.append(
            quality.utf8_validity(cut, ["text"]).select(
                F.lit(name).alias("table_name"), "rows", "column_name", "null_rows", "invalid_rows"
            )
        )
    return checked[0].unionByName(checked[1])


@query
def utf8_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = {
        "documents": ("text", "lang", "source"),
        "pages": ("url", "html"),
        "conversations": ("role", "text"),
    }
    checked = [
        quality.utf8_validity(table(spark, sf_dir, name), columns).select(
            F.lit(name).alias("table_name"), "*"
        )
        for name, columns in sources.items()
    ]
    return verdict.combine(checked)


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicates.daily_dup_structure(inputs.log(spark, sf_dir), ROLES)


@query
def daily_dup_structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _daily(spark, sf_dir)


@query
def pair_value_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicates.pair_value_conflicts(_daily(spark, sf_dir), ROLES)


@query
def repeat_intensity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicates.repeat_intensity(_daily(spark, sf_dir), ROLES)


@query
def dedup_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicates.dedup_ladder(inputs.log(spark, sf_dir), ROLES, PEAKS)


@query
def dup_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicates.dup_summary(inputs.log(spark, sf_dir), ROLES)


@query
def peak_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicates.peak_days(_daily(spark, sf_dir), ROLES)


@query
def peak_neighbors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicates.peak_neighbors(_daily(spark, sf_dir), ROLES, PEAKS)


@query
def neighbour_deviation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicates.neighbour_deviation(_daily(spark, sf_dir), ROLES)


@query
def double_write_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicates.double_write_days(_daily(spark, sf_dir), ROLES)


@query
def outlier_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicates.outlier_ratio(_daily(spark, sf_dir), ROLES)


@query
def dup_localization(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicates.dup_localization(_daily(spark, sf_dir), ROLES, PEAKS)


@query
def control_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicates.control_duplicates(inputs.control(spark, sf_dir), ROLES, PEAKS)


# ---------------------------------------------------------------- dedupe and sequences


@query
def dedupe_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.drop_exact(inputs.log(spark, sf_dir))


@query
def dedupe_last_of_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.keep_last(inputs.log(spark, sf_dir), ROLES, within_day=True)


@query
def dedupe_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.keep_last(inputs.log(spark, sf_dir), ROLES)


@query
def dedupe_highest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.keep_highest(inputs.log(spark, sf_dir), ROLES)


@query
def dedupe_folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.fold_pairs(inputs.log(spark, sf_dir), ROLES)


@query
def segment_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequences.segment_sequences(inputs.log(spark, sf_dir), ROLES)


@query
def newest_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequences.newest_sequences(inputs.log(spark, sf_dir), ROLES, SEQUENCE_LENGTH)


@query
def sequence_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """On the damaged log: events without a run are counted, not lost."""
    return sequences.sequence_losses(_damaged(spark, sf_dir), ROLES)


@query
def point_in_time_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily item totals of the control events, as known before each exposure day."""
    totals = (
        inputs.control(spark, sf_dir)
        .where(F.col("day").isNotNull())
        .groupBy("item_id", "day")
        .agg(F.count(F.lit(1)).alias("shows"), F.sum("played_ms").alias("played"))
    )
    return sequences.point_in_time_features(
        inputs.log(spark, sf_dir), ROLES, totals, "item_id", "day", ["shows", "played"]
    )


@query
def popular_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.popular_items(inputs.log(spark, sf_dir), ROLES, TRAINED_BEFORE, TOP)


@query
def ranking_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The popular items as everyone's list, against what users did from that day on."""
    log = inputs.log(spark, sf_dir)
    top = ranking.popular_items(log, ROLES, TRAINED_BEFORE, TOP)
    later = log.where(F.col("day") >= TRAINED_BEFORE)
    return ranking.ranking_metrics(ranking.ranked_relevant(later, top, ROLES, TOP), "user_id", TOP)


# ---------------------------------------------------------------- verdicts


def _audit(spark: SparkSession, sf_dir: str) -> suites.Audit:
    return suites.Audit(inputs.log(spark, sf_dir), ROLES)


def _contract(spark: SparkSession, sf_dir: str, audit: suites.Audit) -> list[DataFrame]:
    facts = suites.contract_facts(audit, ROLES.columns)
    return [verdict.judge(facts, "contract.log", suites.CONTRACT_RULES)]


def _profile(spark: SparkSession, sf_dir: str, audit: suites.Audit) -> list[DataFrame]:
    seen = coverage.matrix_coverage(inputs.grid(spark, sf_dir), GRID_ROLES)
    sold = coverage.matrix_coverage(inputs.purchases(spark, sf_dir), PURCHASE_ROLES)
    features = feature_coverage(spark, sf_dir)
    return [
        verdict.judge(suites.profile_facts(audit), "profile.log", suites.PROFILE_RULES),
        verdict.judge(seen, "profile.grid", suites.coverage_rules()),
        verdict.judge(sold, "profile.purchases", suites.coverage_rules()),
        *[
            verdict.judge(features.where(F.col("source") == s), f"profile.{s}", suites.FEATURE_RULES)
            for s in ("orders", "part")
        ],
        verdict.judge(day_overlap(spark, sf_dir), "profile.order_ship", suites.OVERLAP_RULES),
    ]


def _anomaly(spark: SparkSession, sf_dir: str, audit: suites.Audit) -> list[DataFrame]:
    return [verdict.judge(suites.anomaly_facts(audit), "anomaly.log", suites.ANOMALY_RULES)]


def _diff(spark: SparkSession, sf_dir: str, audit: suites.Audit) -> list[DataFrame]:
    runs = suites.segment_facts(audit.daily, ROLES.day)
    return [
        verdict.judge(user_subset(spark, sf_dir), "diff.customers", suites.SUBSET_RULES),
        verdict.judge(day_overlap(spark, sf_dir), "diff.order_ship", suites.AVAILABILITY_RULES),
        verdict.judge(runs, "diff.log", suites.segment_rules(SEGMENTS)),
    ]


def _peak(spark: SparkSession, sf_dir: str, audit: suites.Audit) -> list[DataFrame]:
    facts = suites.peak_facts(audit, PARTIAL_DOUBLE, WHOLE_DOUBLE)
    rules = suites.peak_rules(PARTIAL_DOUBLE, WHOLE_DOUBLE, PUBLISHED)
    control = duplicates.control_duplicates(inputs.control(spark, sf_dir), ROLES)
    return [
        verdict.judge(facts, "peak.log", rules),
        verdict.judge(control, "peak.control", suites.CONTROL_RULES),
    ]


SUITES = (_contract, _profile, _anomaly, _diff, _peak)


@query
def contract_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdict.combine(_contract(spark, sf_dir, _audit(spark, sf_dir)))


@query
def profile_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdict.combine(_profile(spark, sf_dir, _audit(spark, sf_dir)))


@query
def anomaly_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdict.combine(_anomaly(spark, sf_dir, _audit(spark, sf_dir)))


@query
def diff_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdict.combine(_diff(spark, sf_dir, _audit(spark, sf_dir)))


@query
def peak_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdict.combine(_peak(spark, sf_dir, _audit(spark, sf_dir)))


@query
def control_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract, profile and anomaly rules over the control log, whose rows partly lack clock and day."""
    audit = suites.Audit(inputs.control(spark, sf_dir), ROLES)
    return verdict.combine([
        verdict.judge(suites.contract_facts(audit, ROLES.columns), "contract.control", suites.CONTRACT_RULES),
        verdict.judge(suites.profile_facts(audit), "profile.control", suites.PROFILE_RULES),
        verdict.judge(suites.anomaly_facts(audit), "anomaly.control", suites.ANOMALY_RULES),
    ])


@query
def verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All five suites in one PASS/FAIL table, over one shared audit of the log."""
    audit = _audit(spark, sf_dir)
    return verdict.combine([v for suite in SUITES for v in suite(spark, sf_dir, audit)])


@query
def verdict_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdict.summarize(verdicts(spark, sf_dir))
