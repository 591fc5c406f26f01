"""DuckDB SQL giving the same result as each registered query, from the same tables.

Written against the tables themselves; only the wording of rules and evidence
is shared with the Spark side.
"""

from __future__ import annotations

from collections.abc import Sequence

from logassay.operators.verdict import Rule
from logassay.plans import suites
from logassay.plans.catalog import (
    CUT_BYTES, GIVEN, LACKING, PUBLISHED, RATES, SEGMENTS, SEQUENCE_LENGTH, SPLITS, TOP, TRAINED_BEFORE,
)
from logassay.plans.inputs import PARTIAL_DOUBLE, PEAKS, WHOLE_DOUBLE
from logassay.plans.recommender_sql import recommender_sql

A, B = PARTIAL_DOUBLE, WHOLE_DOUBLE
COLUMNS = "user_id, item_id, played_ms, length_ms, wall_time, day, epoch_s, ratio"

EXPOSURES = """
clocked AS (
  SELECT event_type AS kind, user_id,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS item_id,
         CAST(floor(value * 100) AS BIGINT) AS played_ms,
         epoch_us(ts) // 1000 + 86400000 * CASE
           WHEN ts + INTERVAL 8 HOUR >= TIMESTAMP '2024-01-21' THEN 7
           WHEN ts + INTERVAL 8 HOUR >= TIMESTAMP '2024-01-11' THEN 3
           ELSE 0 END AS millis
  FROM events),
timed AS (
  SELECT *, CASE WHEN kind <> 'signup' THEN item_id * 250 END AS length_ms,
         make_timestamp(millis * 1000) AS utc,
         make_timestamp((millis + 28800000) * 1000) AS wall_time,
         CAST(millis AS DOUBLE) / CAST(1000 AS DOUBLE) AS epoch_s
  FROM clocked),
rated AS (
  SELECT *, CASE WHEN length_ms > 0
                 THEN CAST(played_ms AS DOUBLE) / CAST(length_ms AS DOUBLE) END AS exact
  FROM timed),
exposures AS (
  SELECT kind, user_id, item_id, played_ms, length_ms, wall_time,
         CAST(strftime(CASE WHEN kind = 'error' THEN utc ELSE wall_time END, '%Y%m%d') AS BIGINT) AS day,
         epoch_s, CASE WHEN kind = 'error' THEN floor(exact * 10) / 10 ELSE exact END AS ratio
  FROM rated)"""

LOG = f"""{EXPOSURES},
log AS (
  SELECT {COLUMNS} FROM exposures
  UNION ALL SELECT {COLUMNS} FROM exposures WHERE day = {B}
  UNION ALL SELECT user_id, item_id, CASE WHEN kind = 'purchase' THEN played_ms + 1 ELSE played_ms END,
                   length_ms, wall_time, day, epoch_s, ratio
            FROM exposures WHERE day = {A} AND kind IN ('view', 'click', 'purchase'))"""

CONTROL = f"""{EXPOSURES},
control AS (
  SELECT user_id, item_id, played_ms, length_ms,
         CASE WHEN kind <> 'signup' THEN wall_time END AS wall_time,
         CASE WHEN kind <> 'signup' THEN day END AS day,
         CASE WHEN kind <> 'signup' THEN epoch_s END AS epoch_s, ratio
  FROM exposures)"""

# The control log after its damage: what each spoiled cell must come out as.
DAMAGED = f"""{CONTROL},
spoiled AS (
  SELECT *, user_id % 11 AS turn,
         CASE WHEN day IS NULL THEN NULL WHEN user_id % 11 = 1 THEN '1e30' WHEN user_id % 11 = 2 THEN 'NaN'
              WHEN user_id % 11 = 3 THEN CAST(day AS VARCHAR) || '.7'
              WHEN user_id % 11 = 4 THEN CAST(day AS VARCHAR) || '.0'
              WHEN user_id % 11 = 5 THEN '2024023' || CAST(item_id % 3 AS VARCHAR)
              ELSE CAST(day AS VARCHAR) END AS day_cell,
         CASE WHEN wall_time IS NOT NULL AND user_id % 11 = 9 THEN 'no clock'
              ELSE CAST(wall_time AS VARCHAR) END AS clock_cell,
         CASE WHEN epoch_s IS NULL THEN NULL WHEN user_id % 11 = 6 THEN CAST('NaN' AS DOUBLE)
              WHEN user_id % 11 = 7 THEN 1e300 WHEN user_id % 11 = 8 THEN CAST('Infinity' AS DOUBLE)
              ELSE epoch_s END AS epoch_cell
  FROM control),
damaged AS (
  SELECT user_id, item_id, played_ms, length_ms,
         CASE WHEN turn <> 9 THEN wall_time END AS wall_time,
         CASE WHEN regexp_full_match(day_cell, '[0-9]{{8}}([.]0)?')
              THEN CAST(substr(day_cell, 1, 8) AS BIGINT) END AS day,
         epoch_cell AS epoch_s, ratio
  FROM spoiled)"""
SOUND = "epoch_s IS NOT NULL AND NOT isnan(epoch_s) AND epoch_s BETWEEN -62135510400 AND 253402214399"
TRY_DATE = "CAST(try_strptime(CAST({} AS VARCHAR), '%Y%m%d') AS DATE)"

PURCHASES = """
purchases AS (
  SELECT o_custkey AS user_id, l_partkey AS item_id FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

DAYKEY = "CAST(strftime({}, '%Y%m%d') AS BIGINT)"
TO_DATE = "CAST(strptime(CAST({} AS VARCHAR), '%Y%m%d') AS DATE)"

PAIR_DAYS = """
pair_days AS (
  SELECT day, user_id, item_id, count(*) AS rows,
         count(DISTINCT (played_ms, length_ms, wall_time, epoch_s, ratio)) AS uniq_rows
  FROM {} GROUP BY day, user_id, item_id)"""

DAILY = f"""{PAIR_DAYS.format("log")},
daily AS (
  SELECT day, CAST(sum(rows) AS BIGINT) AS rows, CAST(sum(uniq_rows) AS BIGINT) AS uniq_rows,
         count(*) AS distinct_pairs,
         CAST(coalesce(sum(rows) FILTER (WHERE rows > 1), 0) AS BIGINT) AS dup_pair_rows,
         count(*) FILTER (WHERE rows > 1) AS dup_pairs,
         CAST(sum(rows) - sum(uniq_rows) AS BIGINT) AS removed_dups
  FROM pair_days GROUP BY day)"""

SEGMENTED = f"""
stepped AS (
  SELECT d, d - lag(d) OVER (ORDER BY d) AS step
  FROM (SELECT DISTINCT {TO_DATE.format("day")} AS d FROM log)),
numbered AS (
  SELECT d, CAST(sum(CASE WHEN step = 1 THEN 0 ELSE 1 END) OVER (ORDER BY d) AS BIGINT) AS segment
  FROM stepped),
segments AS (
  SELECT segment, min(d) AS a, max(d) AS b, count(*) AS days FROM numbered GROUP BY segment),
gaps AS (
  SELECT segment AS gap, b + 1 AS ga, lead(a) OVER (ORDER BY segment) - 1 AS gb FROM segments)"""

USER_SEGMENTED = f"""
stepped AS (
  SELECT user_id, d, d - lag(d) OVER (PARTITION BY user_id ORDER BY d) AS step
  FROM (SELECT DISTINCT user_id, {TO_DATE.format("day")} AS d FROM log)),
numbered AS (
  SELECT user_id, d, CAST(sum(CASE WHEN step = 1 THEN 0 ELSE 1 END)
                          OVER (PARTITION BY user_id ORDER BY d) AS BIGINT) AS segment
  FROM stepped),
segments AS (
  SELECT user_id, segment, min(d) AS a, max(d) AS b, count(*) AS days
  FROM numbered GROUP BY user_id, segment),
gaps AS (
  SELECT user_id, segment AS gap, b + 1 AS ga,
         lead(a) OVER (PARTITION BY user_id ORDER BY segment) - 1 AS gb FROM segments)"""

SHIPPING = """
shipping AS (
  SELECT epoch_us(o_orderdate) - epoch_us(l_shipdate) AS us
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

POPULAR = f"""
popular AS (
  SELECT row_number() OVER (ORDER BY users DESC, item_id) AS rank, item_id, users, rows
  FROM (SELECT item_id, count(DISTINCT user_id) AS users, count(*) AS rows FROM log
        WHERE day < {TRAINED_BEFORE} GROUP BY item_id)
  QUALIFY rank <= {TOP})"""

# What each level removes, counted row by row in the log: copies of a row, then rows after the
# first of a pair's day, then of a pair. Together they must leave one row for each pair.
LADDER_SUMS = f"""
sums AS (
  SELECT count(*) FILTER (WHERE c > 1) + count(*) FILTER (WHERE c = 1 AND d > 1)
           + count(*) FILTER (WHERE c = 1 AND d = 1 AND p > 1)
         = count(*) - (SELECT count(*) FROM (SELECT DISTINCT user_id, item_id FROM log)) AS adds_up
  FROM (
    SELECT c, d, row_number() OVER (PARTITION BY user_id, item_id, c = 1 AND d = 1) AS p FROM (
      SELECT *, row_number() OVER (PARTITION BY day, user_id, item_id, c = 1) AS d FROM (
        SELECT *, row_number() OVER (PARTITION BY {COLUMNS}) AS c FROM log))))"""

PROBABILITIES = (0.25, 0.50, 0.75, 0.90, 0.99)


def pct(part: str, whole: str, digits: int = 4) -> str:
    return (
        f"coalesce(round(CASE WHEN {whole} <> 0 THEN CAST({part} AS DOUBLE) / CAST({whole} AS DOUBLE)"
        f" END * 100, {digits}), 0.0)"
    )


def at_rank(p: float) -> str:
    return f"max(CASE WHEN rn = floor((n - 1) * CAST({p} AS DOUBLE) + 0.5) + 1 THEN v END)"


def ranked(source: str, column: str) -> str:
    return (
        f"(SELECT {column} AS v, row_number() OVER (ORDER BY {column}) AS rn, count(*) OVER () AS n"
        f" FROM {source} WHERE {column} IS NOT NULL)"
    )


def quantile_columns(digits: int | None) -> str:
    shown = "{}" if digits is None else f"round({{}}, {digits})"
    return ", ".join(f"{shown.format(at_rank(p))} AS p{round(p * 100)}" for p in PROBABILITIES)


def with_(ctes: str, select: str) -> str:
    return f"WITH {ctes}\n{select}"


def tail(source: str, key: str) -> str:
    counts = f"(SELECT {key}, count(*) AS c FROM {source} GROUP BY {key})"
    return f"""
SELECT count(*) AS keys, {quantile_columns(None)}, max(v) AS max,
       count(*) FILTER (WHERE v < 10) AS below_count,
       {pct("count(*) FILTER (WHERE v < 10)", "count(*)", 2)} AS below_pct,
       (SELECT count(*) FROM {source} WHERE {key} IS NULL) AS null_key_rows
FROM {ranked(counts, "c")}"""


def scale(source: str) -> str:
    return f"""
SELECT count(*) AS rows, count(DISTINCT user_id) AS users, count(DISTINCT item_id) AS items,
       count(DISTINCT day) AS days, min(day) AS day_min, max(day) AS day_max,
       count(*) FILTER (WHERE user_id IS NULL) AS user_nulls,
       count(*) FILTER (WHERE item_id IS NULL) AS item_nulls,
       count(*) FILTER (WHERE day IS NULL) AS day_nulls
FROM {source}"""


def coverage(source: str, item: str) -> str:
    return f"""
SELECT users, items, users * items AS expected_pairs, actual_pairs,
       users * items - actual_pairs AS gap,
       {pct("actual_pairs", "(users * items)")} AS coverage_pct, dup_pairs,
       (SELECT count(*) FROM {source} WHERE user_id IS NULL OR {item} IS NULL) AS keyless_rows
FROM (SELECT count(DISTINCT user_id) AS users, count(DISTINCT {item}) AS items,
             count(*) AS actual_pairs, count(*) FILTER (WHERE n > 1) AS dup_pairs
      FROM (SELECT user_id, {item}, count(*) AS n FROM {source}
            WHERE user_id IS NOT NULL AND {item} IS NOT NULL GROUP BY user_id, {item}))"""


def presence(left: str, right: str) -> str:
    return f"""
presence AS (
  SELECT coalesce(l.k, r.k) AS key, l.k IS NOT NULL AS in_left, r.k IS NOT NULL AS in_right
  FROM (SELECT DISTINCT {left}) l FULL JOIN (SELECT DISTINCT {right}) r ON l.k = r.k)"""


ORDER_SHIP = presence(
    f"{DAYKEY.format('o_orderdate')} AS k FROM orders", f"{DAYKEY.format('l_shipdate')} AS k FROM lineitem"
)
CUSTOMERS = presence("c_custkey AS k FROM customer", "o_custkey AS k FROM orders")
LABELLED = presence("doc_id AS k FROM documents", "doc_id AS k FROM labels")

OVERLAP = """
SELECT count(*) AS all_days, count(*) FILTER (WHERE in_left) AS left_days,
       count(*) FILTER (WHERE in_right) AS right_days,
       count(*) FILTER (WHERE in_left AND in_right) AS shared_days,
       count(*) FILTER (WHERE in_left AND NOT in_right) AS left_only,
       count(*) FILTER (WHERE in_right AND NOT in_left) AS right_only
FROM presence"""

SUBSET = """
SELECT count(*) AS all_keys, count(*) FILTER (WHERE in_left) AS left_keys,
       count(*) FILTER (WHERE in_right) AS right_keys,
       count(*) FILTER (WHERE in_left AND in_right) AS shared_keys,
       count(*) FILTER (WHERE in_left AND NOT in_right) AS left_only,
       count(*) FILTER (WHERE in_right AND NOT in_left) AS right_only,
       count(*) FILTER (WHERE in_left AND NOT in_right) = 0 AS is_subset
FROM presence"""

CONTRACT = """
SELECT CAST(8 AS BIGINT) AS columns, '' AS missing, '' AS surplus, true AS day_typed,
       true AS time_typed, count(*) AS rows, count(DISTINCT user_id) AS users,
       count(DISTINCT item_id) AS items, count(*) FILTER (WHERE day IS NULL) AS day_nulls,
       count(*) FILTER (WHERE wall_time IS NULL) AS time_nulls
FROM log"""

OFFSETS = f"""
offsets AS (SELECT CASE WHEN {SOUND} THEN epoch_us(wall_time) - CAST(round(epoch_s * 1000) AS BIGINT) * 1000 END AS us
            FROM {{}} WHERE wall_time IS NOT NULL AND epoch_s IS NOT NULL)"""
LOG_OFFSETS = OFFSETS.format("log")


def offset_profile(source: str, shift_us: int) -> str:
    return f"""
SELECT count(DISTINCT us // 1000) AS distinct_offsets, min(us // 1000) AS min_offset_ms,
       max(us // 1000) AS max_offset_ms, count(us) AS compared_rows, count(*) - count(us) AS invalid_rows,
       count(*) FILTER (WHERE us <> {shift_us}) AS deviating_rows,
       max(abs(us - {shift_us})) AS max_deviation_us
FROM {source}"""


MEASURE = f"""
SELECT count(ratio) AS measured, count(*) FILTER (WHERE ratio IS NULL) AS null_count,
       round(min(ratio), 6) AS min, round(max(ratio), 6) AS max, round(avg(ratio), 6) AS mean,
       count(*) FILTER (WHERE ratio > 1) AS gt1_count, count(*) FILTER (WHERE ratio = 0) AS eq0_count,
       {pct("count(*) FILTER (WHERE ratio > 1)", "count(ratio)")} AS gt1_pct,
       {pct("count(*) FILTER (WHERE ratio = 0)", "count(ratio)")} AS eq0_pct,
       (SELECT struct_pack({", ".join(f"p{round(p * 100)} := round({at_rank(p)}, 4)" for p in PROBABILITIES)})
        FROM {ranked("log", "ratio")}) AS q
FROM log"""

RATIO = """
SELECT count(*) FILTER (WHERE ok) AS ratio_eligible,
       count(*) FILTER (WHERE ok AND abs(CAST(played_ms AS DOUBLE) / CAST(length_ms AS DOUBLE) - ratio)
                        > CAST(0.01 AS DOUBLE)) AS ratio_mismatch
FROM (SELECT *, coalesce(played_ms IS NOT NULL AND ratio IS NOT NULL AND length_ms > 0, false) AS ok FROM log)"""

CLOCK = f"""
SELECT count(*) FILTER (WHERE wall_time IS NOT NULL AND day IS NOT NULL) AS clock_eligible,
       count(*) FILTER (WHERE {DAYKEY.format("wall_time")} <> day) AS clock_mismatch
FROM log"""

EPOCH_OF = f"""
SELECT count(*) FILTER (WHERE sound AND day IS NOT NULL) AS epoch_eligible,
       count(*) FILTER (WHERE {DAYKEY.format("make_timestamp(CAST(trunc(s + 28800) AS BIGINT) * 1000000)")}
                        <> day) AS epoch_mismatch,
       count(*) FILTER (WHERE epoch_s IS NOT NULL AND NOT sound) AS epoch_invalid
FROM (SELECT day, epoch_s, coalesce({SOUND}, false) AS sound, CASE WHEN {SOUND} THEN epoch_s END AS s FROM {{}})"""
EPOCH = EPOCH_OF.format("log")

OVER = """
SELECT count(*) FILTER (WHERE played_ms IS NOT NULL AND length_ms > 0) AS over_eligible,
       count(*) FILTER (WHERE length_ms > 0 AND played_ms > length_ms) AS over_rows
FROM log"""

ZERO = """
SELECT count(*) AS rows, count(*) FILTER (WHERE length_ms = 0) AS zero_rows,
       count(*) FILTER (WHERE length_ms IS NULL) AS null_rows
FROM log"""


def rated(name: str, facts: str) -> str:
    return f"SELECT *, {pct(f'{name}_mismatch', f'{name}_eligible')} AS {name}_pct FROM ({facts})"


DAY_STATS = """
SELECT count(day) AS days, CAST(coalesce(sum(n) FILTER (WHERE day IS NULL), 0) AS BIGINT) AS null_rows,
       min(n) FILTER (WHERE day IS NOT NULL) AS min_rows, max(n) FILTER (WHERE day IS NOT NULL) AS max_rows,
       round(avg(n) FILTER (WHERE day IS NOT NULL), 4) AS mean_rows,
       median(n) FILTER (WHERE day IS NOT NULL) AS median_rows
FROM (SELECT day, count(*) AS n FROM {} GROUP BY day)"""

SUMMARY = f"""
totals AS (
  SELECT user_id, item_id, sum(rows) AS rows, sum(uniq_rows) AS uniq_rows, count(*) AS pair_days,
         sum(CASE WHEN day IN ({A}, {B}) THEN uniq_rows - 1 ELSE 0 END) AS peak_surplus
  FROM pair_days GROUP BY user_id, item_id),
summary AS (
  SELECT CAST(sum(rows) AS BIGINT) AS total_rows, CAST(sum(uniq_rows) AS BIGINT) AS uniq_rows,
         CAST(sum(pair_days) AS BIGINT) AS pair_days, count(*) AS distinct_pairs,
         count(*) FILTER (WHERE rows > 1) AS dup_pairs,
         CAST(coalesce(sum(rows) FILTER (WHERE rows > 1), 0) AS BIGINT) AS dup_pair_rows,
         CAST(max(rows) AS BIGINT) AS max_repeat,
         CAST(sum(peak_surplus) AS BIGINT) AS peak_pair_removed
  FROM totals)"""

LADDER_FACTS = """
SELECT total_rows - uniq_rows AS exact_removed, uniq_rows - pair_days AS within_day_removed,
       pair_days - distinct_pairs AS cross_day_removed,
       (SELECT count(*) FROM log) - (SELECT count(*) FROM (SELECT DISTINCT user_id, item_id FROM log))
       = (total_rows - uniq_rows) + (uniq_rows - pair_days) + (pair_days - distinct_pairs) AS adds_up
FROM summary"""

NEIGHBOURS = f"""
around AS (
  SELECT p.peak_day,
         max(CASE WHEN d.day = p.peak_day THEN d.uniq_rows END) AS uniq_rows,
         count(*) FILTER (WHERE d.day <> p.peak_day) AS neighbours_found,
         CAST(sum(CASE WHEN d.day <> p.peak_day THEN d.removed_dups ELSE 0 END) AS BIGINT) AS neighbours_removed,
         avg(CASE WHEN d.day <> p.peak_day THEN d.uniq_rows END) AS mean
  FROM daily d JOIN (SELECT unnest([{A}, {B}]) AS peak_day) p
    ON abs({TO_DATE.format("d.day")} - {TO_DATE.format("p.peak_day")}) <= 1
  GROUP BY p.peak_day),
neighbours AS (
  SELECT CAST(peak_day AS BIGINT) AS peak_day, uniq_rows, neighbours_found, neighbours_removed,
         round(mean, 4) AS neighbour_mean, round(abs(uniq_rows - mean) / mean, 6) AS deviation,
         neighbours_found = 2 AND neighbours_removed = 0 AS neighbours_clean,
         abs(uniq_rows - mean) / mean <= 0.20 AS close_to_neighbours
  FROM around)"""

PEAKS_OF = """
SELECT 'removed_dups' AS metric, day AS peak_day, removed_dups AS peak_value
FROM (SELECT * FROM daily ORDER BY removed_dups DESC, day LIMIT 1)
UNION ALL SELECT 'rows', day, rows FROM (SELECT * FROM daily ORDER BY rows DESC, day LIMIT 1)
UNION ALL SELECT 'uniq_rows', day, uniq_rows FROM (SELECT * FROM daily ORDER BY uniq_rows DESC, day LIMIT 1)"""

DOUBLE = """
SELECT day, rows, removed_dups, dup_pair_rows, dup_pair_rows = rows AS all_in_dup_pairs,
       removed_dups * 2 = rows AS exactly_doubled FROM daily"""

OUTLIER = """
SELECT max_rows, median_rows, max_uniq, median_uniq, round(max_rows / median_rows, 6) AS ratio_before,
       round(max_uniq / median_uniq, 6) AS ratio_after, max_uniq / median_uniq <= 2.0 AS no_outlier_after
FROM (SELECT max(rows) AS max_rows, median(rows) AS median_rows, max(uniq_rows) AS max_uniq,
             median(uniq_rows) AS median_uniq FROM daily WHERE day IS NOT NULL)"""

LOCAL = f"""
SELECT *, {pct("other_pair_removed", "pair_removed", 2)} AS other_pair_pct,
       other_removed = 0 AND peak_removed = removed_dups AS copies_localized,
       other_pair_removed > 0 AS pair_dedupe_spreads
FROM (SELECT CAST(sum(removed_dups) AS BIGINT) AS removed_dups,
             CAST(sum(CASE WHEN day IN ({A}, {B}) THEN removed_dups ELSE 0 END) AS BIGINT) AS peak_removed,
             CAST(sum(CASE WHEN day IN ({A}, {B}) THEN 0 ELSE removed_dups END) AS BIGINT) AS other_removed,
             CAST(sum(rows - distinct_pairs) AS BIGINT) AS pair_removed,
             CAST(sum(CASE WHEN day IN ({A}, {B}) THEN uniq_rows - distinct_pairs ELSE 0 END) AS BIGINT)
               AS peak_pair_removed,
             CAST(sum(CASE WHEN day IN ({A}, {B}) THEN 0 ELSE uniq_rows - distinct_pairs END) AS BIGINT)
               AS other_pair_removed
      FROM daily)"""


def control_scope(name: str, where: str) -> str:
    return f"""
SELECT '{name}' AS scope, (SELECT count(*) FROM control WHERE {where}) AS rows,
       (SELECT count(*) FROM control WHERE {where})
       - (SELECT count(*) FROM (SELECT DISTINCT * FROM control WHERE {where})) AS removed_dups,
       (SELECT count(*) FROM (SELECT user_id, item_id FROM control WHERE {where}
                              GROUP BY user_id, item_id HAVING count(*) > 1)) AS dup_pairs"""


CONTROL_SCOPES = " UNION ALL ".join(
    [control_scope("all", "true"), *[control_scope(str(d), f"day = {d}") for d in PEAKS]]
)


def best_row(keys: str, first: str) -> str:
    ties = ", ".join(
        f"{c} DESC NULLS LAST" for c in COLUMNS.split(", ") if c not in keys.split(", ")
    )
    return f"""
SELECT {COLUMNS} FROM (
  SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {first} DESC NULLS LAST, {ties}) AS rn FROM log)
WHERE rn = 1"""


def feature(name: str, columns: int, date: str | None, source: str, key: str, base: str, base_key: str) -> str:
    shown = f"strftime({{}}({date}), '%Y-%m-%d %H:%M:%S')" if date else "CAST(NULL AS VARCHAR)"
    covered = f"(SELECT count(DISTINCT {base_key}) FROM {base} WHERE {base_key} IN (SELECT {key} FROM {source}))"
    wanted = f"(SELECT count(DISTINCT {base_key}) FROM {base})"
    return f"""
SELECT '{name}' AS source, CAST({columns} AS BIGINT) AS columns,
       {f"'{date}'" if date else "CAST(NULL AS VARCHAR)"} AS date_column,
       count(*) AS rows, count(DISTINCT {key}) AS items,
       {shown.format("min") if date else shown} AS date_min, {shown.format("max") if date else shown} AS date_max,
       {wanted} AS base_items, {covered} AS covered_items, {pct(covered, wanted, 2)} AS coverage_pct
FROM {source}"""


FEATURES = {
    "orders": feature("orders", 6, "o_orderdate", "orders", "o_custkey", "customer", "c_custkey"),
    "part": feature("part", 6, None, "part", "p_partkey", "lineitem", "l_partkey"),
}


def cut_bytes(source: str, column: str, size: int) -> str:
    """Pieces that begin or end inside a character: their first byte, or the one after their last, continues one."""
    pieces = f"greatest(ceil(octet_length(encode({column})) / CAST({size} AS DOUBLE)), 1)"
    inner = "SUBSTR(h, 2 * k * {0} + 1, 1) IN ('8', '9', 'A', 'B')".format(size)
    after = "SUBSTR(h, 2 * (k + 1) * {0} + 1, 1) IN ('8', '9', 'A', 'B')".format(size)
    return f"""
SELECT '{source}' AS table_name, count(*) AS rows, '{column}' AS column_name,
       count(*) FILTER (WHERE h IS NULL) AS null_rows, count(*) FILTER (WHERE {inner} OR {after}) AS invalid_rows
FROM (SELECT hex(encode({column})) AS h, unnest(range(CAST(coalesce({pieces}, 1) AS BIGINT))) AS k FROM {source})"""


def split_case() -> str:
    whens = " ".join(f"WHEN day BETWEEN {r.first} AND {r.last} THEN '{r.name}'" for r in SPLITS)
    return f"CASE {whens} ELSE 'quarantine' END"


def share(t: float) -> str:
    above, at = f"count(*) FILTER (WHERE ratio > {t})", f"count(*) FILTER (WHERE ratio >= {t})"
    return f"""
SELECT count(ratio) AS measured, CAST({t} AS DOUBLE) AS threshold, {above} AS above, {at} AS at_or_above,
       {pct(above, "count(ratio)")} AS above_pct, {pct(at, "count(ratio)")} AS at_or_above_pct FROM log"""


def utf8(source: str, column: str) -> str:
    # DuckDB refuses invalid text on load, so every value it holds is valid.
    return f"""
SELECT '{source}' AS table_name, count(*) AS rows, '{column}' AS column_name,
       count(*) FILTER (WHERE {column} IS NULL) AS null_rows, CAST(0 AS BIGINT) AS invalid_rows FROM {source}"""


# ---------------------------------------------------------------- verdicts


def lost(cell: str, parsers: dict[str, str]) -> str:
    """Blank cells and cells that each test refuses, in the damaged log."""
    return " UNION ALL ".join(
        f"""
SELECT '{name}' AS parser, count(*) AS rows, count(*) FILTER (WHERE {cell} IS NULL) AS blank_rows,
       count(*) FILTER (WHERE NOT coalesce({test}, false)) AS parsed_nulls,
       count(*) FILTER (WHERE {cell} IS NOT NULL AND NOT {test}) AS lost_rows,
       {pct(f"count(*) FILTER (WHERE {cell} IS NOT NULL AND NOT {test})", "count(*)", 2)} AS lost_pct
FROM spoiled"""
        for name, test in parsers.items()
    )


# What each rule demands, written for these facts apart from the Spark side's wording.
HOLDS = {
    "columns": "columns = 8 AND length(missing || surplus) = 0",
    "day_type": "day_typed",
    "time_loss": "time_typed AND NOT time_nulls > day_nulls",
    "offset": "min_offset_ms = max_offset_ms",
    "offset_value": "compared_rows > 0 AND max_deviation_us = 0 OR compared_rows = 0",
    "scale": "least(rows, users, items) >= 1 AND day_max >= day_min",
    "user_tail": "user_max >= 1",
    "item_tail": "item_max >= 1",
    "ratio_spread": "measured >= 1",
    "ratio": "NOT ratio_mismatch > 0",
    "day_clock": "NOT clock_mismatch > 0",
    "daily": "max_rows >= 1",
    "observed": "CAST(actual_pairs AS HUGEINT) * 100 >= CAST(users AS HUGEINT) * items * 99",
    "covers": "covered_items >= 1",
    "overlap": "shared_days >= 1",
    "copies": "total_rows >= 1",
    "pairs": "distinct_pairs >= 1",
    "over": "over_eligible >= 1",
    "zero": "total_rows >= 1",
    "epoch_day": "NOT epoch_mismatch > 0",
    "subset": "left_keys = shared_keys",
    "days": "left_days + right_days >= 1",
    "segments": f"segments = {SEGMENTS} AND gaps + 1 = segments",
    "top_copies": f"removed_dups_day = {A}",
    "partial_neighbours": "partial_neighbours_removed = 0 AND partial_clean",
    "top_rows": f"rows_day = {A}",
    "top_uniq": f"uniq_rows_day IS DISTINCT FROM {A}",
    "partial_close": "partial_close",
    "whole_in_pairs": "whole_in_pairs",
    "whole_doubled": "whole_rows = whole_removed + whole_removed",
    "whole_close": "whole_close",
    "no_outlier": "no_outlier_after",
    "localized": "other_removed = 0 AND peak_removed = removed_dups",
    "spreads": "other_pair_removed >= 1",
    "ladder": "adds_up",
    "clean": "removed_dups = 0",
    "reproduced": " AND ".join(f"{k} IN ({v})" for k, v in PUBLISHED.items()),
}


def judged(subject: str, rules: Sequence[Rule], *facts: str) -> str:
    joined = ", ".join(f"({f}) AS f{i}" for i, f in enumerate(facts))
    rows = []
    for r in rules:
        evidence = ", ".join(
            f"'{', ' if i else ''}{c}=', coalesce(CAST({c} AS VARCHAR), 'null')"
            for i, c in enumerate(r.evidence)
        )
        rows.append(
            f"SELECT '{subject}.{r.check_id}' AS check_id, '{r.description}' AS description, "
            f"CASE WHEN coalesce({HOLDS[r.check_id]}, false) THEN 'PASS' ELSE 'FAIL' END AS verdict, "
            f"concat({evidence}) AS evidence FROM {subject.replace('.', '_')}"
        )
    return f"{subject.replace('.', '_')} AS (SELECT * FROM {joined})", " UNION ALL ".join(rows)


def _tail_of(prefix: str, source: str, key: str) -> str:
    names = ("keys", "p50", "max", "below_count")
    shown = ", ".join(f"{n} AS {prefix}_{n}" for n in names)
    return f"SELECT {shown} FROM ({tail(source, key)})"


SUITES = {
    "contract": [
        judged("contract.log", suites.CONTRACT_RULES, CONTRACT, offset_profile("offsets", 28_800_000_000)),
    ],
    "profile": [
        judged(
            "profile.log", suites.PROFILE_RULES,
            f"SELECT * EXCLUDE (days) FROM ({scale('log')})",
            _tail_of("user", "log", "user_id"), _tail_of("item", "log", "item_id"),
            f"SELECT measured, null_count, gt1_count, eq0_count FROM ({MEASURE})", RATIO, CLOCK,
            f"SELECT days, min_rows, max_rows FROM ({DAY_STATS.format('log')})",
        ),
        judged("profile.grid", suites.coverage_rules(), coverage("events", "event_type")),
        judged("profile.purchases", suites.coverage_rules(), coverage("purchases", "item_id")),
        judged("profile.orders", suites.FEATURE_RULES, FEATURES["orders"]),
        judged("profile.part", suites.FEATURE_RULES, FEATURES["part"]),
        judged("profile.order_ship", suites.OVERLAP_RULES, OVERLAP),
    ],
    "anomaly": [
        judged("anomaly.log", suites.ANOMALY_RULES, "SELECT * FROM summary", OVER,
               f"SELECT zero_rows, null_rows FROM ({ZERO})", EPOCH),
    ],
    "diff": [
        judged("diff.customers", suites.SUBSET_RULES, SUBSET.replace("FROM presence", "FROM customers")),
        judged("diff.order_ship", suites.AVAILABILITY_RULES, OVERLAP),
        judged(
            "diff.log", suites.segment_rules(SEGMENTS),
            "SELECT (SELECT count(*) FROM segments) AS segments,"
            " (SELECT count(*) FROM gaps WHERE gb IS NOT NULL) AS gaps,"
            " (SELECT CAST(coalesce(sum(gb - ga + 1), 0) AS BIGINT) FROM gaps WHERE gb IS NOT NULL) AS gap_days",
        ),
    ],
    "peak": [
        judged(
            "peak.log", suites.peak_rules(A, B, PUBLISHED),
            "SELECT max(CASE WHEN metric = 'removed_dups' THEN peak_day END) AS removed_dups_day,"
            " max(CASE WHEN metric = 'rows' THEN peak_day END) AS rows_day,"
            f" max(CASE WHEN metric = 'uniq_rows' THEN peak_day END) AS uniq_rows_day FROM ({PEAKS_OF})",
            "SELECT uniq_rows AS partial_uniq_rows, neighbours_removed AS partial_neighbours_removed,"
            " neighbours_clean AS partial_clean, close_to_neighbours AS partial_close"
            f" FROM neighbours WHERE peak_day = {A}",
            "SELECT uniq_rows AS whole_uniq_rows, close_to_neighbours AS whole_close"
            f" FROM neighbours WHERE peak_day = {B}",
            "SELECT rows AS whole_rows, removed_dups AS whole_removed, all_in_dup_pairs AS whole_in_pairs,"
            f" exactly_doubled AS whole_doubled FROM ({DOUBLE}) WHERE day = {B}",
            "SELECT dup_pairs FROM summary",
            f"SELECT max_uniq, no_outlier_after FROM ({OUTLIER})", LOCAL, LADDER_FACTS,
        ),
        judged("peak.control", suites.CONTROL_RULES, control_scope("all", "true")),
    ],
}

CUSTOMERS_AS = CUSTOMERS.replace("presence AS", "customers AS")
CONTROL_ONLY = CONTROL[len(EXPOSURES) + 1:]
NEEDS = {
    "contract": [LOG_OFFSETS],
    "profile": [PURCHASES, ORDER_SHIP],
    "anomaly": [DAILY, SUMMARY],
    "diff": [CUSTOMERS_AS, ORDER_SHIP, SEGMENTED],
    "peak": [DAILY, SUMMARY, NEIGHBOURS, CONTROL_ONLY],
}


def suite(*names: str) -> str:
    ctes: list[str] = [LOG]
    for name in names:
        ctes += [c for c in NEEDS[name] if c not in ctes]
    ctes += [cte for name in names for cte, _ in SUITES[name]]
    return with_(",".join(ctes), " UNION ALL ".join(rows for name in names for _, rows in SUITES[name]))


def control_suite() -> str:
    """The rules about one log over the control log, which takes the log's name here."""
    parts = [
        judged("contract.control", suites.CONTRACT_RULES, CONTRACT, offset_profile("offsets", 28_800_000_000)),
        judged(
            "profile.control", suites.PROFILE_RULES,
            f"SELECT * EXCLUDE (days) FROM ({scale('log')})",
            _tail_of("user", "log", "user_id"), _tail_of("item", "log", "item_id"),
            f"SELECT measured, null_count, gt1_count, eq0_count FROM ({MEASURE})", RATIO, CLOCK,
            f"SELECT days, min_rows, max_rows FROM ({DAY_STATS.format('log')})",
        ),
        judged("anomaly.control", suites.ANOMALY_RULES, "SELECT * FROM summary", OVER,
               f"SELECT zero_rows, null_rows FROM ({ZERO})", EPOCH),
    ]
    ctes = [CONTROL, f"log AS (SELECT {COLUMNS} FROM control)", LOG_OFFSETS, DAILY, SUMMARY, *[c for c, _ in parts]]
    return with_(",".join(ctes), " UNION ALL ".join(rows for _, rows in parts))


ALL_SUITES = ("contract", "profile", "anomaly", "diff", "peak")
LOG_DAILY = f"{LOG},{DAILY}"


def oracle() -> dict[str, str]:
    raw_text = f"{LOG}, raw AS (SELECT CAST(wall_time AS VARCHAR) AS t, day FROM log)"
    narrow = r"regexp_matches(t, '\.[0-9]{3}$')"
    q = {
        "typed_ingest": with_(LOG, f"SELECT {COLUMNS} FROM log"),
        "incremental_ingest": with_(LOG, f"SELECT {COLUMNS} FROM log"),
        "damaged_ingest": with_(DAMAGED, f"SELECT {COLUMNS} FROM damaged"),
        "damaged_day_loss": with_(DAMAGED, lost(
            "day_cell", {"whole_number": "regexp_full_match(day_cell, '[0-9]{8}([.]0)?')",
                         "any_number": "TRY_CAST(day_cell AS DOUBLE) IS NOT NULL"})),
        "damaged_clock_loss": with_(DAMAGED, lost(
            "clock_cell", {"any_fraction": "TRY_CAST(clock_cell AS TIMESTAMP) IS NOT NULL",
                           "three_digits": r"regexp_matches(clock_cell, '\.[0-9]{3}$')"})),
        "damaged_offsets": with_(
            f"{DAMAGED},{OFFSETS.format('damaged')}", offset_profile("offsets", 28_800_000_000)),
        "damaged_epoch_days": with_(DAMAGED, rated("epoch", EPOCH_OF.format("damaged"))),
        "damaged_day_steps": with_(DAMAGED, f"""
SELECT {DAYKEY.format("d")} AS day, d - lag(d) OVER (ORDER BY d) AS days_since_previous
FROM (SELECT DISTINCT {TRY_DATE.format("day")} AS d FROM damaged) WHERE d IS NOT NULL"""),
        "damaged_neighbours": with_(DAMAGED, f"""
SELECT a.day, a.uniq_rows, a_n AS neighbours, round(mean, 4) AS neighbour_mean,
       round(abs(a.uniq_rows - mean) / mean, 6) AS deviation
FROM (SELECT a.day, a.uniq_rows, count(b.day) AS a_n, avg(b.uniq_rows) AS mean
      FROM (SELECT day, count(*) AS uniq_rows FROM (SELECT DISTINCT * FROM damaged) GROUP BY day) a
      LEFT JOIN (SELECT day, count(*) AS uniq_rows FROM (SELECT DISTINCT * FROM damaged) GROUP BY day) b
        ON abs({TRY_DATE.format("a.day")} - {TRY_DATE.format("b.day")}) = 1
      WHERE a.day IS NOT NULL GROUP BY a.day, a.uniq_rows) a"""),
        "table_contract": with_(LOG, CONTRACT),
        "null_excess": with_(raw_text, f"""
SELECT rows, parsed_nulls, baseline_nulls, greatest(parsed_nulls - baseline_nulls, 0) AS lost_rows,
       {pct("greatest(parsed_nulls - baseline_nulls, 0)", "rows", 2)} AS lost_pct
FROM (SELECT count(*) AS rows, count(*) FILTER (WHERE NOT {narrow}) AS parsed_nulls,
             count(*) FILTER (WHERE day IS NULL) AS baseline_nulls FROM raw)"""),
        "parse_loss": with_(raw_text, f"""
SELECT parser, rows, CAST(0 AS BIGINT) AS blank_rows, lost_rows AS parsed_nulls, lost_rows,
       {pct("lost_rows", "rows", 2)} AS lost_pct
FROM (SELECT 'any_fraction' AS parser, count(*) AS rows,
             count(*) FILTER (WHERE TRY_CAST(t AS TIMESTAMP) IS NULL) AS lost_rows FROM raw
      UNION ALL
      SELECT 'three_digits', count(*), count(*) FILTER (WHERE NOT {narrow}) FROM raw)"""),
        "parse_failure_by_length": with_(raw_text, f"""
SELECT length(t) AS raw_length, count(*) AS rows, count(*) FILTER (WHERE NOT {narrow}) AS failed
FROM raw GROUP BY length(t)"""),
        "offset_profile": with_(f"{LOG},{LOG_OFFSETS}", offset_profile("offsets", 28_800_000_000)),
        "offset_profile_wrong_clock": with_(SHIPPING, offset_profile("shipping", 0)),
        "first_offsets": with_(SHIPPING, """
SELECT us // 1000 AS offset_ms, count(*) AS rows FROM shipping GROUP BY us // 1000 ORDER BY offset_ms LIMIT 5"""),
        "clock_conversions": with_(LOG, f"""
SELECT user_id, item_id, make_timestamp(CAST(round(epoch_s * 1000) AS BIGINT) * 1000) AS utc_time,
       date_trunc('second', wall_time) AS local_seconds, {DAYKEY.format("wall_time")} AS local_day,
       CAST({TO_DATE.format("day")} AS VARCHAR) AS day_date,
       (epoch_us(wall_time) - epoch_us(date_trunc('second', wall_time))) // 1000 AS cut_ms,
       CAST({TO_DATE.format("day")} - DATE '2024-01-01' AS BIGINT) AS days_since_new_year
FROM log"""),
        "scale_profile": with_(LOG, scale("log")),
        "scale_profile_control": with_(CONTROL, scale("control")),
        "measure_profile": with_(LOG, f"SELECT * EXCLUDE (q), q.* FROM ({MEASURE})".replace(
            "q.*", ", ".join(f"q.p{round(p * 100)} AS p{round(p * 100)}" for p in PROBABILITIES))),
        "measure_quantiles": " UNION ALL ".join(
            f"SELECT CAST({p} AS DOUBLE) AS p, {at_rank(p)} AS value FROM {ranked('lineitem', 'l_extendedprice')}"
            for p in PROBABILITIES),
        "user_longtail": with_(LOG, tail("log", "user_id")),
        "item_longtail": with_(PURCHASES, tail("purchases", "item_id")),
        "cold_items": with_(PURCHASES, """
SELECT item_id, count(*) AS n FROM purchases GROUP BY item_id HAVING count(*) < 30"""),
        "ratio_consistency": with_(LOG, rated("ratio", RATIO)),
        "date_time_consistency": with_(LOG, rated("clock", CLOCK)),
        "epoch_date_consistency": with_(LOG, rated("epoch", EPOCH)),
        "daily_activity": with_(CONTROL, """
SELECT day, count(*) AS interactions, count(DISTINCT user_id) AS active_users,
       count(DISTINCT item_id) AS active_items FROM control GROUP BY day"""),
        "daily_activity_stats": with_(CONTROL, DAY_STATS.format("control")),
        "label_shares": with_(LOG, " UNION ALL ".join(share(t) for t in RATES)),
        "matrix_coverage": coverage("events", "event_type"),
        "matrix_coverage_sparse": with_(PURCHASES, coverage("purchases", "item_id")),
        "feature_coverage": " UNION ALL ".join(FEATURES.values()),
        "day_overlap": with_(ORDER_SHIP, OVERLAP),
        "day_availability": with_(ORDER_SHIP, "SELECT key AS day, in_left, in_right FROM presence"),
        "user_subset": with_(CUSTOMERS, SUBSET),
        "key_union": with_(CUSTOMERS, "SELECT key FROM presence"),
        "subset_offenders": with_(
            LABELLED, "SELECT key FROM presence WHERE NOT in_right ORDER BY key LIMIT 10"),
        "shared_keys": with_(LABELLED, "SELECT key FROM presence WHERE in_left AND in_right"),
        "missing_keys": with_(LABELLED, "SELECT key FROM presence WHERE NOT in_right"),
        "day_steps": with_(f"{LOG},{SEGMENTED}", f"""
SELECT {DAYKEY.format("d")} AS day, step AS days_since_previous FROM stepped"""),
        "date_segments": with_(f"{LOG},{SEGMENTED}", f"""
SELECT segment, {DAYKEY.format("a")} AS first_day, {DAYKEY.format("b")} AS last_day, days FROM segments"""),
        "date_gaps": with_(f"{LOG},{SEGMENTED}", f"""
SELECT gap, {DAYKEY.format("ga")} AS gap_first, {DAYKEY.format("gb")} AS gap_last,
       CAST(gb - ga + 1 AS BIGINT) AS gap_days FROM gaps WHERE gb IS NOT NULL"""),
        "user_segments": with_(f"{LOG},{USER_SEGMENTED}", f"""
SELECT user_id, segment, {DAYKEY.format("a")} AS first_day, {DAYKEY.format("b")} AS last_day, days
FROM segments"""),
        "user_gaps": with_(f"{LOG},{USER_SEGMENTED}", f"""
SELECT user_id, gap, {DAYKEY.format("ga")} AS gap_first, {DAYKEY.format("gb")} AS gap_last,
       CAST(gb - ga + 1 AS BIGINT) AS gap_days FROM gaps WHERE gb IS NOT NULL"""),
        "time_split": with_(LOG, f"""
SELECT {split_case()} AS split, count(*) AS rows, count(DISTINCT user_id) AS users,
       count(DISTINCT day) AS days, min(day) AS first_day, max(day) AS last_day
FROM log GROUP BY 1"""),
        "exact_duplicates": with_(LOG, f"""
SELECT rows, uniq_rows, rows - uniq_rows AS removed_dups, {pct("(rows - uniq_rows)", "rows")} AS removed_pct
FROM (SELECT (SELECT count(*) FROM log) AS rows, (SELECT count(*) FROM (SELECT DISTINCT * FROM log)) AS uniq_rows)"""),
        "over_duration": with_(LOG, f"SELECT *, {pct('over_rows', 'over_eligible')} AS over_pct FROM ({OVER})"),
        "zero_denominator": with_(LOG, f"SELECT *, {pct('zero_rows', 'rows')} AS zero_pct FROM ({ZERO})"),
        "utf8_validity": " UNION ALL ".join(
            utf8(t, c) for t, c in (
                ("documents", "text"), ("documents", "lang"), ("documents", "source"), ("pages", "url"),
                ("pages", "html"), ("conversations", "role"), ("conversations", "text"))),
        "declared_tables": " UNION ALL ".join([
            f"SELECT 'contract.output.{n}' AS check_id, 'PASS' AS verdict, count(*) AS rows,"
            f" (SELECT count(*) FROM (DESCRIBE {n})) AS columns FROM {n}" for n in GIVEN
        ]) + f" UNION ALL SELECT 'contract.output.{LACKING}', 'FAIL', NULL, NULL",
        "utf8_cut_bytes": " UNION ALL ".join(
            cut_bytes(t, c, CUT_BYTES) for t, c in (("documents", "text"), ("conversations", "text"))),
        "daily_dup_structure": with_(LOG_DAILY, "SELECT * FROM daily"),
        "pair_value_conflicts": with_(LOG_DAILY, f"""
SELECT day, rows, uniq_rows - distinct_pairs AS conflict_rows,
       {pct("(uniq_rows - distinct_pairs)", "rows", 3)} AS conflict_pct FROM daily"""),
        "repeat_intensity": with_(LOG_DAILY, """
SELECT day, dup_pairs, dup_pair_rows,
       round(CASE WHEN dup_pairs > 0 THEN CAST(dup_pair_rows AS DOUBLE) / dup_pairs END, 3) AS rows_per_dup_pair
FROM daily"""),
        "dedup_ladder": with_(f"{LOG_DAILY},{SUMMARY},{LADDER_SUMS}", """
SELECT CAST(0 AS INTEGER) AS step, 'raw' AS stage, CAST(0 AS BIGINT) AS removed_rows,
       total_rows AS remaining_rows, adds_up FROM summary, sums
UNION ALL SELECT 1, 'exact copies', total_rows - uniq_rows, uniq_rows, adds_up FROM summary, sums
UNION ALL SELECT 2, 'pair within a day', uniq_rows - pair_days, pair_days, adds_up FROM summary, sums
UNION ALL SELECT 3, 'pair over all days', pair_days - distinct_pairs, distinct_pairs, adds_up FROM summary, sums"""),
        "dup_summary": with_(f"{LOG_DAILY},{SUMMARY}", """
SELECT total_rows, uniq_rows, total_rows - uniq_rows AS removed_dups, distinct_pairs, dup_pairs,
       dup_pair_rows, max_repeat FROM summary"""),
        "peak_days": with_(LOG_DAILY, PEAKS_OF),
        "peak_neighbors": with_(f"{LOG_DAILY},{NEIGHBOURS}", "SELECT * FROM neighbours"),
        "neighbour_deviation": with_(LOG_DAILY, f"""
SELECT day, uniq_rows, neighbours, round(mean, 4) AS neighbour_mean,
       round(abs(uniq_rows - mean) / mean, 6) AS deviation
FROM (SELECT a.day, a.uniq_rows, count(b.day) AS neighbours, avg(b.uniq_rows) AS mean
      FROM daily a LEFT JOIN daily b
        ON abs({TO_DATE.format("a.day")} - {TO_DATE.format("b.day")}) = 1
      GROUP BY a.day, a.uniq_rows)"""),
        "double_write_days": with_(LOG_DAILY, DOUBLE),
        "outlier_ratio": with_(LOG_DAILY, OUTLIER),
        "dup_localization": with_(LOG_DAILY, LOCAL),
        "control_duplicates": with_(CONTROL, CONTROL_SCOPES),
        "dedupe_exact": with_(LOG, "SELECT DISTINCT * FROM log"),
        "dedupe_last_of_day": with_(LOG, best_row("day, user_id, item_id", "wall_time")),
        "dedupe_last": with_(LOG, best_row("user_id, item_id", "wall_time")),
        "dedupe_highest": with_(LOG, best_row("user_id, item_id", "ratio")),
        "dedupe_folded": with_(LOG, """
SELECT user_id, item_id, count(*) AS rows, CAST(sum(played_ms) AS BIGINT) AS total_numerator,
       max(ratio) AS max_ratio, min(wall_time) AS first_time, max(wall_time) AS last_time
FROM log GROUP BY user_id, item_id"""),
        "segment_sequences": with_(f"{LOG},{SEGMENTED}", f"""
SELECT l.user_id, n.segment, l.wall_time, l.item_id
FROM log l LEFT JOIN numbered n ON {TO_DATE.format("l.day")} = n.d"""),
        "sequence_losses": with_(DAMAGED, f"""
SELECT count(*) AS events, count({TRY_DATE.format("day")}) AS in_a_run,
       count(*) FILTER (WHERE day IS NULL) AS null_day,
       count(*) FILTER (WHERE day IS NOT NULL AND {TRY_DATE.format("day")} IS NULL) AS impossible_day
FROM damaged"""),
        "newest_sequences": with_(f"{LOG},{SEGMENTED}", f"""
SELECT user_id, segment, max(n) AS events_total, count(*) AS events,
       string_agg(CAST(item_id AS VARCHAR), ' ' ORDER BY rn DESC) AS items
FROM (SELECT l.user_id, n.segment, l.item_id, count(*) OVER (PARTITION BY l.user_id, n.segment) AS n,
             row_number() OVER (PARTITION BY l.user_id, n.segment
                                ORDER BY l.wall_time DESC, l.item_id DESC) AS rn
      FROM log l JOIN numbered n ON {TO_DATE.format("l.day")} = n.d)
WHERE rn <= {SEQUENCE_LENGTH} GROUP BY user_id, segment"""),
        "popular_items": with_(f"{LOG},{POPULAR}", "SELECT * FROM popular"),
        "ranking_metrics": with_(f"{LOG},{POPULAR}", f"""
SELECT count(*) AS users, round(avg(CASE WHEN hits > 0 THEN 1.0 ELSE 0.0 END), 6) AS hit_rate,
       round(avg(CAST(hits AS DOUBLE) / n), 6) AS recall,
       round(avg(dcg / (SELECT sum(1 / log2(i + 1)) FROM range(1, least(n, {TOP}) + 1) t(i))), 6) AS ndcg,
       round(avg(coalesce(CAST(1 AS DOUBLE) / first, 0)), 6) AS reciprocal_rank
FROM (SELECT r.user_id, count(*) AS n, count(p.rank) AS hits,
             coalesce(sum(1 / log2(p.rank + 1)), 0) AS dcg, min(p.rank) AS first
      FROM (SELECT DISTINCT user_id, item_id FROM log WHERE day >= {TRAINED_BEFORE}) r
      LEFT JOIN popular p USING (item_id) GROUP BY r.user_id)"""),
        "point_in_time_features": with_(f"{LOG},{CONTROL_ONLY}", """
SELECT s.item_id, s.day, s.exposures, f.day AS feature_day, f.shows, f.played
FROM (SELECT item_id, day, count(*) AS exposures FROM log GROUP BY item_id, day) s
LEFT JOIN (SELECT item_id, day, count(*) AS shows, CAST(sum(played_ms) AS BIGINT) AS played FROM control
           WHERE day IS NOT NULL GROUP BY item_id, day) f
  ON f.item_id = s.item_id AND f.day < s.day
QUALIFY row_number() OVER (PARTITION BY s.item_id, s.day ORDER BY f.day DESC NULLS LAST) = 1"""),
    }
    for source, ctes in (("log", LOG), ("purchases", PURCHASES)):
        name = "duplicate_pairs" if source == "log" else "duplicate_pairs_purchases"
        q[name] = with_(ctes, f"""
SELECT CAST(sum(n) AS BIGINT) AS total_rows, count(*) AS distinct_pairs,
       count(*) FILTER (WHERE n > 1) AS dup_pairs,
       CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS dup_pair_rows, max(n) AS max_repeat,
       {pct("coalesce(sum(n) FILTER (WHERE n > 1), 0)", "sum(n)")} AS dup_rows_pct,
       {pct("count(*) FILTER (WHERE n > 1)", "count(*)")} AS dup_pairs_pct
FROM (SELECT user_id, item_id, count(*) AS n FROM {source} GROUP BY user_id, item_id)""")
    for name in ALL_SUITES:
        q[f"{name}_verdicts"] = suite(name)
    q["verdicts"] = suite(*ALL_SUITES)
    q["control_verdicts"] = control_suite()
    q["verdict_summary"] = f"""
SELECT count(*) AS checks, count(*) FILTER (WHERE verdict = 'PASS') AS passed,
       count(*) FILTER (WHERE verdict = 'FAIL') AS failed FROM ({q["verdicts"]})"""
    q.update(recommender_sql(LOG, PURCHASES, SEGMENTED, TO_DATE))
    return q
