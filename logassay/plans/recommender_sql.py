"""DuckDB SQL of the queries in ``plans.recommender``, worded on its own."""

from __future__ import annotations

from logassay.operators.counterfactual import poisson_steps
from logassay.plans.recommender import (
    ALPHA, CLIP, CURVE, EVERY, HORIZON_DAYS, LIKED, NEAREST, NEIGHBOURS, PART, POPULAR, PROBES, QUOTAS,
    REPLICATES, ROUNDS, SCALE, SEED, TRAINED_BEFORE, WINDOW_DAYS, WINDOW_START, WINDOW_STEP,
)


def cooccurrence(source: str) -> str:
    return f"""
pairs AS (SELECT DISTINCT user_id, item_id FROM {source} WHERE user_id IS NOT NULL AND item_id IS NOT NULL),
degree AS (SELECT item_id, count(*) AS n FROM pairs GROUP BY item_id),
met AS (
  SELECT x.item_id, y.item_id AS neighbour_item_id, count(*) AS users_both
  FROM pairs x JOIN pairs y ON x.user_id = y.user_id AND x.item_id <> y.item_id GROUP BY ALL),
scored AS (
  SELECT met.*, round(users_both / sqrt(CAST(p.n AS DOUBLE) * q.n), 9) AS cosine
  FROM met JOIN degree p ON p.item_id = met.item_id JOIN degree q ON q.item_id = neighbour_item_id)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY cosine DESC, neighbour_item_id) AS rank,
       neighbour_item_id, users_both, cosine
FROM scored QUALIFY rank <= {NEIGHBOURS}"""


def swing(source: str) -> str:
    return f"""
pairs AS (SELECT DISTINCT user_id, item_id FROM {source} WHERE user_id IS NOT NULL AND item_id IS NOT NULL),
friends AS (
  SELECT x.user_id AS u, y.user_id AS v, count(*) AS shared
  FROM pairs x JOIN pairs y ON x.item_id = y.item_id AND x.user_id < y.user_id
  GROUP BY ALL HAVING count(*) > 1),
met AS (
  SELECT a.item_id, b.item_id AS neighbour_item_id, count(*) AS user_pairs,
         round(sum(1 / CAST({ALPHA} + shared AS DOUBLE)), 9) AS swing
  FROM friends
  JOIN pairs a ON a.user_id = u JOIN pairs a2 ON a2.user_id = v AND a2.item_id = a.item_id
  JOIN pairs b ON b.user_id = u JOIN pairs b2 ON b2.user_id = v AND b2.item_id = b.item_id
  WHERE a.item_id <> b.item_id GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY swing DESC, neighbour_item_id) AS rank,
       neighbour_item_id, user_pairs, swing
FROM met QUALIFY rank <= {NEIGHBOURS}"""


LATER = f"""
earlier AS (
  SELECT item_id, count(DISTINCT user_id) AS score FROM log WHERE day < {TRAINED_BEFORE} GROUP BY item_id),
shown_later AS (
  SELECT user_id, score, played_ms, CASE WHEN ratio > {LIKED} THEN 1 WHEN ratio <= {LIKED} THEN 0 END AS liked
  FROM log LEFT JOIN earlier USING (item_id) WHERE day >= {TRAINED_BEFORE})"""


def area(column: str, by: str = "") -> str:
    """Rank sums with ties at their mean rank."""
    split = f"PARTITION BY {by}" if by else ""
    tie = f"PARTITION BY {by}, {column}" if by else f"PARTITION BY {column}"
    return f"""
ranked AS (
  SELECT *, rank() OVER ({split} ORDER BY {column}) + (count(*) OVER ({tie}) - 1) / CAST(2 AS DOUBLE) AS r
  FROM shown_later WHERE {column} IS NOT NULL AND liked IS NOT NULL),
areas AS (
  SELECT {by + "," if by else ""} count(*) AS impressions, count(*) FILTER (liked = 1) AS positives,
         count(*) FILTER (liked = 0) AS negatives,
         round(CASE WHEN count(DISTINCT liked) = 2 THEN
           (sum(CASE WHEN liked = 1 THEN r END) - count(*) FILTER (liked = 1) * (count(*) FILTER (liked = 1) + 1) / CAST(2 AS DOUBLE))
           / (CAST(count(*) FILTER (liked = 1) AS DOUBLE) * count(*) FILTER (liked = 0)) END, 9) AS auc
  FROM ranked {"GROUP BY " + by if by else ""})"""


def _round(n: int) -> str:
    """One round of k-means: nearest centroid, then means rounded down; empty lists stay."""
    return f"""
near{n} AS (
  SELECT v.id, v.vec, c.list FROM v, c{n} c
  QUALIFY row_number() OVER (PARTITION BY v.id ORDER BY list_dot_product(c.vec, c.vec) - 2 * list_dot_product(c.vec, v.vec), c.list) = 1),
means{n} AS (
  SELECT list, list(m ORDER BY k) AS vec FROM (
    SELECT list, k, floor(avg(vec[k])) AS m FROM near{n}, range(1, (SELECT max(len(vec)) FROM v) + 1) t(k) GROUP BY list, k)
  GROUP BY list),
c{n + 1} AS (SELECT c.list, coalesce(m.vec, c.vec) AS vec FROM c{n} c LEFT JOIN means{n} m USING (list))"""


LISTS = f"""
v AS (
  SELECT vec_id AS id, list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS vec FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS (
  SELECT row_number() OVER (ORDER BY md5(CAST(id AS VARCHAR)), id) - 1 AS list, vec FROM v
  QUALIFY list < ceil(sqrt((SELECT count(*) FROM v)))),
{",".join(_round(n) for n in range(ROUNDS))},
probed AS (
  SELECT v.id, v.vec, c.list,
         row_number() OVER (PARTITION BY v.id ORDER BY list_dot_product(c.vec, c.vec) - 2 * list_dot_product(c.vec, v.vec), c.list) AS probe
  FROM v, c{ROUNDS} c),
asked AS (SELECT * FROM probed WHERE id % {EVERY} = 0),
held AS (SELECT * FROM probed WHERE probe = 1),
met AS (
  SELECT a.id AS query_id, a.probe, h.id, CAST(list_dot_product(a.vec, h.vec) AS BIGINT) AS score
  FROM asked a JOIN held h ON a.list = h.list AND a.id <> h.id)"""


def _number(*parts: str) -> str:
    return f"CAST('0x' || md5(concat_ws(':', {', '.join(parts)}))[1:15] AS BIGINT)"


def negatives(source: str) -> str:
    quota = f"[{', '.join(map(str, QUOTAS))}][stratum + 1]"
    return f"""
touched AS (SELECT DISTINCT user_id AS u, item_id AS i FROM {source} WHERE user_id IS NOT NULL AND item_id IS NOT NULL),
popularity AS (
  SELECT i, users, CAST(coalesce(sum(users) OVER (ORDER BY users DESC, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before,
         CAST(sum(users) OVER () AS BIGINT) AS total
  FROM (SELECT i, count(*) AS users FROM touched GROUP BY i)),
strata AS (
  SELECT i, users, CAST(before * {len(QUOTAS)} // total AS INTEGER) AS stratum,
         before - min(before) OVER (PARTITION BY before * {len(QUOTAS)} // total) AS start
  FROM popularity),
sizes AS (SELECT stratum, CAST(sum(users) AS BIGINT) AS weight, {quota} AS quota FROM strata GROUP BY stratum),
tries AS (
  SELECT u, stratum, t, {_number(str(SEED), "u", "stratum", "t")} % weight AS place
  FROM (SELECT DISTINCT u FROM touched), sizes, LATERAL (SELECT unnest(range(1, quota * 8 + 1)) AS t)),
hits AS (
  SELECT t.u, t.stratum, s.i, min(t.t) AS t
  FROM tries t JOIN strata s ON s.stratum = t.stratum AND t.place >= s.start AND t.place < s.start + s.users
  ANTI JOIN touched o ON o.u = t.u AND o.i = s.i GROUP BY ALL),
open_items AS (
  SELECT d.u, s.stratum, s.i, h.t, {_number(str(SEED), "d.u", "s.i")} AS h
  FROM (SELECT DISTINCT u FROM touched) d, strata s LEFT JOIN hits h ON h.u = d.u AND h.i = s.i
  WHERE NOT EXISTS (SELECT 1 FROM touched o WHERE o.u = d.u AND o.i = s.i))
SELECT u AS user_id, stratum, i AS item_id,
       CAST(row_number() OVER (PARTITION BY u, stratum ORDER BY t NULLS LAST, h, i) AS INTEGER) AS rank, t IS NOT NULL AS drawn
FROM open_items QUALIFY rank <= {quota}"""


def sliding(to_date: str) -> str:
    return f"""
dated AS (SELECT user_id, played_ms, day, {to_date.format("day")} AS d FROM log WHERE user_id IS NOT NULL),
windows AS (
  SELECT CAST({to_date.format(WINDOW_START)} + CAST(k * {WINDOW_STEP} AS INTEGER) AS DATE) AS a,
         CAST({to_date.format(WINDOW_START)} + CAST(k * {WINDOW_STEP} + {WINDOW_DAYS} AS INTEGER) AS DATE) AS b
  FROM range(0, 1000) t(k)),
whole AS (SELECT a, b, b + {HORIZON_DAYS} AS c FROM windows WHERE b + {HORIZON_DAYS} - 1 <= (SELECT max(d) FROM dated))
SELECT user_id, CAST(strftime(a, '%Y%m%d') AS BIGINT) AS first_day,
       count(*) FILTER (d < b) AS events, count(DISTINCT d) FILTER (d < b) AS active_days,
       CAST(sum(played_ms) FILTER (d < b) AS BIGINT) AS played, max(day) FILTER (d < b) AS last_day,
       count(*) FILTER (d >= b) AS target_events,
       CAST(coalesce(sum(played_ms) FILTER (d >= b), 0) AS BIGINT) AS target_played
FROM whole JOIN dated ON d >= a AND d < c GROUP BY user_id, a HAVING count(*) FILTER (d < b) > 0"""


def texts(to_date: str) -> str:
    return f"""
numbered_events AS (
  SELECT l.user_id, n.segment, wall_time, coalesce(CAST(item_id AS VARCHAR), '?') || ':'
           || coalesce(CAST(CAST(floor(ratio * 100) AS BIGINT) AS VARCHAR), '?') AS told,
         row_number() OVER (PARTITION BY l.user_id, n.segment
                            ORDER BY wall_time NULLS FIRST, item_id NULLS FIRST, ratio NULLS FIRST) - 1 AS place
  FROM log l JOIN numbered n ON {to_date.format("l.day")} = n.d WHERE l.user_id IS NOT NULL)
SELECT user_id, segment, place // {PART} AS part, count(*) AS events, min(wall_time) AS first_time,
       max(wall_time) AS last_time, string_agg(told, ' ' ORDER BY place) AS text
FROM numbered_events GROUP BY user_id, segment, place // {PART}"""


def gaps(source: str, item: str) -> str:
    return f"""SELECT user_id, {item} FROM (SELECT DISTINCT user_id FROM {source} WHERE user_id IS NOT NULL AND {item} IS NOT NULL),
  (SELECT DISTINCT {item} FROM {source} WHERE user_id IS NOT NULL AND {item} IS NOT NULL)
EXCEPT SELECT user_id, {item} FROM {source}"""


STUDY = f"""
listed AS (
  SELECT item_id FROM (SELECT item_id, count(DISTINCT user_id) AS users FROM log WHERE day < {TRAINED_BEFORE} GROUP BY item_id)
  ORDER BY users DESC, item_id LIMIT {POPULAR}),
past AS (SELECT user_id, count(*) AS n FROM log WHERE day < {TRAINED_BEFORE} GROUP BY user_id),
study AS (
  SELECT coalesce(n, 0) / CAST(100 AS DOUBLE) AS a, hour(wall_time) / CAST(24 AS DOUBLE) AS b,
         CASE WHEN item_id IN (SELECT item_id FROM listed) THEN 1 ELSE 0 END AS t,
         CASE WHEN ratio > {LIKED} THEN 1 ELSE 0 END AS y,
         concat_ws(':', user_id, item_id, epoch_us(wall_time)) AS key
  FROM log LEFT JOIN past USING (user_id) WHERE day >= {TRAINED_BEFORE} AND ratio IS NOT NULL)"""


def _solved(source: str, out: tuple[str, str, str], add: tuple[str, str, str] = ("0", "0", "0"), join: str = "") -> str:
    """The solution of a symmetric system of three, from columns h00..h22 and g0..g2, by determinants."""
    h = lambda i, j: f"h{min(i, j)}{max(i, j)}"

    def determinant(column: int | None) -> str:
        m = [[f"g{i}" if j == column else h(i, j) for j in range(3)] for i in range(3)]
        return (
            f"({m[0][0]} * ({m[1][1]} * {m[2][2]} - {m[1][2]} * {m[2][1]})"
            f" - {m[0][1]} * ({m[1][0]} * {m[2][2]} - {m[1][2]} * {m[2][0]})"
            f" + {m[0][2]} * ({m[1][0]} * {m[2][1]} - {m[1][1]} * {m[2][0]}))"
        )

    cells = [f"{a} + {determinant(i)} / {determinant(None)} AS {o}" for i, (a, o) in enumerate(zip(add, out, strict=True))]
    return f"SELECT {', '.join(cells)} FROM {source}{join}"


def _squares(weight: str) -> str:
    xs = ("1", "a", "b")
    return ", ".join(f"sum({weight} * {xs[i]} * {xs[j]}) AS h{i}{j}" for i in range(3) for j in range(i, 3))


def _newton(n: int) -> str:
    return f"""
sums{n} AS (
  SELECT sum(t - p) AS g0, sum((t - p) * a) AS g1, sum((t - p) * b) AS g2, {_squares("p * (1 - p)")}
  FROM (SELECT *, 1 / (1 + exp(-(b0 + b1 * a + b2 * b))) AS p FROM study, beta{n})),
beta{n + 1} AS ({_solved(f"sums{n}, beta{n}", ("b0", "b1", "b2"), ("b0", "b1", "b2"))})"""


STEPS = 10
PROPENSITY = f"""{STUDY},
beta0 AS (SELECT CAST(0 AS DOUBLE) AS b0, CAST(0 AS DOUBLE) AS b1, CAST(0 AS DOUBLE) AS b2),
{",".join(_newton(n) for n in range(STEPS))},
chances AS (SELECT *, 1 / (1 + exp(-(b0 + b1 * a + b2 * b))) AS p FROM study, beta{STEPS}),
cut AS (SELECT *, least(greatest(p, {CLIP}), 1 - CAST({CLIP} AS DOUBLE)) AS e FROM chances)"""


def _policy(name: str, arm: int, weight: str) -> str:
    return f"""
SELECT '{name}' AS policy, count(*) AS rows, count(*) FILTER (t = {arm}) AS logged_rows,
       count(*) FILTER (p <> e) AS clipped_rows, round(avg(CASE WHEN t = {arm} THEN CAST(y AS DOUBLE) END), 6) AS observed,
       round(sum({weight} * y) / count(*), 6) AS ips, round(sum({weight} * y) / sum({weight}), 6) AS snips,
       round(pow(sum({weight}), 2) / sum(pow({weight}, 2)), 3) AS effective_rows
FROM cut"""


def _fit(arm: int) -> str:
    names = (f"m{arm}0", f"m{arm}1", f"m{arm}2")
    return f"""
fit{arm} AS ({_solved(f"(SELECT sum(y) AS g0, sum(y * a) AS g1, sum(y * b) AS g2, {_squares('1')} FROM study WHERE t = {arm})", names)})"""


def _robust() -> str:
    steps = ", ".join(map(str, poisson_steps()))
    return f"""WITH {{log}},{PROPENSITY},{_fit(1)},{_fit(0)},
models AS (SELECT *, m10 + m11 * a + m12 * b AS one, m00 + m01 * a + m02 * b AS zero FROM cut, fit1, fit0),
shares AS (
  SELECT key, one - zero + t * (y - one) / e - (1 - t) * (y - zero) / (1 - e) AS v FROM models),
drawn AS (
  SELECT r, v, list_sum(list_transform([{steps}], lambda s: CASE WHEN d >= s THEN 1 ELSE 0 END)) AS w
  FROM (SELECT r, v, CAST('0x' || md5(concat_ws(':', '{SEED}', key, r // 8))[4 * (r % 8) + 1 : 4 * (r % 8) + 4] AS BIGINT) AS d
        FROM shares, range(0, {REPLICATES}) t(r))),
means AS (SELECT sum(w * v) / sum(w) AS m FROM drawn GROUP BY r HAVING sum(w) > 0),
placed AS (SELECT m, row_number() OVER (ORDER BY m) AS spot, count(*) OVER () AS n FROM means)
SELECT (SELECT count(*) FROM shares) AS rows, (SELECT round(avg(v), 6) FROM shares) AS effect,
       round(stddev_samp(m), 6) AS standard_error,
       round(max(CASE WHEN spot = floor((n - 1) * 0.025 + 0.5) + 1 THEN m END), 6) AS low,
       round(max(CASE WHEN spot = floor((n - 1) * 0.975 + 0.5) + 1 THEN m END), 6) AS high, count(*) AS replicates
FROM placed"""


def recommender_sql(log: str, purchases: str, segmented: str, to_date: str) -> dict[str, str]:
    """The arguments are the CTEs that make the views, and a day key's conversion."""

    def whole_area(column: str) -> str:
        return f"""WITH {log},{LATER},{area(column)}
SELECT (SELECT count(*) FROM shown_later) AS rows, positives, negatives,
       (SELECT count(*) FROM shown_later) - positives - negatives AS unscored_rows, auc FROM areas"""

    best = f"row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) <= {NEAREST}"
    return {
        "negative_samples": f"WITH {log},{negatives('log')}",
        "negative_samples_purchases": f"WITH {purchases},{negatives('purchases')}",
        "sliding_samples": f"WITH {log},{sliding(to_date)}",
        "sequence_texts": f"WITH {log},{segmented},{texts(to_date)}",
        "gap_cells": f"WITH {log} {gaps('log', 'item_id')}",
        "propensity_model": f"""WITH {log},{PROPENSITY}
SELECT CAST(position AS INTEGER) AS position, feature, round(coefficient, 6) AS coefficient FROM (
  SELECT unnest([0, 1, 2]) AS position, unnest(['intercept', 'past', 'hour']) AS feature, unnest([b0, b1, b2]) AS coefficient
  FROM beta{STEPS})""",
        "policy_values": f"WITH {log},{PROPENSITY}{_policy('treat_all', 1, 't / e')} UNION ALL {_policy('treat_none', 0, '(1 - t) / (1 - e)')}",
        "doubly_robust": _robust().replace("{log}", log),
        "vector_top_k": f"""WITH {LISTS}
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank, id, score
FROM met WHERE probe <= {PROBES} QUALIFY {best}""",
        "vector_recall_curve": f"""WITH {LISTS},
truth AS (SELECT query_id, id FROM met QUALIFY {best}),
curve AS (SELECT unnest([{", ".join(map(str, CURVE))}])::BIGINT AS probes),
found AS (
  SELECT probes, query_id, id FROM met JOIN curve ON probe <= probes
  QUALIFY row_number() OVER (PARTITION BY probes, query_id ORDER BY score DESC, id) <= {NEAREST}),
sums AS (SELECT count(DISTINCT query_id) AS queries, count(*) AS neighbours FROM truth)
SELECT probes, queries, neighbours, hits AS found, round(CAST(hits AS DOUBLE) / neighbours, 6) AS recall,
       round(CAST(rows AS DOUBLE) / (queries * (SELECT count(*) FROM v)), 6) AS compared
FROM sums, (SELECT probes, count(*) AS hits FROM found JOIN truth USING (query_id, id) GROUP BY probes)
JOIN (SELECT probes, count(*) AS rows FROM asked a JOIN curve ON probe <= probes JOIN held h ON a.list = h.list GROUP BY probes)
  USING (probes)""",
        "item_neighbours": f"WITH {log},{cooccurrence('log')}",
        "item_neighbours_purchases": f"WITH {purchases},{cooccurrence('purchases')}",
        "swing_neighbours": f"WITH {purchases},{swing('purchases')}",
        "auc_popularity": whole_area("score"),
        "auc_played": whole_area("played_ms"),
        "user_auc": f"WITH {log},{LATER},{area('played_ms', 'user_id')} SELECT * FROM areas",
        "gauc": f"""WITH {log},{LATER},{area('score', 'user_id')}
SELECT count(*) AS users, count(*) FILTER (auc IS NULL) AS one_class_users,
       CAST(coalesce(sum(impressions), 0) AS BIGINT) AS impressions,
       CAST(coalesce(sum(impressions) FILTER (auc IS NULL), 0) AS BIGINT) AS one_class_impressions,
       round(sum(auc * impressions) / sum(impressions) FILTER (auc IS NOT NULL), 6) AS gauc FROM areas""",
    }
