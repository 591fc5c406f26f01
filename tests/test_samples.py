"""Negative samples, sliding windows, texts, gap cells and estimates against plain versions."""

import datetime
import hashlib
import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from logassay.operators import counterfactual, coverage, samples, sampling
from logassay.roles import Roles

ROLES = Roles()
PAIRS = "user_id long, item_id long"


def touches():
    """Skewed items; user 0 touched almost all, user 1 all, user 2 one."""
    r = np.random.default_rng(6)
    rows = [(int(u), int(i)) for u, i in zip(r.integers(3, 60, 900), np.minimum(r.geometric(0.05, 900), 80), strict=True)]
    items = sorted({i for _, i in rows})
    rows += [(0, i) for i in items[:-3]] + [(1, i) for i in items] + [(2, items[0])]
    return rows + rows[:50] + [(None, 1), (1, None)]


def number(*parts):
    return int(hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()[:15], 16)


def plain_negatives(rows, quotas, seed, draws):
    pairs = {(u, i) for u, i in rows if u is not None and i is not None}
    users = Counter(i for _, i in pairs)
    total, before, strata, starts = sum(users.values()), 0, {}, {}
    for i in sorted(users, key=lambda i: (-users[i], i)):
        k = before * len(quotas) // total
        starts.setdefault(k, before)
        strata.setdefault(k, []).append((i, before - starts[k], users[i]))
        before += users[i]
    out = []
    for u in {u for u, _ in pairs}:
        for k, items in strata.items():
            weight = sum(n for _, _, n in items)
            got = []
            for t in range(1, quotas[k] * draws + 1):
                at = number(seed, u, k, t) % weight
                i = next(i for i, s, n in items if s <= at < s + n)
                if (u, i) not in pairs and i not in got:
                    got.append(i)
            got = got[: quotas[k]]
            rest = sorted((i for i, _, _ in items if (u, i) not in pairs and i not in got), key=lambda i: (number(seed, u, i), i))
            for n, i in enumerate([*got, *rest][: quotas[k]]):
                out.append((u, k, i, n + 1, i in got))
    return sorted(out)


@pytest.mark.parametrize("draws", [1, 6])
def test_negative_samples(spark, draws):
    rows = touches()
    want = plain_negatives(rows, (2, 3, 4), 11, draws)
    for parts in (1, 5):
        df = spark.createDataFrame(rows, PAIRS).repartition(parts)
        got = sampling.negative_samples(df, ROLES, (2, 3, 4), 11, draws)
        assert sorted(tuple(r) for r in got.collect()) == want
    assert {u for u, *_ in want} >= {0, 2} and 1 not in {u for u, *_ in want}
    assert {d for *_, d in want} == {True, False} and len({(u, i) for u, _, i, _, _ in want}) == len(want)
    other = sampling.negative_samples(spark.createDataFrame(rows, PAIRS), ROLES, (2, 3, 4), 12, draws)
    assert sorted(tuple(r) for r in other.collect()) != want


def test_popular_items_are_drawn_more_often(spark):
    rows = [(u, 0) for u in range(300)] + [(u, 1 + u % 10) for u in range(300)] + [(1000 + u, 500) for u in range(900)]
    got = sampling.negative_samples(spark.createDataFrame(rows, PAIRS), ROLES, (1,), 5).where("user_id >= 1000")
    share = got.where("item_id = 0").count() / got.count()
    assert abs(share - 300 / 600) < 0.06


def test_negative_samples_of_nothing(spark):
    assert sampling.negative_samples(spark.createDataFrame([], PAIRS), ROLES, (2, 2), 1).count() == 0
    assert sampling.negative_samples(spark.createDataFrame([(1, 1)], PAIRS), ROLES, (2, 2), 1).count() == 0


LOG = "user_id long, item_id long, played_ms long, wall_time timestamp_ntz, day long, ratio double"


def events(n=400):
    r = np.random.default_rng(12)
    rows = []
    for k in range(n):
        user = 0 if k % 3 == 0 else int(r.integers(1, 6))
        t = datetime.datetime(2024, 1, 1) + datetime.timedelta(minutes=int(r.integers(0, 30 * 24 * 60)))
        if t.day in (9, 10, 20):
            continue
        ratio = None if k % 11 == 0 else float(r.integers(0, 300)) / 100
        rows.append((user, None if k % 17 == 0 else int(r.integers(0, 20)), None if k % 13 == 0 else k, t, int(t.strftime("%Y%m%d")), ratio))
    odd = datetime.datetime(2024, 1, 3)
    return rows + rows[:20] + [(1, 2, 3, odd, None, 1.0), (1, 2, 3, odd, 20240231, 1.0), (None, 2, 3, odd, 20240103, 1.0)]


def test_sliding_samples(spark):
    rows = events()
    got = samples.sliding_samples(spark.createDataFrame(rows, LOG), ROLES, 20240102, 6, 2, 4)
    start = datetime.date(2024, 1, 2)
    own = defaultdict(list)
    for u, _, played, t, day, _ in rows:
        if u is not None and day is not None and day == int(t.strftime("%Y%m%d")):
            own[u].append(((t.date() - start).days, day, played or 0))
    end, want = max(n for e in own.values() for n, _, _ in e), []
    for u, e in own.items():
        for a in range(0, end - 6 - 4 + 2, 2):
            seen, after = [x for x in e if a <= x[0] < a + 6], [x for x in e if a + 6 <= x[0] < a + 10]
            if seen:
                first = int((start + datetime.timedelta(days=a)).strftime("%Y%m%d"))
                want.append((u, first, len(seen), len({x[0] for x in seen}), sum(x[2] for x in seen), max(x[1] for x in seen),
                             len(after), sum(x[2] for x in after)))
    assert sorted(tuple(r) for r in got.collect()) == sorted(want) and len(want) > 40
    for bad in ((5, 2, 2), (4, 2, 3), (4, 0, 2), (1, 2, 2)):
        with pytest.raises(ValueError):
            samples.sliding_samples(spark.createDataFrame(rows, LOG), ROLES, 20240101, *bad)
    assert samples.sliding_samples(spark.createDataFrame([], LOG), ROLES, 20240101, 4, 2, 2).count() == 0


def test_sequence_texts(spark):
    rows = events()
    got = samples.sequence_texts(spark.createDataFrame(rows, LOG).repartition(4), ROLES, 7).collect()
    valid = [x for x in rows if x[0] is not None and x[4] == int(x[3].strftime("%Y%m%d"))]
    segment = lambda t: 1 if t.day < 9 else 2 if t.day < 20 else 3
    runs = defaultdict(list)
    low = lambda v: (v is not None, v if v is not None else 0)
    for u, i, _, t, _, ratio in sorted(valid, key=lambda x: (x[3], low(x[1]), low(x[5]))):
        runs[u, segment(t)].append((t, f"{'?' if i is None else i}:{'?' if ratio is None else math.floor(ratio * 100)}"))
    want = []
    for (u, s), told in runs.items():
        for p in range(0, len(told), 7):
            part = told[p : p + 7]
            want.append((u, s, p // 7, len(part), part[0][0], part[-1][0], " ".join(x for _, x in part)))
    assert sorted(tuple(r) for r in got) == sorted(want)
    assert max(r.events for r in got) == 7 and len([r for r in got if r.user_id == 0]) > 15
    assert samples.sequence_texts(spark.createDataFrame([], LOG), ROLES, 7).count() == 0


@pytest.mark.parametrize("block", [3, 4096])
def test_gap_cells(spark, block):
    rows = touches()
    pairs = {(u, i) for u, i in rows if u is not None and i is not None}
    want = {(u, i) for u in {u for u, _ in pairs} for i in {i for _, i in pairs}} - pairs
    got = [tuple(r) for r in coverage.gap_cells(spark.createDataFrame(rows, PAIRS), ROLES, block).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert coverage.gap_cells(spark.createDataFrame([], PAIRS), ROLES).count() == 0


def confounded(n=6000):
    """Treatment is likelier where the outcome is higher anyway; the true effect is 0.3."""
    r = np.random.default_rng(21)
    x = r.normal(size=n)
    t = (r.random(n) < 1 / (1 + np.exp(-(0.3 + 1.1 * x)))).astype(int)
    y = 0.5 + 0.8 * x + 0.3 * t + r.normal(size=n) * 0.2
    return [(float(a), int(b), float(c), i) for i, (a, b, c) in enumerate(zip(x, t, y, strict=True))], x, t


def the_study(spark, rows, clip=0.01):
    df = spark.createDataFrame(rows, "x double, t int, y double, k long").repartition(4)
    return counterfactual.Study(df, ("x",), "t", "y", "k", clip)


def test_propensities_and_effects_of_a_known_log(spark):
    rows, x, t = confounded()
    study = the_study(spark, rows + [(None, 1, 1.0, -1), (1.0, None, 1.0, -2), (1.0, 1, math.nan, -3), (0.0, 1, None, -4)])
    design, beta = np.column_stack([np.ones_like(x), x]), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-design @ beta))
        beta += np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design, design.T @ (t - p))
    assert np.allclose(study.beta, beta, atol=1e-9) and abs(study.beta[1] - 1.1) < 0.15
    assert [r.feature for r in counterfactual.propensity_model(study).orderBy("position").collect()] == ["intercept", "x"]
    values = {r.policy: r for r in counterfactual.policy_values(study).collect()}
    naive = values["treat_all"].observed - values["treat_none"].observed
    snips = values["treat_all"].snips - values["treat_none"].snips
    robust = counterfactual.doubly_robust(study, 100, 3).first()
    assert naive > 0.8 and abs(snips - 0.3) < 0.1 and abs(robust.effect - 0.3) < 0.03
    assert robust.low < robust.effect < robust.high and robust.high - robust.low < 0.1 and robust.replicates == 100
    assert robust.rows == values["treat_all"].rows == len(rows)
    tight = {r.policy: r for r in counterfactual.policy_values(the_study(spark, rows, 0.3)).collect()}
    assert tight["treat_all"].clipped_rows > 1000


def test_estimates_without_rows_or_one_class(spark):
    for rows in ([], [(1.0, 1, 2.0, 1), (2.0, 1, 3.0, 2)], [(1.0, 0, 2.0, 1)]):
        study = the_study(spark, rows)
        assert counterfactual.propensity_model(study).count() == 2
        values = counterfactual.policy_values(study).collect()
        assert len(values) == 2 and {v.rows for v in values} == {len(rows)}
        assert counterfactual.doubly_robust(study, 8, 1).first().rows == len(rows)


def test_bootstrap_counts_are_poisson(spark):
    steps = counterfactual.poisson_steps()
    assert steps[0] == math.floor(65536 * math.exp(-1)) and steps == sorted(steps) and steps[-1] >= 65535
    rows = spark.range(4000).select(F.lit(2.0).alias("v"), F.col("id").alias("k"))
    got = counterfactual.bootstrap(rows, F.col("v"), F.col("k"), 20, 9).collect()
    assert sorted(r.replicate for r in got) == list(range(20))
    assert all(abs(r.weight - 4000) < 300 and r.total == 2 * r.weight for r in got)
    assert len({r.weight for r in got}) > 10
