"""Neighbours, areas under the curve and nearest vectors against plain versions."""

import math
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from logassay.operators import evaluation, neighbours, order, vectors
from logassay.roles import Roles

ROLES = Roles()
PAIRS = "user_id long, item_id long"


def hot_pairs():
    """A hot user with every item, a hub item with every user, repeats and nulls."""
    r = np.random.default_rng(3)
    rows = [(0, i) for i in range(40)] + [(u, 7) for u in range(30)]
    rows += [(int(u), int(i)) for u, i in zip(r.integers(1, 30, 200), r.integers(0, 40, 200), strict=True)]
    return rows + rows[:25] + [(None, 3), (4, None), (None, None)]


def baskets(rows):
    users = defaultdict(set)
    for u, i in rows:
        if u is not None and i is not None:
            users[u].add(i)
    return users


@pytest.mark.parametrize("block", [3, 64])
def test_every_pair_of_a_group_once(spark, block):
    users = baskets(hot_pairs())
    df = spark.createDataFrame([(u, i) for u, items in users.items() for i in items], "g long, m long")
    got = Counter(tuple(r) for r in neighbours.member_pairs(df, "g", "m", block).collect())
    assert set(got.values()) == {1}
    assert set(got) == {(u, a, b) for u, items in users.items() for a, b in combinations(sorted(items), 2)}


def best(scored, top):
    out = []
    for item in {a for a, _ in scored}:
        own = sorted(((b, *v) for (a, b), v in scored.items() if a == item), key=lambda x: (-x[2], x[0]))
        out += [(item, n + 1, *x) for n, x in enumerate(own[:top])]
    return sorted(out)


def both_ways(scored):
    return {**scored, **{(b, a): v for (a, b), v in scored.items()}}


@pytest.mark.parametrize("block", [3, 64])
def test_item_neighbours(spark, block):
    users = baskets(hot_pairs())
    met = Counter(p for items in users.values() for p in combinations(sorted(items), 2))
    n = Counter(i for items in users.values() for i in items)
    want = both_ways({(a, b): (c, round(c / math.sqrt(n[a] * n[b]), 9)) for (a, b), c in met.items()})
    got = neighbours.item_neighbours(spark.createDataFrame(hot_pairs(), PAIRS), ROLES, 4, block)
    assert got.columns == ["item_id", "rank", "neighbour_item_id", "users_both", "cosine"]
    assert sorted(tuple(r) for r in got.collect()) == best(want, 4)


@pytest.mark.parametrize("block", [3, 64])
def test_swing_neighbours(spark, block):
    users = baskets(hot_pairs())
    score, n = defaultdict(float), Counter()
    for u, v in combinations(sorted(users), 2):
        shared = sorted(users[u] & users[v])
        for p in combinations(shared, 2):
            score[p] += 1 / (2 + len(shared))
            n[p] += 1
    want = both_ways({p: (n[p], round(score[p], 9)) for p in score})
    got = neighbours.swing_neighbours(spark.createDataFrame(hot_pairs(), PAIRS), ROLES, 3, 2, block)
    assert sorted(tuple(r) for r in got.collect()) == best(want, 3)


def test_hubs_make_no_pairs_of_users(spark):
    """An item of all users is the most frequent of each, so nobody is paired for it."""
    rows = [(u, 999) for u in range(60)] + [(u, u // 2) for u in range(60)]
    touched = spark.createDataFrame(rows, "u long, i long")
    plan = neighbours.similar_users(touched, 2)
    assert plan.count() == 30
    assert neighbours.similar_users(spark.createDataFrame(rows[:60], "u long, i long"), 2).count() == 0


def test_neighbours_of_nothing(spark):
    empty = spark.createDataFrame([], PAIRS)
    assert neighbours.item_neighbours(empty, ROLES, 3).count() == 0
    assert neighbours.swing_neighbours(empty, ROLES, 3).count() == 0
    lone = spark.createDataFrame([(1, 1), (2, 2)], PAIRS)
    assert neighbours.item_neighbours(lone, ROLES, 3).count() == 0


def test_positions_and_sums_over_partitions(spark):
    values = [int(x) for x in np.random.default_rng(5).integers(0, 50, 700)]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "v long, i long").repartition(5)
    got = order.positions(df, [F.desc("v"), F.col("i")], "place").collect()
    want = sorted(range(700), key=lambda i: (-values[i], i))
    assert [r.i for r in sorted(got, key=lambda r: r.place)] == want
    assert sorted(r.place for r in got) == list(range(1, 701))
    salted = order.positions(df, [F.col("v")], "place", salt=F.xxhash64("i")).collect()
    placed = sorted(salted, key=lambda r: r.place)
    assert [r.place for r in placed] == list(range(1, 701)) and [r.v for r in placed] == sorted(values)
    sums = {r.i: r.s for r in order.running_sums(df, [F.col("v"), F.col("i")], {"s": "v"}).collect()}
    total = 0
    for i in sorted(range(700), key=lambda i: (values[i], i)):
        assert sums[i] == total
        total += values[i]


def area(rows):
    won = pairs = 0
    for s, y in rows:
        for t, z in rows:
            if y and not z:
                pairs += 1
                won += 1 if s > t else 0.5 if s == t else 0
    return round(won / pairs, 9) if pairs else None


def scored_rows():
    r = np.random.default_rng(9)
    rows = [(0, float(x), bool(y)) for x, y in zip(r.integers(0, 12, 160), r.random(160) < 0.4, strict=True)]
    rows += [(int(u), float(x) / 4, bool(y)) for u, x, y in zip(r.integers(1, 9, 80), r.integers(0, 9, 80), r.random(80) < 0.5, strict=True)]
    rows += [(20, 1.0, True), (20, 2.0, True), (21, 5.0, False), (22, -math.inf, True), (22, math.inf, False)]
    return rows, rows + [(1, None, True), (2, math.nan, False), (3, 1.0, None), (None, 3.0, True)]


def test_auc_with_ties_and_unusable_rows(spark):
    known, rows = scored_rows()
    df = spark.createDataFrame(rows, "user_id long, s double, y boolean").repartition(4)
    got = evaluation.auc(df, "s", "y").first()
    counted = known + [(None, 3.0, True)]
    assert (got.rows, got.unscored_rows) == (len(rows), 3)
    assert got.positives == sum(y for _, _, y in counted) and got.positives + got.negatives == len(counted)
    assert got.auc == pytest.approx(area([x[1:] for x in counted]), abs=1e-9)


def test_user_auc_and_gauc(spark):
    known, rows = scored_rows()
    df = spark.createDataFrame(rows, "user_id long, s double, y boolean").repartition(4)
    users = evaluation.user_auc(df, "user_id", "s", "y")
    got = {r.user_id: r for r in users.collect()}
    assert set(got) == {u for u, _, _ in known}
    weight = total = 0
    one_class = [r for r in got.values() if not (r.positives and r.negatives)]
    for u, r in got.items():
        own = [x[1:] for x in known if x[0] == u]
        want = area(own)
        assert r.impressions == len(own)
        assert (r.auc is None) == (want is None) and (want is None or r.auc == pytest.approx(want, abs=1e-9))
        if want is not None:
            weight, total = weight + len(own), total + len(own) * want
    whole = evaluation.gauc(users).first()
    assert (whole.users, whole.one_class_users, whole.one_class_impressions) == (
        len(got), len(one_class), sum(r.impressions for r in one_class)
    )
    assert whole.gauc == pytest.approx(total / weight, abs=1e-6)


def test_auc_without_classes_or_rows(spark):
    empty = spark.createDataFrame([], "user_id long, s double, y boolean")
    assert tuple(evaluation.auc(empty, "s", "y").first()) == (0, 0, 0, 0, None)
    one = spark.createDataFrame([(1, 1.0, True)], empty.schema)
    assert tuple(evaluation.auc(one, "s", "y").first()) == (1, 1, 0, 0, None)
    assert evaluation.user_auc(empty, "user_id", "s", "y").count() == 0
    assert tuple(evaluation.gauc(evaluation.user_auc(empty, "user_id", "s", "y")).first()) == (0, 0, 0, 0, None)


def vector_rows(n=300, size=6, seed=4):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(8, size)) * 3
    return [(i, [float(x) for x in (centres[i % 8] + r.normal(size=size)).astype(np.float32)]) for i in range(n)]


def plain_neighbours(rows, every, top, scale=256):
    whole = {i: [math.floor(scale * x) for x in v] for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for q in whole:
        if q % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(whole[q], v, strict=True)), i) for i, v in whole.items() if i != q)
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:top])]
    return sorted(out)


SPOILED = [(900, None), (901, []), (902, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (903, [math.nan] * 6), (None, [1.0] * 6)]


@pytest.mark.parametrize("size", [1 << 20, 500])
def test_all_probes_give_the_exact_neighbours(spark, monkeypatch, size):
    monkeypatch.setattr(vectors, "ROW_BYTES", size)
    monkeypatch.setattr(vectors, "QUERY_BYTES", size)
    rows = vector_rows() + [(1000 + i, vector_rows()[20][1]) for i in range(40)] + SPOILED
    df = spark.createDataFrame(rows, "id long, v array<float>").repartition(3)
    got = vectors.top_k(df, "id", "v", 20, 7, probes=1000)
    assert sorted(tuple(r) for r in got.collect()) == plain_neighbours(rows, 20, 7)


def test_recall_grows_with_probes_and_costs(spark):
    df = spark.createDataFrame(vector_rows(), "id long, v array<float>")
    curve = {r.probes: r for r in vectors.recall_curve(df, "id", "v", 10, 5, (1, 3, 18)).collect()}
    assert curve[18].recall == 1.0 and curve[18].compared == 1.0 and curve[18].neighbours == 150
    assert 0.3 < curve[1].recall <= curve[3].recall <= 1 and curve[1].compared < curve[3].compared < 0.6
    near = {(r.query_id, r.id) for r in vectors.top_k(df, "id", "v", 10, 5, probes=3).collect()}
    true = {(q, i) for q, _, i, _ in plain_neighbours(vector_rows(), 10, 5)}
    assert len(near & true) == curve[3].found


def test_vector_search_refusals_and_nothing(spark):
    kind = "id long, v array<float>"
    with pytest.raises(ValueError, match="components"):
        vectors.top_k(spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], kind), "id", "v", 1, 1, 1)
    with pytest.raises(ValueError, match="fewer lists"):
        vectors.Centroids(np.zeros((1 << 15, 1 << 9)))
    with pytest.raises(OverflowError):
        vectors.products(np.full((1, 2), 2.0**27), np.full((1, 2), 2.0**26))
    empty = spark.createDataFrame([], kind)
    assert vectors.top_k(empty, "id", "v", 1, 1, 1).count() == 0
    assert vectors.recall_curve(empty, "id", "v", 1, 1, (1,)).count() == 0
    lone = spark.createDataFrame([(50, [1.0])], kind)
    assert vectors.top_k(lone, "id", "v", 50, 3, 1).count() == 0
