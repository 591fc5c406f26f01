"""Hard negatives against a plain version."""

import math

import numpy as np
import pytest

from logassay.llm import hard_negatives as hn


def plain(rows, positives=5, negatives=5):
    """(anchor, positive, rank, negative, scores) by comparing everything with every anchor."""
    usable = []
    for vec_id, vec, label in rows:
        if vec is None or not vec or label is None or any(x is None or not math.isfinite(x) for x in vec):
            continue
        if vec_id is not None and vec_id % 7 == 0:
            label = (label + 1) % 10
        usable.append((vec_id, label, [math.floor(256 * x) for x in vec]))
    out = []
    last = lambda v: (v is None, v or 0)
    for a, (a_id, a_label, a_vec) in enumerate(usable):
        if a_id is None or a_id % 100:
            continue
        scored = [
            (-sum(x * y for x, y in zip(a_vec, v, strict=True)), last(i), label, i)
            for b, (i, label, v) in enumerate(usable)
            if b != a and len(v) == len(a_vec)
        ]
        scored.sort(key=lambda x: x[:2])
        for p_score, _, _, p_id in [x for x in scored if x[2] == a_label][:positives]:
            fit = [x for x in scored if x[2] != a_label and 80 * -p_score <= 100 * -x[0] <= 100 * -p_score]
            out += [(a_id, p_id, n + 1, x[3], -p_score, -x[0]) for n, x in enumerate(fit[:negatives])]
    return sorted(out, key=str)


def found(spark, rows, **settings):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr(
        "*", "'x' AS row", "1 AS block", "2 AS anchor"
    )
    return sorted((tuple(r) for r in hn.hard_negatives(df.repartition(3), **settings).collect()), key=str)


def vectors(n, kinds, size=4, seed=5):
    r = np.random.default_rng(seed)
    centres = r.integers(-3, 4, (kinds, size))
    return [
        (i, [float(x) for x in centres[r.integers(kinds)] + r.integers(0, 2, size) / 2], int(r.integers(0, 4)))
        for i in range(n)
    ]


@pytest.mark.parametrize("block", [1 << 22, 300])
def test_equals_plain_version_with_ties(spark, block):
    rows = vectors(420, 9) + [
        (500, None, 1), (600, [1.0, None, 1.0, 1.0], 1), (700, [1.0, math.nan, 1.0, 1.0], 1),
        (800, [math.inf, 0.0, 0.0, 0.0], 2), (900, [1.0, 1.0, 1.0, 1.0], None), (1000, [1.0, 2.0], 2),
        (1001, [1.0, 2.0], 2), (1002, [0.9, 2.0], 3), (1100, [], 3), (1200, [0.0] * 4, 0), (None, [3.0] * 4, 2),
        (None, [3.0] * 4, 1), (1300, [3.0] * 4, 1), (1301, [3.0] * 4, 1), (1302, [2.9] * 4, 2),
    ]
    want = plain(rows)
    assert len(want) > 60 and any(x[3] is None for x in want) and any(x[4] == x[5] for x in want)
    assert found(spark, rows, row_bytes=block, anchor_bytes=block) == want


def test_repeated_anchors_and_one_hot_label(spark):
    same = [(100, [1.0, 1.0], 3), (100, [1.0, 1.0], 3)]
    rows = same + [(i, [1.0, 1.0], 3) for i in range(101, 160)] + [(i, [1.0, 0.9], 4) for i in range(160, 190)]
    got = found(spark, rows, row_bytes=200, anchor_bytes=16)
    want = plain(rows)
    assert got == want and {x[2] for x in got} == {1, 2, 3, 4, 5}


def test_empty_and_without_anchors(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == []
    assert found(spark, [(100, [1.0], 1)]) == []


def test_large_components_stay_exact(spark):
    big = 2.0**20 + 1
    rows = [(100, [big, 1.0], 1), (101, [big, 1.0], 1), (102, [big, 0.996], 2), (103, [big, 1.0], 2)]
    assert found(spark, rows) == plain(rows) and len(plain(rows)) == 2
    with pytest.raises(OverflowError):
        hn.products(np.array([[2.0**40]]), np.array([[2.0**40]]))


def test_keys_sort_as_their_fields():
    fields = [(a, s, n, i, 0) for a in (0, 5) for s in (9, 0, -(2**62)) for n in (False, True) for i in (-3, 0, 7)]
    keys = [hn.pack(*f) for f in fields]
    assert keys == sorted(keys) and [hn.unpack(k) for k in keys] == fields


def test_an_iterator_holds_open_windows_only():
    keys = [(hn.pack(1, 10, False, 5, 0), None), (hn.pack(1, 10, True, 1, 0), None)]
    endless = iter(keys + [(hn.pack(1, 10, True, 100 + i, 0), None) for i in range(100_000)])
    got = hn.windows(endless, 2, 80, 100)
    assert [next(got)[3], next(got)[3]] == [1, 100]
    assert list(got) == []


def test_tasks_follow_the_rows_and_not_the_pairs_of_blocks(spark):
    rows = vectors(400, 9)
    spark.sparkContext.setJobGroup("hard-negatives", "")
    try:
        found(spark, rows, row_bytes=800, anchor_bytes=32, anchor_every=10)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup("hard-negatives")]
    stages = [tracker.getStageInfo(s) for job in jobs if job for s in job.stageIds]
    tasks = [stage.numTasks for stage in stages if stage]
    # 40 anchors beside 16 blocks were 640 tasks, each with a copy of its block.
    assert tasks and max(tasks) <= 64


def test_vectors_of_every_width_and_many_labels(spark):
    r = np.random.default_rng(8)
    rows = []
    for i in range(600):
        by = [1, 1, 30, 120, 2.0**11, 2.0**18][i % 6]
        vec = [float(x) for x in np.float32(by) * r.integers(-2, 3, 8) * (np.arange(8) // 4 == (by > 200)) / 2]
        rows.append((i if i % 50 else 100, vec, int(r.integers(0, 10 if i % 4 else 3))))
    want = plain(rows)
    assert len(want) > 100 and {abs(x[4]) > 2**24 for x in want} == {True, False}
    for block in (1 << 22, 900):
        assert found(spark, rows, row_bytes=block, anchor_bytes=block // 9) == want


def test_a_late_row_of_a_low_id_wins_a_tie():
    r = np.random.default_rng(3)
    vec = r.integers(-3, 4, (5_000, 6)).astype(np.float32)
    label = r.integers(0, 3, 5_000)
    number = np.arange(5_000)
    held = hn.Part(number, number, label, vec, None)
    goals = np.empty(60, dtype=object)
    goals[:] = [None if i % 9 == 0 else [int(g) for g in r.integers(-5, 40, 1 + i % 3)] for i in range(60)]
    own = hn.Part(number[:60], number[:60], label[:60], vec[:60], goals)
    keys = b"".join(hn.needed_negatives({(6, False): own}, {(6, False): held}, 4, 80, 100, 500))
    want = set()
    for a in range(60):
        scores = (vec[a] @ vec.T).astype(int)
        for g in [g for g in goals[a] or () if g >= 0]:
            fit = [x for x in number if label[x] != label[a] and 80 * g <= 100 * scores[x] <= 100 * g]
            want |= {(a, int(scores[x]), True, int(x), int(x)) for x in sorted(fit, key=lambda x: (-scores[x], x))[:4]}
    assert len(want) > 150 and sorted(map(hn.unpack, hn.unpacked(keys))) == sorted(want)
