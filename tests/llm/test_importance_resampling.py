"""Importance resampling against a plain version."""

import hashlib
import math
import zlib
from collections import Counter

import brute
import numpy as np
import pytest
from made import benchmark, docs, frame, nothing, rows  # noqa: F401

from logassay.llm import importance_resampling as ir


def plain(rows, items, longest=1, buckets=10_000, least=20, percent=10):
    def features(text):
        w = brute.lettered(text)
        return [" ".join(w[i : i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]

    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(bucket(f) for _, t in rows for f in features(t))
    t = Counter(bucket(f) for _, x in items for f in features(x))
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(
        1000 * math.log(float(t[b] + 1) * (s_all + buckets) / (float(s[b] + 1) * (t_all + buckets)))
    )
    out = []
    for doc_id, text in rows:
        own = [gain(bucket(f)) for f in features(text)]
        weight = sum(own) // len(own) if own else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        gumbel = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(own), weight, weight + gumbel, None, len(brute.lettered(text))])
    able = sorted((x for x in out if x[5] >= least), key=lambda x: (-x[3], x[0] is None, x[0] or 0))
    for i, x in enumerate(able[: len(able) * percent // 100]):
        x[4] = i + 1
    return sorted((tuple(x[:5]) for x in out), key=str)


def found(df, target, **settings):
    got = ir.resampled(df, target, **settings)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    return sorted((tuple(r) for r in got.collect()), key=str)


@pytest.mark.parametrize("settings", [{}, {"longest": 3, "buckets": 50, "percent": 60, "least": 5}])
def test_equals_plain_version(spark, docs, rows, benchmark, settings):  # noqa: F811
    items = [(r.item_id, r.text) for r in benchmark.collect()]
    own = {"least_words" if k == "least" else k: v for k, v in settings.items()}
    assert found(docs, benchmark, **own) == plain(rows, items, **settings)


def test_repeated_rows_null_ids_and_ties(spark, benchmark):  # noqa: F811
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(1, text)] * 40 + [(None, text)] * 30 + [(2, None), (3, "")]
    items = [(r.item_id, r.text) for r in benchmark.collect()]
    got = found(frame(spark, rows), benchmark, percent=50)
    assert got == plain(rows, items, percent=50)
    assert sorted(x[4] for x in got if x[4]) == list(range(1, 36))


def test_empty_tables(spark, nothing, docs, rows, benchmark):  # noqa: F811
    assert found(nothing, benchmark) == []
    assert found(docs, benchmark.limit(0)) == plain(rows, [])


def test_interning_counts_and_compares_bytes(monkeypatch):
    r = np.random.default_rng(2)
    features = [b"f%d" % x for x in r.integers(0, 300, 5000)]
    for capacity in (None, 512):
        table = ir.Slots(features, 97, capacity)
        held = {f: int(s) for f, s in zip(features, table.slot, strict=True)}
        assert len(set(held.values())) == len(held)
        assert all(table.slot[i] == held[f] for i, f in enumerate(features))
        for f, n in Counter(features).items():
            assert table.count[held[f]] == n and table.bucket[held[f]] == zlib.crc32(f) % 97
    # All keys alike: only the bytes tell features apart.
    monkeypatch.setattr(ir.xxhash, "xxh64_intdigest", lambda b: 7)
    table = ir.Slots(features[:400], 97)
    assert len({int(s) for s in table.slot}) == len(set(features[:400]))
    assert ir.Slots([], 97).count.sum() == 0
