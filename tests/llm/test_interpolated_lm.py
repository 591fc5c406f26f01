"""Deleted interpolation against a plain version with dictionaries of n-grams."""

import math
import tracemalloc
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import pyarrow as pa
import pytest
from made import frame, nothing, rows  # noqa: F401

from logassay.llm import interpolated_lm as lm


def part_of(doc_id):
    rest = None if doc_id is None else zlib.crc32(str(doc_id).encode()) % 5
    return {1: "held", 0: "deleted"}.get(rest, "kept")


def plain(rows, order=3):
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) by row."""
    texts = [(i, part_of(i), [*brute.SPACED.findall(brute.low(t).encode()), None]) for i, t in rows]

    def model(parts):
        counts, contexts = [Counter() for _ in range(order + 1)], [Counter() for _ in range(order + 1)]
        for _, p, w in texts:
            if p in parts:
                for k in range(1, order + 1):
                    padded = ["<"] * (k - 1) + w
                    for j in range(len(w)):
                        counts[k][tuple(padded[j : j + k])] += 1
                        contexts[k][tuple(padded[j : j + k - 1])] += 1
        return counts, contexts

    def estimates(known, w, j):
        """Bucket of the longest seen context, and an estimate by order."""
        counts, contexts = known
        bucket, shares = lm.LEVEL, []
        for k in range(1, order + 1):
            gram = tuple((["<"] * (k - 1) + w)[j : j + k])
            n = contexts[k][gram[:-1]]
            if k > 1 and n:
                bucket = k * lm.LEVEL + int(math.log2(n))
            shares.append(counts[k][gram] / n if n else 0.0)
        return bucket, shares

    kept, both = model({"kept"}), model({"kept", "deleted"})
    cells = defaultdict(int)
    for _, p, w in texts:
        if p == "deleted":
            for j in range(len(w)):
                bucket, shares = estimates(kept, w, j)
                cells[(bucket, *(min(1 + round(-2 * math.log2(s)), 199) if s else 0 for s in shares))] += 1
    keys = sorted(cells)
    uniform = 1 / (len(kept[0][1]) + 1)
    weights = {}
    for bucket in {k[0] for k in keys}:
        level = bucket // lm.LEVEL
        own = [([uniform] + [0.5 ** ((s - 1) / 2) if s else 0.0 for s in k[1:]], cells[k]) for k in keys if k[0] == bucket]
        now = [1 / (level + 1)] * (level + 1)
        for _ in range(1000):
            new = [1 / (level + 1)] * (level + 1)
            for shares, n in own:
                mixed = [a * b for a, b in zip(now, shares, strict=False)]
                new = [a + n * b / sum(mixed) for a, b in zip(new, mixed, strict=True)]
            new = [x / sum(new) for x in new]
            moved = max(abs(a - b) for a, b in zip(now, new, strict=True))
            now = new
            if moved < 1e-9:
                break
        weights[bucket] = now

    def weights_of(bucket):
        level = bucket // lm.LEVEL
        own = sorted(b for b in weights if b // lm.LEVEL == level)
        lower = [b for b in own if b <= bucket]
        return weights[lower[-1] if lower else own[0]] if own else [1 / (level + 1)] * (level + 1)

    v, n_all = len(both[0][1]), sum(both[0][1].values())
    out = []
    for doc_id, p, w in texts:
        base = score = known = 0
        for j in range(len(w)):
            bucket, shares = estimates(both, w, j)
            c = both[0][1][(w[j],)]
            known += c > 0
            base += math.log10((c + 0.5) / (n_all + 0.5 * (v + 1)))
            score += math.log10(sum(a * b for a, b in zip(weights_of(bucket), [1 / (v + 1), *shares], strict=False)))
        out.append((doc_id, p == "held", len(w), known, n_all, base, score))
    return out


def same(df, want, **settings):
    got = sorted((tuple(r) for r in lm.lm_scores(df, **settings).collect()), key=str)
    want = sorted(want, key=str)
    assert [x[:5] for x in got] == [x[:5] for x in want]
    assert np.allclose([x[5] for x in got], [x[5] for x in want], rtol=1e-10, atol=1e-9)
    assert np.allclose([x[6] for x in got], [x[6] for x in want], rtol=2e-5, atol=1e-5)
    return got


def speech(n=240, seed=3):
    """Texts of a small language in which words follow from the two before."""
    r = np.random.default_rng(seed)
    out = []
    for i in range(n):
        a, b, words = 0, 1, []
        for _ in range(int(r.integers(0, 60))):
            a, b = b, int((3 * a + 5 * b + r.integers(0, 3)) % 40)
            words.append(f"W{b}")
        out.append((i, " ".join(words) if words else None))
    return out


@pytest.mark.parametrize("settings", [{}, {"chunk_tokens": 300, "group_entries": 200}, {"order": 2}, {"order": 1}])
def test_equals_plain_version(spark, settings):
    texts = speech()
    got = same(frame(spark, texts), plain(texts, settings.get("order", 3)), **settings)
    held = [x for x in got if x[1]]
    if settings.get("order", 3) == 3:
        assert sum(x[6] for x in held) > 0.8 * sum(x[5] for x in held)  # log10, so less negative


def test_all_kinds_of_texts(spark, rows):  # noqa: F811
    own = [*rows, (None, "one two three"), (rows[5][0], rows[5][1]), (10**9, "Ünseen wörds\x0bonly here")]
    same(frame(spark, own), plain(own), chunk_tokens=5000)


def test_empty_untaught_and_unchecked(spark, nothing):  # noqa: F811
    assert lm.lm_scores(nothing).collect() == []
    ids = lambda part: [i for i in range(200) if part_of(i) == part][:3]
    for parts in (("held",), ("kept",), ("deleted",), ("held", "deleted")):
        texts = [(i, f"a b{i} c") for p in parts for i in ids(p)]
        same(frame(spark, texts), plain(texts))


def test_shares_of_a_context_sum_to_one():
    """Over the whole vocabulary and the unseen word, the mixture leaves nothing over."""
    r = np.random.default_rng(1)
    bucket = np.array([lm.LEVEL, 2 * lm.LEVEL + 3, 3 * lm.LEVEL + 1])
    steps = np.array([[4, 0, 0], [5, 2, 0], [7, 3, 1]])
    weights = lm.mixture(bucket, steps, np.array([5.0, 9.0, 4.0]), 3, 10)
    allowed = weights[lm.LEVEL :].reshape(3, lm.LEVEL, 4)
    assert np.allclose(allowed.sum(axis=2), 1)
    assert (allowed[0, :, 2:] == 0).all() and (allowed[1, :, 3] == 0).all() and (allowed[2] > 0).all()
    values = np.unique(r.integers(0, 2**50, 500).astype(np.uint64))
    assert (lm.unpack_sorted(lm.pack_sorted(values)) == values).all()
    assert lm.unpack(lm.pack(np.zeros(0, np.uint64))).size == 0 and lm.unpack(lm.pack(np.zeros(3, np.uint64))).tolist() == [0] * 3


@pytest.mark.parametrize("slice_tokens", [1, 50])
def test_slices_of_a_chunk_score_alike(spark, slice_tokens):
    texts = speech(80)
    same(frame(spark, texts), plain(texts), slice_tokens=slice_tokens)


def test_a_task_holds_one_chunk_and_only_its_counts(spark):
    """Chunks are not gathered into batches, and estimates do not exist for a whole chunk at once."""
    plan = lm.lm_scores(frame(spark, speech(20)))._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "collect_list" not in plan and "Join" not in plan
    r = np.random.default_rng(2)
    sizes, marks = np.full(4000, 50), r.integers(0, 3000, 200_000).astype(np.uint64)
    words, tokens = np.unique(marks, return_inverse=True)
    chunk = lm.Chunk(lm.pack(sizes), words.tobytes(), lm.pack(tokens))
    ranges = lm.Ranges(3, len(words), len(marks), 1 << 30)
    asked = [np.unique(chunk.grams(k, ranges.bits), return_counts=True)[1] for k in (1, 2, 3)]
    answers = pa.table({"order": [1, 2, 3], "bucket": [0, 0, 0], "both": [lm.pack(n) for n in asked]})
    tracemalloc.start()
    try:
        total = sum(x.count.shape[1] for x in lm.estimates(chunk, answers, "both", ranges, 1, 1, 5000))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert total == len(marks) and peak < 80 * len(marks)  # counts and contexts alone take 48, with shares 72
