"""The quality classifier against a plain quadratic discriminant."""

import math
import zlib
from collections import Counter

import brute
import numpy as np
import pytest
from made import docs, frame, nothing, rows  # noqa: F401

from logassay.llm import quality


def plain_statistics(text):
    raw = (text or "").encode()
    words = brute.SPACED.findall(raw)
    n, times = len(words), Counter(words)
    some = lambda chars: sum(raw.count(c) for c in chars.encode())
    share = lambda k: math.log((k + 0.5) / (len(raw) + 50))
    return [
        math.log(1 + n), math.log((len(raw) + 5) / (n + 1)), math.log((len(times) + 1) / (n + 1)),
        math.log((max(times.values(), default=0) + 1) / (n + 10)),
        math.log((sum(a == b for a, b in zip(words, words[1:], strict=False)) + 0.5) / (n + 10)),
        share(sum(65 <= b <= 90 for b in raw)), share(sum(48 <= b <= 57 for b in raw)),
        share(some("#$%&*+/<=>@[]\\^_`{}~")), share(some("|")), share(some("!?")), share(some(".,;:")),
        share(some("\n")), share(sum(b >= 128 for b in raw)),
    ]


def plain_scores(rows, labels, pooling=0.3, diagonal=0.1):
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 3 == 1
    told = {}
    for i, q in labels:
        if q in (0, 1):
            told.setdefault(i, set()).add(q)
    x = {k: np.array(plain_statistics(t)) for k, (_, t) in enumerate(rows)}
    by = {0: [], 1: []}
    for k, (i, _) in enumerate(rows):
        if i is not None and not held(i) and len(told.get(i, ())) == 1:
            by[next(iter(told[i]))].append(x[k])
    sizes = {c: len(v) for c, v in by.items()}
    mean = {c: np.mean(v, axis=0) for c, v in by.items()}
    spread = {c: np.cov(np.array(v).T, bias=True) for c, v in by.items()}
    pooled = sum(sizes[c] * spread[c] for c in by) / sum(sizes.values())
    density = {}
    for c in by:
        own = (1 - pooling) * spread[c] + pooling * pooled
        own = (1 - diagonal) * own + diagonal * np.diag(np.diag(own)) + np.eye(len(own)) * 0.05**2
        inverse, log_det = np.linalg.inv(own), np.linalg.slogdet(own)[1]
        density[c] = {k: -0.5 * ((v - mean[c]) @ inverse @ (v - mean[c]) + log_det) for k, v in x.items()}
    out = []
    for k, (i, _) in enumerate(rows):
        gap = density[1][k] - density[0][k] + math.log(sizes[1] / sizes[0])
        out.append((i, held(i), 1 / (1 + math.exp(-max(-500, min(500, gap))))))
    return out


@pytest.mark.parametrize("settings", [{}, {"pooling": 0.9, "diagonal": 0.6}])
def test_scores_are_those_of_the_plain_discriminant(spark, rows, settings):  # noqa: F811
    own = [*rows, (None, "a null id"), (rows[4][0], rows[4][1])]
    labels = [(i, float(len(t or "") % 3 > 0)) for i, t in rows]
    labels += [(labels[0][0], 1 - labels[0][1]), (labels[5][0], 0.7), (10**9, 1.0), (None, 1.0), (labels[6][0], None)]
    given = spark.createDataFrame(labels, "doc_id long, quality double")
    got = quality.quality_scores(frame(spark, own), given, **settings).collect()
    want = plain_scores(own, labels, **settings)
    key = lambda x: (str(x[0]), x[2])
    got = sorted(((r.doc_id, r.held_out, r.score) for r in got), key=key)
    for a, b in zip(got, sorted(want, key=key), strict=True):
        assert a[:2] == b[:2] and a[2] == pytest.approx(b[2], rel=1e-5, abs=1e-7)


def test_labels_that_are_no_labels_teach_nothing(spark, rows):  # noqa: F811
    given = spark.createDataFrame([(str(i), "0.7") for i, _ in rows] + [("1", "good")], "doc_id string, quality string")
    got = quality.quality_scores(frame(spark, rows).selectExpr("cast(doc_id AS string) AS doc_id", "text"), given)
    assert {r.score for r in got.collect()} == {0.5}
