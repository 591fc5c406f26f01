"""Operators that compare rows with each other."""

import brute
import numpy as np
import pytest
from made import CLASHING, ITEMS, benchmark, docs, frame, nothing, rows  # noqa: F401

import corpus_pipeline
from logassay.llm import decontamination, embedding_dedup, line_dedup, ngram_join, substring_dedup
from logassay.llm.graph import components
from logassay.llm.word_arrays import SPACED, fingerprints, run_hashes, split_words


def matches(df, rows, want, names):
    got = {r.doc_id: tuple(r[n] for n in names) for r in df.collect()}
    assert len(got) == len(rows)
    for (i, t), w in zip(rows, want, strict=True):
        assert got[i] == tuple(w), (i, (t or "")[:80])


@pytest.mark.parametrize("small_group", [2, 12])
def test_similar_documents(docs, rows, monkeypatch, small_group):
    """With tiny groups the stars and probes do the work that pairs do otherwise."""
    monkeypatch.setattr(ngram_join, "SMALL_GROUP", small_group)
    got = ngram_join.similar_documents(docs)
    matches(got, rows, brute.similar(rows), ["n_shingles", "component_id"])


def test_similar_documents_of_all_sizes(spark):
    r = np.random.default_rng(8)
    rows = []
    for n in [*range(1, 40), 60, 90, 150, 400]:
        words = [f"w{x}" for x in r.integers(0, 10**6, n)]
        for cut in (0, 1, 2, n // 20):
            rows.append((len(rows), " ".join(words[cut:] + [f"y{x}" for x in r.integers(0, 10**6, cut)])))
    matches(ngram_join.similar_documents(frame(spark, rows)), rows, brute.similar(rows), ["n_shingles", "component_id"])


def test_repeated_ids_and_null_ids(spark):
    long = " ".join(f"w{i}" for i in range(50))
    rows = [(1, long), (1, long), (1, "other words that stand here alone"), (None, long + " x"), (None, None)]
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in ngram_join.similar_documents(frame(spark, rows)).collect())
    assert got == [("1", 2, "1"), ("1", 46, "1"), ("1", 46, "1"), ("None", 0, "None"), ("None", 47, "1")]
    kept = ngram_join.keep_one_of_each(frame(spark, rows)).select("doc_id", "text", "cls").collect()
    assert sorted((str(r.doc_id), r.text is None) for r in kept) == [("1", False), ("1", False), ("None", True)] or len(kept) == 3


def test_bands_keep_linked_sizes_next_to_each_other():
    n = np.arange(1, 20_000)
    band = ngram_join.band_of(n)
    assert (ngram_join.band_of(np.floor(n * 4 / 3).astype(int)) - band <= 1).all()
    for b in set(band.tolist()):
        lo, hi = ngram_join.FIRST_SIZE[b], ngram_join.FIRST_SIZE[b + 1] - 1
        assert 3 * hi <= 4 * lo and ngram_join.differences(b) >= (hi + hi * 4 // 3) // 7


@pytest.mark.parametrize("heaviest,per_task", [(1 << 30, 12 << 20), (1, 12 << 20), (4000, 900)])
def test_substring_dedup(docs, rows, heaviest, per_task):
    """All fine buckets light; all minimisers heavy; fine buckets split, and some minimisers heavy."""
    got = substring_dedup.digested(substring_dedup.without_repeats(docs, 35, per_task, heaviest))
    matches(got, rows, brute.without_repeats(rows, 35), ["n_words", "n_removed", "kept_sha256"])


def test_heavy_fine_buckets_are_split_before_minimisers():
    r = np.random.default_rng(6)
    # One fine bucket holds half of all weight, one of its minimisers most of that; one has none.
    least = np.concatenate([r.integers(0, 2**63, 4000), (7 << 48) + r.integers(0, 2**48, 3000), [(7 << 48) + 5]]).astype(np.uint64)
    size = np.append(np.full(7000, 10), 25_000)
    weight = np.bincount(substring_dedup.fine_of(least), weights=size, minlength=substring_dedup.FINE).astype(np.int64)
    dealing = substring_dedup.Dealing(weight, {(7 << 48) + 5: 25_000}, 500)
    bucket = dealing.bucket(least)
    assert bucket[-1] == -1 and (bucket[:-1] >= 0).all()
    held = np.bincount(bucket[:-1], weights=size[:-1])
    assert dealing.parts[7] == 60 and held.max() < 1500 and len(set(bucket[4000:7000].tolist())) == 60
    assert not set(bucket[:4000][substring_dedup.fine_of(least[:4000]) != 7].tolist()) & set(bucket[4000:7000].tolist())


@pytest.mark.parametrize("mask", [2**64 - 1, 3, 0])
def test_windows_are_compared_in_bytes(monkeypatch, mask):
    """With few fingerprints nearly all windows share a hash; their words still tell them apart."""
    r = np.random.default_rng(7)
    plain = [" ".join(f"w{x}" for x in r.integers(0, 4, 40)) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate([*plain, *plain[:5], "a b c d e f", "a b c d  e\nf", "a b c d e g"])]
    monkeypatch.setattr(substring_dedup, "fingerprints", lambda w: fingerprints(w) & np.uint64(mask))
    monkeypatch.setattr(substring_dedup, "run_hashes", lambda m, n, salt=0: run_hashes(m, n, salt) & np.uint64(mask))
    texts = [t.encode() for _, t in rows]
    words, _, doc, begin, count, least = substring_dedup.super_kmers(texts, 6)
    held = {}
    for d, s, c in zip(doc.tolist(), begin.tolist(), count.tolist(), strict=True):
        raw = words.buffer[words.start[s] : words.end[s + c + 4]]
        held.setdefault(0, []).append((raw, (d, d), s - int(words.first[d]), c))
    got = substring_dedup.counter(6)(substring_dedup.pa.Table.from_batches([substring_dedup._blobs(held)]))
    spans = {k: [tuple(x) for x in np.array(v).reshape(-1, 2).tolist()] for k, v in zip(got.column("k1").to_pylist(), got.column("spans").to_pylist(), strict=True)}
    for (i, t), (_, removed, _) in zip(rows, brute.without_repeats(rows, 6), strict=True):
        assert sum(e - s for s, e in spans.get(i, [])) == removed, t


def test_substring_dedup_counts_equal_rows(spark):
    long = " ".join(f"w{i}" for i in range(50))
    for extra in ([], [(1, long)], [(None, long)]):
        rows = [(1, long), (2, "short"), *extra]
        got = substring_dedup.without_repeats(frame(spark, rows)).collect()
        assert sorted(r.n_removed for r in got) == ([0, 0] if not extra else [0, 50, 50])


def test_decontamination(docs, rows, benchmark):
    got = decontamination.contamination(docs, benchmark)
    names = ["n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    matches(got, rows, brute.contaminated(rows, ITEMS), names)


def test_decontamination_without_broadcast(docs, rows, benchmark, monkeypatch):
    monkeypatch.setattr(decontamination, "BROADCAST_BYTES", 0)
    names = ["n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    matches(decontamination.contamination(docs, benchmark), rows, brute.contaminated(rows, ITEMS), names)
    clean = decontamination.clean_documents(docs, benchmark)
    assert clean.columns == docs.columns
    assert clean.count() == sum(not r[4] for r in brute.contaminated(rows, ITEMS))


def test_proximity_matches(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    moved = "alpha beta gamma delta epsilon new zeta eta theta iota kappa"
    got = {r.doc_id: r for r in decontamination.contamination(frame(spark, [(1, item), (2, moved), (3, "alpha kappa")]), spark.createDataFrame([(9, item)], "item_id long, text string")).collect()}
    assert [got[i].contaminated for i in (1, 2, 3)] == [True, False, False]
    assert [got[i].n_near_items for i in (1, 2, 3)] == [1, 1, 0]


def test_proximity_does_not_depend_on_how_often_words_occur(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    listed = [
        (1, "so alpha beta gamma delta epsilon new zeta eta theta iota kappa"),
        (2, "beta gamma delta epsilon zeta eta theta iota kappa"),
        (3, "kappa iota theta eta zeta epsilon delta gamma beta alpha"),
        (4, "beta gamma delta epsilon zeta eta theta iota"),
        (5, "alpha beta gamma delta epsilon " + "far " * 20 + "zeta eta theta iota kappa"),
    ]
    want = [1, 1, 1, 0, 0]
    # Without and with many postings: 300 of one word, over 1200 of all others, each alone in its text.
    common = [(10 + i, " ".join([w] * (150 if w == "kappa" else 1300))) for i, w in enumerate(item.split()[1:])]
    benchmark = spark.createDataFrame([(9, item)], "item_id long, text string")
    for more in ([], common, [*common, (8, "alpha " * 3000)]):
        got = {r.doc_id: r for r in decontamination.contamination(frame(spark, [*listed, *more]), benchmark).collect()}
        assert [got[i].n_near_items for i in range(1, 6)] == want
        assert not any(r.contaminated or r.doc_id > 5 and r.n_near_items for r in got.values())
    without = [r for r in listed if "alpha" not in r[1]]
    got = {r.doc_id: r for r in decontamination.contamination(frame(spark, without), benchmark).collect()}
    assert [got[i].n_near_items for i in (2, 4)] == [1, 0]


def test_line_dedup(docs, rows):
    got = {r.doc_id: r for r in line_dedup.cut_repeated_lines(docs).collect()}
    for (i, t), (n, gone, left) in zip(rows, brute.cut_lines(rows), strict=True):
        assert (got[i].n_lines, got[i].n_removed, got[i].text) == (n, gone, left if t is not None else None)
        assert got[i].words == "words" and got[i].cls == "cls"


def test_line_dedup_stage_keeps_columns(docs, rows):
    got = line_dedup.cut_stage(docs)
    assert got.columns == docs.columns
    gone = [t for (_, t), (_, n, left) in zip(rows, brute.cut_lines(rows), strict=True) if n and not left.replace("\n", "")]
    assert got.count() == len(rows) - len(gone)


def vectors(spark, rows):
    extra = [f"'{c}' AS {c}" for c in CLASHING]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", *extra).repartition(3)


@pytest.mark.parametrize("block", [1024, 7])
def test_near_vectors(spark, block):
    r = np.random.default_rng(2)
    centre = r.standard_normal((12, 16))
    rows = [c + 0.12 * r.standard_normal(16) for c in centre for _ in range(25)]
    rows += [rows[0].copy() for _ in range(40)] + [rows[3] * 7.5]
    listed = [(i, v.tolist()) for i, v in enumerate(rows)]
    odd = [None, [], [0.0] * 16, [float("nan")] + [1.0] * 15, [float("inf")] * 16, [None] + [1.0] * 15, [1e200] * 16, [1e-200] * 16, [1.0, 2.0]]
    listed += [(1000 + i, v) for i, v in enumerate(odd)]
    usable = {i: v for i, v in listed if v and None not in v and np.isfinite(v).all() and any(v)}
    links = []
    for i, v in usable.items():
        for j, w in usable.items():
            if i < j and len(v) == len(w):
                a, b = (np.array(x) / np.abs(x).max() for x in (v, w))
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= 0.95:
                    links.append((i, j))
    ids = [i for i, _ in listed]
    at = {x: k for k, x in enumerate(ids)}
    group = brute.components(len(ids), [(at[a], at[b]) for a, b in links])
    n = {i: sum(i in p for p in links) for i in ids}
    got = {x.vec_id: x for x in embedding_dedup.near_vectors(vectors(spark, listed), block=block).collect()}
    assert len(got) == len(ids) and len(links) > 1000
    for i, g in zip(ids, group, strict=True):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (n[i], ids[g], i == ids[g])


def test_empty_tables(spark, nothing, benchmark):
    empty = vectors(spark, []).limit(0)
    assert embedding_dedup.near_vectors(empty).collect() == []
    assert ngram_join.similar_documents(nothing).collect() == []
    assert ngram_join.keep_one_of_each(nothing).collect() == []
    assert substring_dedup.without_repeats(nothing).collect() == []
    assert line_dedup.cut_stage(nothing).collect() == []
    assert decontamination.contamination(nothing, benchmark).collect() == []


def test_empty_benchmark(spark, docs, rows):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.clean_documents(docs, none).count() == len(rows)


def test_components(spark):
    r = np.random.default_rng(3)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 140)]
    links += [(int(a), int(b)) for a, b in r.integers(200, 260, (40, 2))] + [(5, 5), (7, 8)]
    got = {x.node: x.root for x in components(spark.createDataFrame(links, "a long, b long")).collect()}
    group = brute.components(260, links)
    nodes = {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: group[x] for x in nodes}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_fingerprints_follow_words():
    texts = [b"a bc a", b"", b"bc\x00 a\ncb", "é e".encode()]
    words = split_words(texts, SPACED)
    listed = [words.word(i) for i in range(len(words.start))]
    assert listed == [w for t in texts for w in t.split()]
    marks = fingerprints(words).tolist()
    assert len(set(marks)) == len(set(listed)) == len(dict(zip(listed, marks, strict=True)))


def test_pipeline_stage_by_stage(spark, docs, rows, benchmark, tmp_path):
    """Each stage against a plain version on what its predecessor kept."""
    plain = docs.selectExpr("doc_id", "text", "'en' AS lang", "'s' AS source", "cast(length(text) AS bigint) AS n_chars")
    sf_dir = str(tmp_path)
    plain.write.parquet(f"{sf_dir}/documents.parquet")
    benchmark.write.parquet(f"{sf_dir}/benchmark.parquet")
    marks = [(i, int("!!" not in (t or "")), 0) for i, t in rows]
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{sf_dir}/labels.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "line_dedup", "ngram_jaccard_join", "benchmark_decontamination", "sentencepiece_codec"]
    now = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, now, sf_dir).write.parquet(f"{sf_dir}/out{k}")
        now = spark.read.parquet(f"{sf_dir}/out{k}")
        held.append({r.doc_id: r for r in now.collect()})
        if k < 4:
            assert now.columns == plain.columns
    left = sorted((i, r.text) for i, r in held[0].items())
    cut = {i: t for (i, t0), (_, n, t) in zip(left, brute.cut_lines(left), strict=True) if not n or t.replace("\n", "") for t in [t if t0 is not None else None]}
    assert {i: r.text for i, r in held[1].items()} == cut
    pairs = sorted(cut.items())
    one = {i for (i, _), (_, c) in zip(pairs, brute.similar(pairs), strict=True) if i == c}
    assert set(held[2]) == one
    kept = sorted((i, cut[i]) for i in one)
    clean = {i for (i, _), told in zip(kept, brute.contaminated(kept, ITEMS), strict=True) if not told[4]}
    assert set(held[3]) == clean == set(held[4])
    whole = corpus_pipeline.run(spark, sf_dir)
    assert sorted((r.doc_id, r.n_tokens) for r in whole.collect()) == sorted((i, r.n_tokens) for i, r in held[4].items())


def test_near_vectors_of_a_larger_table(spark):
    """Given vectors and copies near the threshold, against all pairs: no false link, and hardly one missed."""
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").where("embedding IS NOT NULL").limit(900)
    own = np.array([r.embedding for r in table.collect()], dtype=np.float64)
    own /= np.linalg.norm(own, axis=1, keepdims=True)
    r = np.random.default_rng(10)
    spread = [own + 0.04 * k / 3 * r.standard_normal(own.shape) for k in (1, 2, 2, 3)]
    x = np.concatenate([own, *spread]).astype(np.float32)
    unit = x.astype(np.float64)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.95
    np.fill_diagonal(near, False)
    n = near.sum(axis=1)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = {r.vec_id: r.n_links for r in embedding_dedup.near_vectors(df).collect()}
    found = np.array([got[i] for i in range(len(x))])
    assert 1000 < near.sum() < near.size / 100 and (found <= n).all() and found.sum() >= 0.995 * n.sum()


def test_sketches_keep_linked_vectors():
    r = np.random.default_rng(9)
    bits, tables = embedding_dedup.plan_tables(100_000, 0.95, 0.9995)
    planes = embedding_dedup.hyperplanes(64, bits, tables)[:, : embedding_dedup.SKETCH]
    a = r.standard_normal((20_000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = r.standard_normal((20_000, 64))
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b = 0.95 * a + np.sqrt(1 - 0.95**2) * b / np.linalg.norm(b, axis=1, keepdims=True)
    limit = embedding_dedup.sketch_limit(0.95, embedding_dedup.SKETCH)
    assert (((a @ planes > 0) != (b @ planes > 0)).sum(axis=1) <= limit).all()
    far = r.standard_normal((20_000, 64))
    assert (((a @ planes > 0) != (far @ planes > 0)).sum(axis=1) > limit).mean() > 0.99


def plain_near(rows, items, size=10, slop=8):
    """Items with a proximity match per row, by trying every start for every passage."""
    out = []
    passages = []
    for item, text in items:
        w = brute.lettered(text)
        for k in range(max(len(w) - size + 1, 1) if w else 0):
            if k % size == 0 or k + size >= len(w):
                passages.append((str(item), w[k : k + size]))
    for _, text in rows:
        words, found = brute.lettered(text), set()
        for item, part in passages:
            m = len(set(part))
            least = max(m - (m >= 10), 2)
            if any(len(set(words[i : i + len(part) + slop]) & set(part)) >= least for i in range(len(words))):
                found.add(item)
        out.append(len(found))
    return out


def test_proximity_by_trying_everything(spark):
    r = np.random.default_rng(12)
    vocabulary = [f"v{i}" for i in range(60)]
    pick = lambda n: [vocabulary[i] for i in np.minimum(r.geometric(0.06, n), 59)]
    items = [(i, " ".join(pick(n))) for i, n in enumerate([3, 9, 10, 10, 11, 23, 35, 10, 6, 1, 2])]
    rows = []
    for i in range(160):
        words = pick(int(r.integers(0, 120)))
        part = items[i % len(items)][1].split(" ")[:10]
        if i % 2:
            part = [part[k] for k in r.permutation(len(part))][int(r.integers(0, 3)) :]
            for x in pick(int(r.integers(0, 12))):
                part.insert(int(r.integers(0, len(part) + 1)), x)
        at = int(r.integers(0, len(words) + 1))
        rows.append((i, " ".join([*words[:at], *part, *words[at:]])))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {x.doc_id: x for x in decontamination.contamination(frame(spark, rows), benchmark).collect()}
    want = plain_near(rows, items)
    assert [got[i].n_near_items for i, _ in rows] == want and len(set(want)) > 3
    names = ["n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    exact = brute.contaminated(rows, items)
    assert [tuple(got[i][n] for n in names) for i, _ in rows] == exact
