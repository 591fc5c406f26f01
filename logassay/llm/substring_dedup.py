"""Repeated word windows, by super-k-mers.

The windows of a text are grouped into runs that share a minimiser (the least
hash of the short grams inside a window). Such a run travels as one string to
the bucket of its minimiser; equal windows have equal minimisers, so a bucket
sees every occurrence of its windows. It sorts them by 128 bits of hash and then
compares neighbours word by word, in bytes.

A first pass weighs the runs per fine bucket, the first 16 bits of the minimiser
(at most ``FINE`` rows reach the driver). Light fine buckets are laid together to
tasks of equal weight; heavy ones are split by the next 32 bits. Only a single
minimiser that is heavier than ``heaviest`` is not gathered: a second pass, over
the heavy fine buckets alone, finds those (fewer than the runs' bytes divided by
``heaviest``), and their windows become rows that are counted by hash with partial
sums and joined back, which Spark can split.

Results: null and empty texts have no words and no windows; each row is a
document of its own, also when ids or whole rows repeat (their windows are then
repeated); texts shorter than a window are never cut; texts are taken whole; an
empty table gives an empty result; extra columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logassay.llm.common import map_batches, map_texts, ship_package, slices, stored, texts_of
from logassay.llm.word_arrays import SPACED, fingerprints, run_hashes, split_words

WINDOW = 35
GRAM = 5
FINE = 1 << 16
BUFFERED = 24 << 20
PER_TASK = 12 << 20
HEAVIEST = 96 << 20
NEVER = np.uint64(2**64 - 1)
PIECE = 1 << 22


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text, and two hashes that tell rows apart (equal rows are interchangeable)."""
    return texts_of(docs, "doc_id", "text").withColumns(
        {"k1": F.xxhash64("doc_id", "text"), "k2": F.xxhash64(F.lit(7), "text", "doc_id")}
    )


def super_kmers(raw: list[bytes], window: int):
    """Words, and per run of windows with one minimiser: text, first word, windows, minimiser."""
    words = split_words(raw, SPACED)
    marks = fingerprints(words)
    n = len(marks) - window + 1
    empty = np.empty(0, dtype=np.int64)
    if n <= 0:
        return words, marks, empty, empty, empty, empty.astype(np.uint64)
    gram = min(GRAM, window)
    least = run_hashes(marks, gram)
    wide, span = 1, window - gram + 1
    while wide * 2 <= span:
        least = np.minimum(least[:-wide], least[wide:])
        wide *= 2
    if wide < span:
        least = np.minimum(least[: len(least) - (span - wide)], least[span - wide :])
    doc = words.doc
    inside = doc[:n] == doc[window - 1 :]
    least = np.where(inside, least[:n], NEVER)
    new = np.ones(n, dtype=bool)
    new[1:] = (least[1:] != least[:-1]) | (doc[1:n] != doc[: n - 1])
    begin = np.flatnonzero(new)
    count = np.diff(np.append(begin, n))
    use = inside[begin]
    begin, count = begin[use], count[use]
    return words, marks, doc[begin], begin, count, least[begin]


def fine_of(least: np.ndarray) -> np.ndarray:
    return (least >> np.uint64(48)).astype(np.int64)


def run_bytes(words, begin: np.ndarray, count: np.ndarray, window: int) -> np.ndarray:
    return words.end[begin + count + window - 2] - words.start[begin]


def weights(docs: DataFrame, window: int) -> np.ndarray:
    """Bytes of runs per fine bucket."""

    def work(raw: list[bytes], _: dict) -> dict:
        words, _, _, begin, count, least = super_kmers(raw, window)
        if not len(begin):
            return {"fine": pa.array([], pa.int64()), "weight": pa.array([], pa.int64())}
        size = run_bytes(words, begin, count, window)
        total = np.bincount(fine_of(least), weights=size, minlength=1).astype(np.int64)
        at = np.flatnonzero(total)
        return {"fine": at, "weight": total[at]}

    summed = map_texts(docs.select("text"), "fine long, weight long", work)
    out = np.zeros(FINE, dtype=np.int64)
    for r in summed.groupBy("fine").agg(F.sum("weight").alias("weight")).collect():
        out[r.fine] = r.weight
    return out


def heavy_minimisers(docs: DataFrame, fine: np.ndarray, window: int, heaviest: int) -> dict[int, int]:
    """Weights of the single minimisers above ``heaviest``, looked for in the fine buckets that are."""
    chosen = docs.sparkSession.sparkContext.broadcast(fine)

    def work(raw: list[bytes], _: dict) -> dict:
        words, _, _, begin, count, least = super_kmers(raw, window)
        use = chosen.value[fine_of(least)]
        least, own = np.unique(least[use], return_inverse=True)
        total = np.bincount(own, weights=run_bytes(words, begin[use], count[use], window), minlength=len(least))
        return {"least": least.view(np.int64), "weight": total.astype(np.int64)}

    summed = map_texts(docs.select("text"), "least long, weight long", work)
    rows = summed.groupBy("least").agg(F.sum("weight").alias("weight")).where(F.col("weight") > heaviest).collect()
    return {r.least % (1 << 64): r.weight for r in rows}


class Dealing:
    """The bucket of every minimiser, -1 for the heavy ones."""

    def __init__(self, weight: np.ndarray, heavy: dict[int, int], per_task: int):
        self.heavy = np.array(sorted(heavy), dtype=np.uint64)
        weight = weight - np.bincount(
            fine_of(self.heavy), weights=[heavy[int(x)] for x in self.heavy], minlength=len(weight)
        ).astype(np.int64)
        # Fine buckets of less than a task's weight share one; the others have several of their own.
        self.parts = np.maximum(1, -(-weight // per_task))
        alone = self.parts > 1
        shared = np.cumsum(np.where(alone, 0, weight)) // per_task
        own = np.cumsum(np.where(alone, self.parts, 0)) - np.where(alone, self.parts, 0)
        self.first = np.where(alone, shared[-1] + 1 + own, shared)

    def bucket(self, least: np.ndarray) -> np.ndarray:
        fine = fine_of(least)
        within = ((least << np.uint64(16)) >> np.uint64(32)).astype(np.int64)
        out = self.first[fine] + (within * self.parts[fine] >> 32)
        out[self.is_heavy(least)] = -1
        return out

    def is_heavy(self, least: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.heavy, least)
        return (at < len(self.heavy)) & (np.append(self.heavy, np.uint64(0))[at] == least)


BLOB = "bucket long, texts binary, raw_size long, keys binary, runs binary"
RUN = np.dtype([("doc", "<i4"), ("start", "<i4"), ("count", "<i4")])


def _blobs(held: dict[int, list[tuple[bytes, tuple[int, int], int, int]]]) -> pa.RecordBatch:
    rows: dict[str, list] = {c: [] for c in ("bucket", "texts", "raw_size", "keys", "runs")}
    for bucket, runs in held.items():
        texts = b"\n".join(r[0] for r in runs)
        number = {k: i for i, k in enumerate(dict.fromkeys(r[1] for r in runs))}
        rows["bucket"].append(bucket)
        rows["texts"].append(pa.compress(texts, codec="zstd", asbytes=True))
        rows["raw_size"].append(len(texts))
        rows["keys"].append(np.array(list(number), dtype=np.int64).tobytes())
        rows["runs"].append(np.array([(number[k], s, c) for _, k, s, c in runs], dtype=RUN).tobytes())
    return pa.RecordBatch.from_arrays(
        [
            pa.array(rows["bucket"], pa.int64()), pa.array(rows["texts"], pa.binary()),
            pa.array(rows["raw_size"], pa.int64()), pa.array(rows["keys"], pa.binary()),
            pa.array(rows["runs"], pa.binary()),
        ],
        names=list(rows),
    )


def travelling(docs: DataFrame, dealing: Dealing, window: int) -> DataFrame:
    """The runs of all texts, compressed per bucket and buffer; bucket -1 is left out."""
    shared = docs.sparkSession.sparkContext.broadcast(dealing)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        size = 0
        for batch in batches:
            for part in slices(batch):
                words, _, doc, begin, count, least = super_kmers(
                    part.column("text").cast(pa.binary()).to_pylist(), window
                )
                keys = list(zip(part.column("k1").to_pylist(), part.column("k2").to_pylist(), strict=True))
                bucket = shared.value.bucket(least)
                first, last = words.start[begin], words.end[begin + count + window - 2]
                start = begin - words.first[doc]
                for b, d, s, c, x, y in zip(
                    bucket.tolist(), doc.tolist(), start.tolist(), count.tolist(), first.tolist(), last.tolist(),
                    strict=True,
                ):
                    if b >= 0:
                        held.setdefault(b, []).append((words.buffer[x:y], keys[d], s, c))
                        size += y - x
            if size >= BUFFERED:
                yield _blobs(held)
                held, size = {}, 0
        if held:
            yield _blobs(held)

    return map_batches(docs.select("k1", "k2", "text"), BLOB, run)


SPANS = "k1 long, k2 long, spans array<int>"


def merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Overlapping or touching half-open spans, sorted by start, as one."""
    reach = np.maximum.accumulate(end)
    new = np.append(True, start[1:] > reach[:-1])
    at = np.flatnonzero(new)
    return start[at], reach[np.append(at[1:] - 1, len(start) - 1)]


def span_rows(doc: np.ndarray, start: np.ndarray, keys: np.ndarray, window: int) -> pa.Table:
    """Merged spans of the repeated windows of each document."""
    order = np.lexsort((start, doc))
    doc, start = doc[order], start[order]
    edges = np.append(np.flatnonzero(np.diff(doc, prepend=-1)), len(doc))
    k1, k2, spans = [], [], []
    for s, e in zip(edges[:-1], edges[1:], strict=True):
        a, b = merged(start[s:e], start[s:e] + window)
        k1.append(keys[doc[s], 0])
        k2.append(keys[doc[s], 1])
        spans.append(np.stack([a, b], axis=1).ravel().astype(np.int32))
    return pa.table(
        {"k1": pa.array(k1, pa.int64()), "k2": pa.array(k2, pa.int64()), "spans": pa.array(spans, pa.list_(pa.int32()))}
    )


def exact_words(words, marks: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Numbers for the words at ``places``, equal if and only if their bytes are."""
    _, first, number = np.unique(marks[places], return_index=True, return_inverse=True)
    start, length = words.start[places], (words.end - words.start)[places]
    like = first[number]
    differs = length != length[like]
    data = np.frombuffer(words.buffer, dtype=np.uint8)
    for size in np.unique(length).tolist():
        own = np.flatnonzero((length == size) & ~differs & (like != np.arange(len(places))))
        for s in range(0, len(own), PIECE // size + 1):
            part = own[s : s + PIECE // size + 1]
            step = np.arange(size)
            differs[part] = (data[start[part][:, None] + step] != data[start[like[part]][:, None] + step]).any(axis=1)
    # Words that share a fingerprint with another one get numbers by their bytes.
    apart: dict[bytes, int] = {}
    for i in np.flatnonzero(differs):
        number[i] = apart.setdefault(words.word(int(places[i])), len(first) + len(apart))
    return number


def confirmed(words, marks: np.ndarray, at: np.ndarray, same: np.ndarray, window: int) -> np.ndarray:
    """Which of the windows that begin at the words ``at``, sorted by hash, occur more than once.

    ``same`` tells neighbours of one hash; they count if all their words are equal.
    """
    again = np.append(False, same) | np.append(same, False)
    if not same.any():
        return again
    covered = np.zeros(len(marks) + 1, dtype=np.int64)
    np.add.at(covered, at[again], 1)
    np.add.at(covered, at[again] + window, -1)
    places = np.flatnonzero(np.cumsum(covered[:-1]))
    number = np.full(len(marks), -1, dtype=np.int64)
    number[places] = exact_words(words, marks, places)
    pairs = np.flatnonzero(same)
    equal = np.ones(len(pairs), dtype=bool)
    for k in range(window):
        equal &= number[at[pairs] + k] == number[at[pairs + 1] + k]
    if equal.all():
        return again
    # Different windows of one hash: each group of that hash is counted by its words.
    group = np.cumsum(np.append(True, ~same))
    for g in np.unique(group[pairs[~equal]]):
        own = np.flatnonzero(group == g)
        kept = [number[at[i] : at[i] + window].tobytes() for i in own]
        times = {k: kept.count(k) for k in set(kept)}
        again[own] = [times[k] > 1 for k in kept]
    return again


def counter(window: int):
    """Sorts the windows of a bucket and gives the spans of those that occur again."""

    def count(table: pa.Table) -> pa.Table:
        raw, keys, runs, offset = [], [], [], 0
        for row in table.to_pylist():
            raw.append(pa.decompress(row["texts"], row["raw_size"], codec="zstd", asbytes=True))
            own = np.frombuffer(row["keys"], dtype=np.int64).reshape(-1, 2)
            part = np.frombuffer(row["runs"], dtype=RUN).copy()
            part["doc"] += offset
            offset += len(own)
            keys.append(own)
            runs.append(part)
        keys, inverse = np.unique(np.concatenate(keys), axis=0, return_inverse=True)
        runs = np.concatenate(runs)
        words = split_words(raw, SPACED)
        marks = fingerprints(words)
        n = runs["count"].astype(np.int64)
        # A run of n windows has n + window - 1 words, and runs lie in order.
        at = np.arange(n.sum()) + np.repeat(np.arange(len(n)) * (window - 1), n)
        one, two = run_hashes(marks, window)[at], run_hashes(marks, window, salt=29)[at]
        order = np.lexsort((two, one))
        same = (one[order][1:] == one[order][:-1]) & (two[order][1:] == two[order][:-1])
        again = np.zeros(len(order), dtype=bool)
        again[order] = confirmed(words, marks, at[order], same, window)
        which = np.repeat(np.arange(len(runs)), n)
        start = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + runs["start"][which]
        doc = inverse.ravel()[runs["doc"]][which]
        return span_rows(doc[again], start[again], keys, window)

    return count


def heavy_spans(docs: DataFrame, dealing: Dealing, window: int) -> DataFrame:
    """Spans of the repeated windows of heavy minimisers, window by window."""
    shared = docs.sparkSession.sparkContext.broadcast(dealing)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                words, marks, doc, begin, count, least = super_kmers(
                    part.column("text").cast(pa.binary()).to_pylist(), window
                )
                use = shared.value.is_heavy(least)
                doc, begin, count = doc[use], begin[use], count[use]
                at = np.repeat(begin - np.cumsum(count) + count, count) + np.arange(count.sum())
                doc = np.repeat(doc, count)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(run_hashes(marks, window)[at].view(np.int64)),
                        pa.array(run_hashes(marks, window, salt=29)[at].view(np.int64)),
                        part.column("k1").take(pa.array(doc)), part.column("k2").take(pa.array(doc)),
                        pa.array((at - words.first[doc]).astype(np.int32)),
                    ],
                    names=["h1", "h2", "k1", "k2", "start"],
                )

    rows = map_batches(
        docs.select("k1", "k2", "text"), "h1 long, h2 long, k1 long, k2 long, start int", run
    )
    again = rows.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h1", "h2")
    return (
        rows.join(again, ["h1", "h2"])
        .select("k1", "k2", "start")
        .distinct()
        .select("k1", "k2", F.array("start", (F.col("start") + window).cast("int")).alias("spans"))
    )


def repeated_spans(
    docs: DataFrame, window: int = WINDOW, per_task: int = PER_TASK, heaviest: int = HEAVIEST
) -> DataFrame:
    """k1, k2 and ``spans`` (start, end, start, end, ... in words) for rows with repeated windows."""
    weight = weights(docs, window)
    fine = weight > heaviest
    heavy = heavy_minimisers(docs, fine, window, heaviest) if fine.any() else {}
    dealing = Dealing(weight, heavy, per_task)
    ship_package(docs.sparkSession)
    spans = travelling(docs, dealing, window).groupBy("bucket").applyInArrow(counter(window), SPANS)
    if heavy:
        spans = spans.unionAll(heavy_spans(docs, dealing, window))
    return spans.groupBy("k1", "k2").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def without_repeats(
    docs: DataFrame, window: int = WINDOW, per_task: int = PER_TASK, heaviest: int = HEAVIEST
) -> DataFrame:
    """doc_id, n_words, n_removed and ``kept`` (the words left, joined by spaces) for every row."""
    rows = keyed(docs)
    found = repeated_spans(rows, window, per_task, heaviest)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def work(raw: list[bytes], rest: dict) -> dict:
        total, removed, kept = [], [], []
        for text, spans in zip(raw, rest["spans"], strict=True):
            words = text.split()
            stay = words
            if spans:
                edges = np.array(spans).reshape(-1, 2)
                edges = edges[np.argsort(edges[:, 0], kind="stable")]
                start, end = merged(edges[:, 0], edges[:, 1])
                stay = []
                for a, b in zip(np.append(0, end), np.append(start, len(words)), strict=True):
                    stay += words[a:b]
            total.append(len(words))
            removed.append(len(words) - len(stay))
            kept.append(b" ".join(stay).decode())
        return {"doc_id": rest["doc_id"], "n_words": total, "n_removed": removed, "kept": kept}

    joined = rows.join(found, ["k1", "k2"], "left").select("doc_id", "text", "spans")
    return map_texts(joined, f"doc_id {kind}, n_words long, n_removed long, kept string", work)


def digested(cut: DataFrame) -> DataFrame:
    """The same with a SHA-256 of the kept words instead of the words."""
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
