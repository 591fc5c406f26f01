"""Documents drawn by importance towards a target set of texts.

Features are runs of one to ``longest`` consecutive words, hashed to buckets.
A bucket's gain is the log ratio of its smoothed shares in the target and in the
corpus; a document's weight is the mean gain of its features. Drawing without
replacement with odds by weight is done by adding a Gumbel variate that follows
from the document's id, and taking the highest sums.

Within a batch of texts every feature is interned in an open-addressed NumPy
table: keys are xxhash64 values, a probe that meets an equal key compares the
feature's bytes, and a slot holds the feature's bucket and its count. All
occurrences probe at once, round by round, and keep the number of their slot;
counts are taken from the slots, and gains are gathered by slot number.

Only bucket sums leave the tasks: ``buckets`` numbers for a task, summed in
Spark, and ``buckets`` gains are sent back. Ranks come from a range-partitioned
sort whose partitions are numbered on.

Results: null and empty texts have no features and weight 0; a null id draws
like the empty id and comes last among ties; repeated rows are documents of
their own (equal ones take ranks in any order); an empty corpus gives an empty
result, an empty target gains that favour rare buckets; long texts are taken
whole; extra columns play no part.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logassay.llm.common import map_batches, slices, stored, texts_of
from logassay.operators.order import positions

BUCKETS = 10_000
# Letters A-Z become small; what is neither a digit, a letter nor beyond ASCII parts words.
WORD_BYTES = bytes(
    b if b >= 0x80 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 0x20
    for b in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


def runs(words: list[bytes], longest: int) -> list[bytes]:
    """All runs of 1 to ``longest`` consecutive words."""
    out = list(words)
    for n in range(2, longest + 1):
        out += [b" ".join(words[i : i + n]) for i in range(len(words) - n + 1)]
    return out


class Slots:
    """An open-addressed table of the distinct features of one batch.

    ``slot`` holds each occurrence's slot; ``bucket`` and ``count`` are by slot.
    """

    def __init__(self, features: list[bytes], buckets: int, capacity: int | None = None):
        n = len(features)
        size = capacity or 1 << max(4, (2 * n - 1).bit_length() if n else 4)
        mask = np.uint64(size - 1)
        values = np.empty(n, dtype=object)
        values[:] = features
        keys = np.fromiter(map(xxhash.xxh64_intdigest, features), dtype=np.uint64, count=n)
        holder = np.full(size, -1, dtype=np.int64)  # the occurrence that stands in a slot
        self.slot = np.empty(n, dtype=np.int64)
        todo = np.arange(n)
        at = (keys & mask).astype(np.int64)
        while len(todo):
            free = holder[at] < 0
            holder[at[free]] = todo[free]
            first = holder[at]
            same = keys[first] == keys[todo]
            same[same] = values[first[same]] == values[todo[same]]
            self.slot[todo[same]] = at[same]
            todo, at = todo[~same], (at[~same] + 1) & int(mask)
        self.count = np.bincount(self.slot, minlength=size)
        self.bucket = np.zeros(size, dtype=np.int64)
        used = np.flatnonzero(holder >= 0)
        self.bucket[used] = [zlib.crc32(values[holder[i]]) % buckets for i in used]


def features_by_row(raw: list[bytes], longest: int) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """All features of some texts, the number of features of each, and of words."""
    features: list[bytes] = []
    sizes, words = np.empty(len(raw), dtype=np.int64), np.empty(len(raw), dtype=np.int64)
    for i, text in enumerate(raw):
        own = words_of(text)
        words[i] = len(own)
        own = runs(own, longest) if longest > 1 else own
        sizes[i] = len(own)
        features += own
    return features, sizes, words


def bucket_sums(texts: DataFrame, longest: int, buckets: int) -> np.ndarray:
    """Features per bucket over all texts; ``buckets`` rows reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for part in slices(batch):
                raw = part.column("text").cast(pa.binary()).to_pylist()
                table = Slots(features_by_row(raw, longest)[0], buckets)
                total += np.bincount(table.bucket, weights=table.count, minlength=buckets).astype(np.int64)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    summed = map_batches(texts.select("text"), "bucket long, n long", run)
    out = np.zeros(buckets, dtype=np.int64)
    for r in summed.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the smoothed target share over the smoothed corpus share) by bucket."""
    k, s_all, t_all = len(corpus), int(corpus.sum()), int(target.sum())
    ratio = [
        float(t + 1) * (s_all + k) / (float(s + 1) * (t_all + k))
        for s, t in zip(corpus.tolist(), target.tolist(), strict=True)
    ]
    return np.array([math.floor(1000 * math.log(x)) for x in ratio], dtype=np.int64)


def weighed(docs: DataFrame, gain: np.ndarray, longest: int) -> DataFrame:
    """doc_id, n_words, n_features and weight of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                raw = part.column("text").cast(pa.binary()).to_pylist()
                features, sizes, words = features_by_row(raw, longest)
                table = Slots(features, len(gain))
                each = np.concatenate(([0], np.cumsum(gain[table.bucket][table.slot])))
                end = np.cumsum(sizes)
                weight = (each[end] - each[end - sizes]) // np.maximum(sizes, 1)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(words), pa.array(sizes), pa.array(weight)],
                    names=["doc_id", "n_words", "n_features", "weight"],
                )

    return map_batches(docs, f"doc_id {kind}, n_words long, n_features long, weight long", run)


def resampled(
    docs: DataFrame, target: DataFrame, longest: int = 1, buckets: int = BUCKETS,
    least_words: int = 20, percent: int = 10, seed: int = 2024,
) -> DataFrame:
    """doc_id, n_features, weight, score and rank (null where not drawn) for every row of ``docs``."""
    rows = texts_of(docs, "doc_id", "text")
    gain = gains(
        bucket_sums(rows, longest, buckets),
        bucket_sums(texts_of(target, "text"), longest, buckets),
    )
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    gumbel = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")
    scored = stored(
        weighed(rows, gain, longest).withColumn("score", F.col("weight") + gumbel), "weights"
    )
    able = scored.where(F.col("n_words") >= least_words)
    drawn = able.count() * percent // 100
    ranked = positions(
        able, [F.desc("score"), F.asc_nulls_last("doc_id")], "rank", salt=F.xxhash64(F.monotonically_increasing_id())
    )
    columns = ["doc_id", "n_features", "weight", "score"]
    rank = F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank")
    return ranked.select(*columns, rank).unionAll(
        scored.where(F.col("n_words") < least_words).select(*columns, F.lit(None).cast("long").alias("rank"))
    )


SQL = r"""
WITH crc AS (
    SELECT list(v ORDER BY i) AS t FROM (
        SELECT i, list_reduce(range(8), lambda v, k: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, i) AS v
        FROM (SELECT unnest(range(256)) AS i)
    )
), texts AS (
    SELECT 'd' AS kind, row_number() OVER () AS n, doc_id, text FROM documents
    UNION ALL SELECT 'b', NULL, NULL, text FROM benchmark
), listed AS (
    SELECT kind, n, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM texts
), features AS (
    SELECT kind, n, unnest(words) AS word FROM listed
), hashed AS (
    SELECT word, xor(list_reduce(
        list_transform(range(octet_length(encode(word))), lambda k: ('0x' || hex(encode(word))[2 * k + 1 : 2 * k + 2])::BIGINT),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 10000 AS bucket
    FROM (SELECT DISTINCT word FROM features), crc
), counted AS (
    SELECT bucket, count(*) FILTER (kind = 'd') AS s, count(*) FILTER (kind = 'b') AS t
    FROM features JOIN hashed USING (word) GROUP BY bucket
), totals AS (
    SELECT coalesce(sum(s), 0)::DOUBLE AS s_all, coalesce(sum(t), 0)::DOUBLE AS t_all FROM counted
), gained AS (
    SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (s_all + 10000) / ((s + 1)::DOUBLE * (t_all + 10000)))) AS gain
    FROM counted, totals
), weights AS (
    SELECT n, floor(sum(gain) / count(*))::BIGINT AS weight
    FROM features JOIN hashed USING (word) JOIN gained USING (bucket) WHERE kind = 'd' GROUP BY n
), scored AS (
    SELECT doc_id, len(words) AS n_features, coalesce(weight, 0) AS weight,
           coalesce(weight, 0) + floor(-1000 * ln(-ln((h + 0.5) / 4294967296.0)))::BIGINT AS score
    FROM (
        SELECT n, doc_id, words, ('0x' || sha256('2024:' || coalesce(doc_id::VARCHAR, ''))[1:8])::BIGINT::DOUBLE AS h
        FROM listed WHERE kind = 'd'
    ) LEFT JOIN weights USING (n)
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
           count(*) FILTER (n_features >= 20) OVER () * 10 // 100 AS drawn
    FROM scored
)
SELECT doc_id, n_features, weight, score,
       CASE WHEN n_features >= 20 AND place <= drawn THEN place END AS rank
FROM placed
"""
