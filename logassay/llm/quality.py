"""Document quality by regularised quadratic discriminant analysis.

Each whole text is reduced to the transformed statistics ``FEATURES``. Per class
the mean and covariance come from sums over all labelled rows that are not held
out; covariances are shrunk towards the pooled one and its diagonal. The score
is the logistic of the difference of Gaussian log densities, from Mahalanobis
distances by Cholesky factors that are made once and sent to the tasks.

Labels, language, source and id are never inputs of a score. Rows are held out
when crc32 of the id as text leaves 1 divided by 3.

Results: null and empty texts are scored like any other (all counts zero);
repeated rows are scored alike; label rows that are null, not 0 or 1, or
contradict each other for one id teach nothing; without both classes every
score is the share of label 1 seen, or 0.5; a null id is not held out; an empty
table gives an empty result; extra columns play no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logassay.llm.common import map_batches, map_texts, slices, stored, texts_of
from logassay.llm.word_arrays import SPACED, fingerprints, split_words

FEATURES = (
    "words", "word_length", "distinct", "top_word", "repeated_next", "upper", "digits",
    "symbols", "bars", "shouts", "stops", "lines", "beyond_ascii",
)
LEAST_DEVIATION = 0.05


def _bytes_of(characters: str) -> np.ndarray:
    table = np.zeros(256)
    table[list(characters.encode())] = 1
    return table


BYTE_CLASSES = np.stack(
    [
        _bytes_of("ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
        _bytes_of("0123456789"),
        _bytes_of("#$%&*+/<=>@[]\\^_`{}~"),
        _bytes_of("|"),
        _bytes_of("!?"),
        _bytes_of(".,;:"),
        _bytes_of("\n"),
        np.arange(256) >= 0x80,
    ],
    axis=1,
).astype(float)


def statistics(raw: list[bytes]) -> np.ndarray:
    """One row of ``FEATURES`` for each text: log counts and smoothed log shares."""
    out = np.zeros((len(raw), len(FEATURES)))
    words = split_words(raw, SPACED)
    marks = fingerprints(words)
    for i, text in enumerate(raw):
        m = marks[words.first[i] : words.first[i + 1]]
        n = len(m)
        counts = np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256) @ BYTE_CLASSES
        times = np.unique(m, return_counts=True)[1]
        out[i, 0] = np.log1p(n)
        out[i, 1] = np.log((len(text) + 5) / (n + 1))
        out[i, 2] = np.log((len(times) + 1) / (n + 1))
        out[i, 3] = np.log((times.max(initial=0) + 1) / (n + 10))
        out[i, 4] = np.log((np.count_nonzero(m[1:] == m[:-1]) + 0.5) / (n + 10))
        out[i, 5:] = np.log((counts + 0.5) / (len(text) + 50))
    return out


def features(docs: DataFrame) -> DataFrame:
    """doc_id and the array ``x`` of statistics for every row."""
    df = texts_of(docs, "doc_id", "text")
    kind = df.schema["doc_id"].dataType.simpleString()

    def work(raw: list[bytes], rest: dict) -> dict:
        return {"doc_id": rest["doc_id"], "x": list(statistics(raw))}

    return map_texts(df, f"doc_id {kind}, x array<double>", work)


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


class Discriminant:
    """Class means and Cholesky factors; ``balance`` is the log ratio of class sizes."""

    def __init__(self, moments: dict[int, tuple[float, np.ndarray, np.ndarray]], pooling: float, diagonal: float):
        self.sizes = {c: n for c, (n, _, _) in moments.items() if n}
        self.parts: dict[int, tuple[np.ndarray, np.ndarray, float]] = {}
        if len(self.sizes) < 2:
            return
        total = sum(self.sizes.values())
        spread = {c: q / n - np.outer(s / n, s / n) for c, (n, s, q) in moments.items()}
        pooled = sum(self.sizes[c] * spread[c] for c in spread) / total
        least = np.eye(len(pooled)) * LEAST_DEVIATION**2
        for c, (n, s, _) in moments.items():
            own = (1 - pooling) * spread[c] + pooling * pooled
            own = (1 - diagonal) * own + diagonal * np.diag(np.diag(own)) + least
            factor = np.linalg.cholesky(own)
            self.parts[c] = (s / n, np.linalg.inv(factor), 2 * np.log(np.diag(factor)).sum())

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.parts:
            total = sum(self.sizes.values())
            return np.full(len(x), self.sizes.get(1, 0) / total if total else 0.5)
        density = {
            c: -0.5 * ((((x - mean) @ back.T) ** 2).sum(axis=1) + log_det)
            for c, (mean, back, log_det) in self.parts.items()
        }
        gap = density[1] - density[0] + np.log(self.sizes[1] / self.sizes[0])
        return 1 / (1 + np.exp(-np.clip(gap, -500, 500)))


def class_moments(labelled: DataFrame) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Per class: rows, sums, and sums of products. Two rows reach the driver."""
    k = len(FEATURES)
    x = [F.col("x")[i] for i in range(k)]
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    rows = (
        labelled.groupBy("quality")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.array(*[F.sum(v) for v in x]).alias("s"),
            F.array(*[F.sum(x[i] * x[j]) for i, j in pairs]).alias("q"),
        )
        .collect()
    )
    out = {0: (0, np.zeros(k), np.zeros((k, k))), 1: (0, np.zeros(k), np.zeros((k, k)))}
    for r in rows:
        q = np.zeros((k, k))
        for (i, j), v in zip(pairs, r.q, strict=True):
            q[i, j] = q[j, i] = v
        out[r.quality] = (r.n, np.array(r.s), q)
    return out


def fitted(
    measured: DataFrame, labels: DataFrame, pooling: float = 0.3, diagonal: float = 0.1
) -> Discriminant:
    """The model of all labelled rows of ``measured`` (see ``features``) that are not held out."""
    taught = (
        labels.select(F.col("doc_id").alias("_id"), F.col("quality").try_cast("double").alias("quality"))
        .where(F.col("quality").isin(0.0, 1.0))
        .withColumn("quality", F.col("quality").cast("int"))
        .groupBy("_id")
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("_max"))
        .where(F.col("quality") == F.col("_max"))
    )
    labelled = measured.where(~held_out()).join(taught, F.col("doc_id") == F.col("_id"))
    return Discriminant(class_moments(labelled), pooling, diagonal)


def quality_scores(
    docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **settings
) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of ``docs``."""
    measured = stored(features(docs), "quality")
    model = fitted(measured, labels, **settings)
    kind = measured.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            x = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(model.score(x))], names=["doc_id", "score"]
            )

    scored = map_batches(measured, f"doc_id {kind}, score double", run)
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_good(
    docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **settings
) -> DataFrame:
    """The rows of ``docs``, all columns unchanged, whose text is not rejected.

    Each row is judged by its own text in a second pass, so no text is shuffled
    and rows that share an id or have none are told apart.
    """
    model = fitted(features(docs), labels, **settings)

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                text = pc.fill_null(part.column("text").cast(pa.binary()), b"")
                good = model.score(statistics(text.to_pylist())) >= threshold
                yield part.filter(pa.array(good))

    return map_batches(docs, docs.schema, run)
