"""Scores of texts under a word model of deleted interpolation.

The probability of a token is a mixture of maximum-likelihood estimates after
its one, two, ... preceding tokens, without context, and of a uniform share for
what was never seen. The mixture weights depend on how often the longest seen
context occurred: one bucket for each power of two. They are learned by
expectation-maximisation: estimates come from one part of the training texts
(``KEPT``), and the tokens of the other part (``DELETED``) say which estimate
served best in each bucket. Scores then use the counts of both parts.

How the work is dealt:

* A task turns its texts into chunks of about ``chunk_tokens`` tokens of one
  part (held out, kept, deleted). A chunk is a row: the distinct word
  fingerprints, and each token as a number among them. Chunks are written once.
* From a chunk follow its distinct n-grams of each order, sorted, and counted.
  They go, cut at the bounds of hash ranges, to one group for each range. A
  group adds up the counts of all chunks and answers every chunk in the order
  it asked, so no n-gram comes back and a frequent one is sent once per chunk.
* A chunk's row and its answers meet in a group of their own, so a task holds
  one chunk, and works on its tokens in slices of ``slice_tokens``.
* With the answers a chunk knows the counts behind each of its tokens. Deleted
  chunks yield a histogram of (context bucket, estimates in steps of half a bit),
  whose size is bounded by its grid; it is all the driver gets for the fit.

Words are fingerprinted to 64 bits. N-grams keep log2 of the corpus's tokens
and ``SPARE_BITS`` bits, so the chance that a look-up meets a stranger is about
2^-20 whatever the corpus's size. Nothing else is approximate: counts cover all
training texts, and scores use the estimates themselves, not the histogram's.

Results: a null or empty text is its end token alone; a null id is not held out
and trains; repeated rows train and are scored as often as they stand; long
texts are taken whole (a chunk holds at least one text); a corpus without
training texts gives scores of log10(1) for each token; an empty table gives an
empty result; extra columns play no part.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logassay.functions.packing import pack, pack_sorted, unpack, unpack_sorted
from logassay.llm.common import map_batches, ship_package, slices, stored, texts_of
from logassay.llm.word_arrays import SPACED, fingerprints, mix, split_words

ORDER = 3
CHUNK_TOKENS = 1 << 22
SLICE_TOKENS = 1 << 18
GROUP_ENTRIES = 3 << 20
SPARE_BITS = 20
HELD_OUT, KEPT, DELETED = 0, 1, 2
# Fixed values that stand for the places before a text and its end.
BEGIN, END = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
PLACES = np.random.default_rng(20240311).integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)
LEVEL = 64  # context buckets of one level
STEPS = 2  # histogram steps for a factor of two
GRID = 200


# --- chunks ---------------------------------------------------------------


def parted(docs: DataFrame) -> DataFrame:
    """doc_id, text, and the part of the row; crc32 of the id decides."""
    rest = F.crc32(F.col("doc_id").cast("string")) % 5
    part = F.when(rest == 1, HELD_OUT).when(rest == 0, DELETED).otherwise(KEPT)
    return texts_of(docs, "doc_id", "text").withColumn("part", part)


def chunks(docs: DataFrame, chunk_tokens: int) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()

    def row(number: int, part: int, held: list[tuple[pa.Array, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        chunk = (TaskContext.get().partitionId() << 32) | number
        ids = pa.concat_arrays([x[0] for x in held])
        sizes = np.concatenate([x[1] for x in held])
        words, tokens, times = np.unique(
            np.concatenate([x[2] for x in held]), return_inverse=True, return_counts=True
        )
        # Frequent words get small numbers, which pack better.
        order = np.argsort(-times, kind="stable")
        number_of = np.empty(len(words), dtype=np.int64)
        number_of[order] = np.arange(len(words))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([chunk]), pa.array([part], pa.int32()), pa.ListArray.from_arrays([0, len(ids)], ids),
                pa.array([pack(sizes)]), pa.array([words[order].tobytes()]), pa.array([pack(number_of[tokens])]),
                pa.array([len(words)]), pa.array([len(tokens)]), pa.array([len(sizes)]),
            ],
            names=["chunk", "part", "ids", "sizes", "words", "tokens", "n_words", "n_tokens", "n_docs"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {HELD_OUT: [], KEPT: [], DELETED: []}
        tokens = dict.fromkeys(held, 0)
        number = 0
        for batch in batches:
            for piece in slices(batch):
                words = split_words([t.lower() for t in piece.column("text").cast(pa.binary()).to_pylist()], SPACED)
                marks = np.insert(fingerprints(words), words.first[1:], END)
                sizes = words.counts + 1
                doc = np.repeat(np.arange(len(sizes)), sizes)
                part = piece.column("part").to_numpy()
                for p in np.unique(part).tolist():
                    own = part == p
                    held[p].append((piece.column("doc_id").filter(pa.array(own)), sizes[own], marks[own[doc]]))
                    tokens[p] += int(sizes[own].sum())
                    if tokens[p] >= chunk_tokens:
                        yield row(number, p, held[p])
                        held[p], tokens[p], number = [], 0, number + 1
        for p, rest in held.items():
            if rest:
                yield row(number, p, rest)
                number += 1

    schema = (
        f"chunk long, part int, ids array<{kind}>, sizes binary, words binary, tokens binary, "
        "n_words long, n_tokens long, n_docs long"
    )
    return map_batches(docs.select("doc_id", "text", "part"), schema, run)


class Chunk:
    """Tokens of a chunk and the n-grams that end at them."""

    def __init__(self, sizes: bytes, words: bytes, tokens: bytes):
        self.sizes = unpack(sizes).astype(np.int64)
        self.first = np.cumsum(self.sizes) - self.sizes
        self.marks = np.frombuffer(words, dtype=np.uint64)[unpack(tokens).astype(np.int64)]

    def grams(self, order: int, bits: int) -> np.ndarray:
        """A key for the n-gram of ``order`` tokens that ends at each token."""
        if order == 1:
            return self.marks
        total = self.marks * PLACES[0]
        before = self.marks
        for k in range(1, order):
            before = np.concatenate((before[:1], before[:-1]))
            before[self.first] = BEGIN
            total += before * PLACES[k]
        return mix(total) >> np.uint64(64 - bits)


# --- counts ---------------------------------------------------------------


class Ranges:
    """Hash ranges of each order: key widths, and how many ranges share the keys."""

    def __init__(self, order: int, words: int, tokens: int, group_entries: int):
        self.order = order
        self.bits = min(64, max(1, tokens).bit_length() + SPARE_BITS)
        entries = {k: words if k == 1 else tokens for k in range(1, order + 1)}
        self.split = {k: max(0, (n // group_entries).bit_length()) for k, n in entries.items()}

    def width(self, order: int) -> int:
        return 64 if order == 1 else self.bits

    def bounds(self, order: int) -> np.ndarray:
        """First keys of all ranges but the first."""
        shift = self.width(order) - self.split[order]
        return np.arange(1, 1 << self.split[order], dtype=np.uint64) << np.uint64(min(shift, 63))


ASKED = "order int, bucket long, chunk long, part int, keys binary, times binary"
ANSWERED = "chunk long, order int, bucket long, both binary, kept binary, seen_both long, seen_kept long"


def asked(table: DataFrame, ranges: Ranges) -> DataFrame:
    """Each chunk's distinct n-grams with their counts, cut by hash range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                cell = {c: b.column(c)[i].as_py() for c in b.schema.names}
                chunk = Chunk(cell["sizes"], cell["words"], cell["tokens"])
                for order in range(1, ranges.order + 1):
                    keys, times = np.unique(chunk.grams(order, ranges.bits), return_counts=True)
                    cuts = np.searchsorted(keys, ranges.bounds(order)).tolist()
                    edges = [0, *cuts, len(keys)]
                    rows = [(n, s, e) for n, (s, e) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if s < e]
                    counted = cell["part"] != HELD_OUT
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([order] * len(rows), pa.int32()), pa.array([n for n, _, _ in rows], pa.int64()),
                            pa.array([cell["chunk"]] * len(rows)), pa.array([cell["part"]] * len(rows), pa.int32()),
                            pa.array([pack_sorted(keys[s:e]) for _, s, e in rows], pa.binary()),
                            pa.array([pack(times[s:e]) if counted else None for _, s, e in rows], pa.binary()),
                        ],
                        names=["order", "bucket", "chunk", "part", "keys", "times"],
                    )

    return map_batches(table.select("chunk", "part", "sizes", "words", "tokens"), ASKED, run)


def answer(table: pa.Table) -> pa.Table:
    """Adds up one hash range; every chunk gets the totals of its n-grams in its own order."""
    part = table.column("part").to_numpy()
    keys = [unpack_sorted(k.as_py()) for k in table.column("keys")]
    sizes = np.array([len(k) for k in keys])
    inverse = np.unique(np.concatenate(keys), return_inverse=True)[1]
    del keys
    ends = np.cumsum(sizes)
    totals = np.zeros((2, int(inverse.max()) + 1), dtype=np.int64)
    for i, times in enumerate(table.column("times")):
        if part[i] != HELD_OUT:
            # A chunk's n-grams are distinct, so no place is met twice.
            totals[part[i] - 1, inverse[ends[i] - sizes[i] : ends[i]]] += unpack(times.as_py()).astype(np.int64)
    both, kept = totals.sum(axis=0), totals[KEPT - 1]
    own = [inverse[e - n : e] for e, n in zip(ends, sizes, strict=True)]
    once = lambda n: pa.array([n, *[0] * (len(own) - 1)], pa.int64())
    return pa.table(
        {
            "chunk": table.column("chunk"), "order": table.column("order"), "bucket": table.column("bucket"),
            "both": pa.array([pack(both[x]) for x in own], pa.binary()),
            "kept": pa.array([pack(kept[x]) if p == DELETED else None for x, p in zip(own, part, strict=True)], pa.binary()),
            "seen_both": once(np.count_nonzero(both)), "seen_kept": once(np.count_nonzero(kept)),
        }
    )


class Estimates:
    """Per token of some whole texts: counts, context counts and the context's bucket."""

    def __init__(self, count: np.ndarray, first: np.ndarray, tokens: int, texts: int):
        self.count, self.first = count.astype(np.float64), first
        self.context = np.empty_like(self.count)
        self.context[0] = tokens
        self.context[1:, 1:] = self.count[:-1, :-1]
        self.context[1:, first] = texts
        self.bucket = np.full(count.shape[1], LEVEL, dtype=np.int64)
        for order in range(2, len(count) + 1):
            seen = self.context[order - 1] > 0
            self.bucket[seen] = order * LEVEL + np.log2(self.context[order - 1, seen]).astype(np.int64)

    def shares(self) -> np.ndarray:
        """Maximum-likelihood estimates by order, zero after an unseen context."""
        return np.divide(self.count, self.context, out=np.zeros_like(self.count), where=self.context > 0)


def estimates(
    chunk: Chunk, answers: pa.Table, column: str, ranges: Ranges, tokens: int, texts: int, slice_tokens: int
) -> Iterator[Estimates]:
    """The chunk's estimates by slices of about ``slice_tokens`` tokens, at least one text each.

    Only the counts are held for the whole chunk, in as few bytes as they need.
    """
    rows = [answers.column(c).to_pylist() for c in ("order", "bucket", column)]
    count = []
    for order in range(1, ranges.order + 1):
        # A chunk's answers stand in the order it asked: by range, then as sorted.
        own = np.concatenate([unpack(raw) for k, _, raw in sorted(zip(*rows, strict=True)) if k == order])
        own = own.astype(np.min_scalar_type(own.max()))
        count.append(own[np.unique(chunk.grams(order, ranges.bits), return_inverse=True)[1]])
    edges = np.append(chunk.first, len(chunk.marks))
    text = 0
    while text < len(chunk.first):
        end = max(text + 1, int(np.searchsorted(edges, edges[text] + slice_tokens, side="right")) - 1)
        yield Estimates(
            np.stack([c[edges[text] : edges[end]] for c in count]), edges[text:end] - edges[text], tokens, texts
        )
        text = end


def chunk_of(row: pa.Table) -> Chunk:
    return Chunk(*[row.column(c)[0].as_py() for c in ("sizes", "words", "tokens")])


def with_answers(
    table: DataFrame, answers: DataFrame, work: Callable[[pa.Table, pa.Table], pa.Table], schema: str
) -> DataFrame:
    """``work`` on each chunk's row and its answers; one chunk at a time is in a task's memory."""
    return table.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(work, schema)


# --- mixture weights ------------------------------------------------------


def evidence(
    table: DataFrame, answers: DataFrame, ranges: Ranges, tokens: int, texts: int, slice_tokens: int
) -> DataFrame:
    """Histogram of the deleted part's tokens: cell and count."""

    def work(row: pa.Table, answers: pa.Table) -> pa.Table:
        found = []
        for known in estimates(chunk_of(row), answers, "kept", ranges, tokens, texts, slice_tokens):
            code = known.bucket
            for share in known.shares():
                step = np.zeros(len(code), dtype=np.int64)
                step[share > 0] = np.minimum(1 + np.rint(-STEPS * np.log2(share[share > 0])), GRID - 1)
                code = code * GRID + step
            found.append(np.unique(code, return_counts=True))
        cells, times = (np.concatenate(x) for x in zip(*found, strict=True))
        return pa.table({"cell": cells, "n": times})

    found = with_answers(
        table.select("chunk", "sizes", "words", "tokens"), answers.select("chunk", "order", "bucket", "kept"),
        work, "cell long, n long",
    )
    return found.groupBy("cell").agg(F.sum("n").alias("n"))


def mixture(
    bucket: np.ndarray, steps: np.ndarray, n: np.ndarray, order: int, words: int,
    tolerance: float = 1e-7, rounds: int = 1000,
) -> np.ndarray:
    """Weights (uniform, order 1, 2, ...) by bucket, from a histogram, by expectation-maximisation.

    Every allowed weight gets an equal part of one added token, so that none
    vanishes. Buckets of a level without evidence take the weights of the next
    lower bucket that has some, or else of the next higher.
    """
    out = np.zeros(((order + 1) * LEVEL, order + 1))
    for level in range(1, order + 1):
        out[level * LEVEL : (level + 1) * LEVEL, : level + 1] = 1 / (level + 1)
    allowed = (out > 0).astype(float)
    share = np.column_stack([np.full(len(n), 1 / (words + 1)), np.where(steps > 0, 0.5 ** ((steps - 1) / STEPS), 0.0)])
    prior = allowed / allowed.sum(axis=1, keepdims=True).clip(1)
    for _ in range(rounds):
        part = out[bucket] * share
        part *= (n / part.sum(axis=1))[:, None]
        new = prior + np.stack(
            [np.bincount(bucket, weights=part[:, k], minlength=len(out)) for k in range(order + 1)], axis=1
        )
        new /= new.sum(axis=1, keepdims=True).clip(1e-300)
        moved = np.abs(new - out).max()
        out = new
        if moved < tolerance:
            break
    seen = np.bincount(bucket, minlength=len(out)) > 0
    for level in range(1, order + 1):
        own = np.flatnonzero(seen[level * LEVEL : (level + 1) * LEVEL]) + level * LEVEL
        if len(own):
            every = np.arange(level * LEVEL, (level + 1) * LEVEL)
            out[every] = out[own[np.maximum(np.searchsorted(own, every, side="right") - 1, 0)]]
    return out


def fitted(cells: DataFrame, order: int, words: int) -> np.ndarray:
    """The histogram's cells, of which the grid bounds the number, come to the driver."""
    rows = cells.collect()
    code = np.array([r.cell for r in rows], dtype=np.int64)
    n = np.array([r.n for r in rows], dtype=np.float64)
    steps = np.empty((len(code), order), dtype=np.int64)
    for k in reversed(range(order)):
        code, steps[:, k] = np.divmod(code, GRID)
    return mixture(code, steps, n, order, words)


# --- scores ---------------------------------------------------------------


def lm_scores(
    docs: DataFrame, order: int = ORDER, chunk_tokens: int = CHUNK_TOKENS, group_entries: int = GROUP_ENTRIES,
    slice_tokens: int = SLICE_TOKENS,
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score for every row."""
    ship_package(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    table = stored(chunks(parted(docs), chunk_tokens), "lm-chunks")
    size = {
        r.part: r
        for r in table.groupBy("part").agg(F.sum("n_tokens").alias("t"), F.sum("n_words").alias("w"), F.sum("n_docs").alias("d")).collect()
    }
    total = lambda field, *parts: sum(size[p][field] for p in parts if p in size)
    everything = (HELD_OUT, KEPT, DELETED)
    ranges = Ranges(order, total("w", *everything), total("t", *everything), group_entries)
    answers = stored(
        asked(table, ranges).groupBy("order", "bucket").applyInArrow(answer, ANSWERED), "lm-counts"
    )
    seen = answers.where("order = 1").agg(F.sum("seen_both").alias("both"), F.sum("seen_kept").alias("kept")).first()
    known_words, kept_words = seen.both or 0, seen.kept or 0
    cells = evidence(
        table.where(F.col("part") == DELETED), answers.where("kept IS NOT NULL"),
        ranges, total("t", KEPT), total("d", KEPT), slice_tokens,
    )
    weights = fitted(cells, order, kept_words)
    tokens, texts = total("t", KEPT, DELETED), total("d", KEPT, DELETED)

    def work(row: pa.Table, answers: pa.Table) -> pa.Table:
        chunk = chunk_of(row)
        known, base, score = [], [], []
        for found in estimates(chunk, answers, "both", ranges, tokens, texts, slice_tokens):
            mixed = weights[found.bucket, 0] / (known_words + 1)
            for k, share in enumerate(found.shares(), 1):
                mixed += weights[found.bucket, k] * share
            known.append(np.add.reduceat((found.count[0] > 0).astype(np.int64), found.first))
            of_words = np.log10((found.count[0] + 0.5) / (tokens + 0.5 * (known_words + 1)))
            base.append(np.add.reduceat(of_words, found.first))
            score.append(np.add.reduceat(np.log10(mixed), found.first))
        n = len(chunk.sizes)
        return pa.table(
            {
                "doc_id": row.column("ids").combine_chunks().flatten(),
                "held_out": np.full(n, row.column("part")[0].as_py() == HELD_OUT),
                "n_tokens": chunk.sizes, "n_known": np.concatenate(known),
                "train_tokens": np.full(n, tokens, dtype=np.int64),
                "base_score": np.concatenate(base), "score": np.concatenate(score),
            }
        )

    return with_answers(
        table.select("chunk", "part", "ids", "sizes", "words", "tokens"),
        answers.select("chunk", "order", "bucket", "both"), work,
        f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )
