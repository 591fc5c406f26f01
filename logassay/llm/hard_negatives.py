"""Hard negatives by a secondary sort of packed (anchor, score, id) keys.

Rows are dealt into chunks; a chunk is a partition that holds its rows, while the
anchors pass by in strips: those of its labels when positives are sought, all for
negatives. So rows move twice whatever the number of anchors, anchors (one row in
a hundred) move to every chunk, and there are as many tasks as chunks. Scores are
inner products of the floored components, which travel as 16-bit integers where
they fit. They are exact: single precision while no sum can reach 2^24, doubles
below 2^53 and 64-bit integers beyond.

Pairs travel as keys of one byte string: anchor, score in descending order, a
mark that puts positives before negatives of the same score, id. They are dealt
by anchor with ``repartitionAndSortWithinPartitions``; an iterator then reads
each anchor's keys in order. A positive opens a window, the negatives that
follow fall into every open window that reaches down to their score, and a
window closes when it is full or the scores have left it. An iterator holds at
most the open windows of one anchor.

The sort runs twice. The first finds each anchor's positives, from the best
``positives`` same-label rows of every chunk. With their scores known, a chunk
passes on only those negatives that are among the first ``negatives`` of the
chunk for some positive: a row left out has that many before it in the same
window, so nothing is lost, and a chunk sends a bounded number of keys for an
anchor however many rows share a label or a vector.

Results: rows with a null label, a null or empty vector, or a null or non-finite
component take no part; vectors of different lengths are not compared; repeated
rows are rows of their own (an anchor's copies are other rows, and each copy of
an anchor is an anchor); a null id is no anchor and comes last among ties; an
empty table gives an empty result; extra columns play no part. Scores beyond 64
bits raise an error.
"""

from __future__ import annotations

import functools
import itertools
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logassay.llm.common import map_batches, ship_package, stored

ANCHOR_BYTES = 128 << 10
ROW_BYTES = 32 << 20
SPAN = 512
FIRST = 64
SLICE = 1 << 20
PENDING = 2048
PER_TASK = 50_000
NARROW = (1 << 15) - 1
SINGLE = float(1 << 24)
EXACT = float(1 << 53)
LONGEST = float(1 << 63)
EDGES = {np.float32: 1 << 24, np.float64: 1 << 53}
NO_ID = (1 << 63) - 1
LOWEST = -(1 << 63)
KEY = struct.Struct(">QQBQQ")
KEYS = np.dtype([("anchor", ">u8"), ("score", ">u8"), ("negative", "u1"), ("vec_id", ">u8"), ("row", ">u8")])
FLIP = 1 << 63
POSITIVES = "anchor long, place int, vec_id long, score long"
FOUND = "anchor long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def pack(anchor: int, score: int, negative: bool, vec_id: int, row: int) -> bytes:
    """A key whose bytes sort as (anchor, score descending, positives first, id)."""
    return KEY.pack(anchor, FLIP - 1 - score, negative, vec_id + FLIP, row)


def unpack(key: bytes) -> tuple[int, int, bool, int, int]:
    anchor, score, negative, vec_id, row = KEY.unpack(key)
    return anchor, FLIP - 1 - score, bool(negative), vec_id - FLIP, row


def grouped(keys: Iterator[tuple[bytes, None]]) -> Iterator[tuple[int, Iterator[tuple[int, bool, int, int]]]]:
    """Anchors of sorted keys with an iterator over each one's (score, negative, id, row)."""
    held = next(keys, None)
    while held is not None:
        anchor = unpack(held[0])[0]

        def own(anchor: int = anchor) -> Iterator[tuple[int, bool, int, int]]:
            nonlocal held
            while held is not None:
                at, *rest = unpack(held[0])
                if at != anchor:
                    return
                held = next(keys, None)
                yield tuple(rest)

        rows = own()
        yield anchor, rows
        for _ in rows:  # what the reader left
            pass


def first_positives(keys: Iterator[tuple[bytes, None]], positives: int) -> Iterator[tuple[int, int, int, int]]:
    """(anchor, place, id, score) of each anchor's best same-label rows."""
    for anchor, rows in grouped(keys):
        for place, (score, _, vec_id, _) in enumerate(rows):
            if place == positives:
                break
            yield anchor, place, vec_id, score


def windows(
    keys: Iterator[tuple[bytes, None]], negatives: int, low: int, high: int
) -> Iterator[tuple[int, int, int, int, int, int]]:
    """(anchor, positive id, rank, negative id, positive score, negative score) from sorted keys."""
    for anchor, rows in grouped(keys):
        opened: list[list[int]] = []  # positive id, its score, negatives given so far
        for score, negative, vec_id, _ in rows:
            if not negative:
                opened.append([vec_id, score, 0])
                continue
            opened = [w for w in opened if w[2] < negatives and low * w[1] <= high * score]
            for w in opened:
                w[2] += 1
                yield anchor, w[0], w[2], vec_id, w[1], score


def whole(column: pa.ListArray, scale: int) -> tuple[pa.Array, pa.Array]:
    """floor(scale * x) of usable vectors as bytes, of 16-bit integers or else of doubles, and which are doubles."""
    offsets = column.offsets.to_numpy().astype(np.int64)
    values = column.values.slice(offsets[0], offsets[-1] - offsets[0])
    offsets -= offsets[0]
    sizes = np.diff(offsets)
    with np.errstate(over="ignore", invalid="ignore"):
        y = np.floor(values.to_numpy(zero_copy_only=False).astype(np.float64) * scale)

    def having(mask: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(mask)))
        return sums[offsets[1:]] > sums[offsets[:-1]]

    usable = column.is_valid().to_numpy(zero_copy_only=False) & (sizes > 0) & ~having(~np.isfinite(y))
    wide = usable & having(np.abs(y) > NARROW)
    if wide.any():
        vec = pa.array(
            [
                (y[s:e] + 0.0 if w else y[s:e].astype(np.int16)).tobytes() if u else None
                for s, e, u, w in zip(offsets[:-1], offsets[1:], usable, wide, strict=True)
            ],
            pa.binary(),
        )
    else:
        ends = np.concatenate(([0], np.cumsum(np.where(usable, 2 * sizes, 0)))).astype(np.int32)
        held = y[np.repeat(usable, sizes)].astype(np.int16)
        vec = pa.Array.from_buffers(
            pa.binary(), len(usable), [pa.array(usable).buffers()[1], pa.py_buffer(ends), pa.py_buffer(held)]
        )
    return vec, pa.array(wide)


def prepared(vectors: DataFrame, scale: int, shift_every: int, labels: int) -> DataFrame:
    """row, vec_id, label, vec (whole numbers as bytes) and wide (as doubles) of the rows that take part."""
    df = vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), "embedding")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = max(1, len(batch.column("embedding").values)) if batch.num_rows else 1
            step = max(1, SLICE * batch.num_rows // cells)
            for b in (batch.slice(s, step) for s in range(0, batch.num_rows, step)):
                yield pa.RecordBatch.from_arrays(
                    [b.column("vec_id"), b.column("label"), *whole(b.column("embedding"), scale)],
                    names=["vec_id", "label", "vec", "wide"],
                )

    shifted = F.when(F.col("vec_id") % shift_every == 0, F.pmod(F.col("label") + 1, F.lit(labels))).otherwise(F.col("label"))
    told = map_batches(df, "vec_id long, label long, vec binary, wide boolean", run)
    told = told.where("vec IS NOT NULL AND label IS NOT NULL")
    return told.select(F.monotonically_increasing_id().alias("row"), "vec_id", shifted.alias("label"), "vec", "wide")


@functools.cache
def warmed() -> None:
    """Maps all of the library's buffer; else products of this shape reach past its mapped part, at 1.7 times the time."""
    x = np.ones((512, 512), np.float32)
    x @ x


def products(
    anchors: np.ndarray, rows: np.ndarray, bound: float | None = None, room: np.ndarray | None = None
) -> np.ndarray:
    """Inner products, exact: whole numbers in single or double precision, or 64-bit integers.

    ``bound`` is at least the sum of the absolute terms of any of them, so no sum on
    the way to one is larger. ``room`` is used again for those in single precision.
    """
    if bound is None:
        bound = np.abs(anchors).max(initial=0) * np.abs(rows).max(initial=0) * anchors.shape[1]
    if bound < SINGLE and anchors.dtype == rows.dtype == np.float32:
        shape = len(anchors), len(rows)
        return np.matmul(anchors, rows.T, out=None if room is None else room[: shape[0] * shape[1]].reshape(shape))
    anchors, rows = anchors.astype(np.float64, copy=False), rows.astype(np.float64, copy=False)
    if bound < EXACT:
        return anchors @ rows.T
    if bound < LONGEST:
        return anchors.astype(np.int64) @ rows.astype(np.int64).T
    exact = anchors.astype(object) @ rows.astype(object).T
    if any(abs(x) >= 1 << 63 for x in exact.ravel()):
        raise OverflowError("an inner product does not fit 64 bits")
    return np.array([[int(x) for x in line] for line in exact], dtype=np.int64).reshape(exact.shape)


class Part:
    """Vectors of one length and width in the order of their ids: row numbers, ids, labels, vectors."""

    def __init__(self, row: np.ndarray, vec_id: np.ndarray, label: np.ndarray, vec: np.ndarray, goals: np.ndarray | None):
        self.row, self.vec_id, self.label, self.vec, self.goals = row, vec_id, label, vec, goals
        self.most, self.norm = 0.0, 0.0
        for s in range(0, len(vec), SPAN):
            x = vec[s : s + SPAN].astype(np.float64)
            self.most = max(self.most, float(np.abs(x).max(initial=0)))
            self.norm = max(self.norm, float(np.sqrt(np.einsum("ij,ij->i", x, x).max(initial=0))))
        self.by_label = np.argsort(label, kind="stable")
        self.names, starts = np.unique(label[self.by_label], return_index=True)
        self.starts = np.append(starts, len(label))

    def of(self, label: int) -> np.ndarray:
        """Places of the rows with a label, in order."""
        k = int(np.searchsorted(self.names, label))
        if k == len(self.names) or self.names[k] != label:
            return self.by_label[:0]
        return self.by_label[self.starts[k] : self.starts[k + 1]]

    def bound(self, other: Part) -> float:
        """At least the sum of the absolute terms of any product with a row of the other."""
        by_norm = self.norm * other.norm * (1 + 1e-6)
        return min(self.most * other.most * self.vec.shape[1], by_norm)


def parts(batches: list[pa.RecordBatch]) -> dict[tuple[int, bool], Part]:
    """Rows of batches by the length and width of their vectors."""
    found: dict[tuple[int, bool], list] = {}
    while batches:
        b = batches.pop(0)
        row, label = (b.column(c).to_numpy() for c in ("row", "label"))
        vec_id = b.column("vec_id").fill_null(NO_ID).to_numpy()
        vec, goals = b.column("vec").cast(pa.binary()), None
        if "goals" in b.schema.names:
            goals = np.empty(len(row), dtype=object)
            goals[:] = b.column("goals").to_pylist()
        offsets = np.frombuffer(vec.buffers()[1], np.int32)[vec.offset : vec.offset + len(vec) + 1].astype(np.int64)
        data = np.frombuffer(vec.buffers()[2], np.uint8)
        wide = b.column("wide").to_numpy(zero_copy_only=False)
        sizes = np.diff(offsets)
        for size, w in sorted({(int(s), bool(w)) for s, w in zip(*np.unique([sizes, wide], axis=1), strict=True)}):
            at = np.flatnonzero((sizes == size) & (wide == w))
            if len(at) == len(row):
                cells = data[offsets[0] : offsets[-1]].reshape(len(at), size)
            else:
                cells = data[offsets[at][:, None] + np.arange(size)]
            cells = np.ascontiguousarray(cells).view(np.float64 if w else np.int16)
            found.setdefault((cells.shape[1], w), []).append(
                (row[at], vec_id[at], label[at], cells, None if goals is None else goals[at])
            )
    out = {}
    for (size, w), pieces in found.items():
        vec, at = np.empty((sum(len(p[0]) for p in pieces), size), np.float64 if w else np.float32), 0
        for p in pieces:
            vec[at : at + len(p[3])] = p[3]
            at += len(p[3])
        row, vec_id, label = (np.concatenate([p[k] for p in pieces]) for k in range(3))
        out[size, w] = Part(row, vec_id, label, vec, None if goals is None else np.concatenate([p[4] for p in pieces]))
    return out


class Kept:
    """Rows met so far that an anchor of a strip may need: line of the strip, score, place of the row.

    ``least`` and ``most`` tell which scores of later rows are needed: more than the
    one, up to the other. Rows are met in the order of their ids, so a later row
    needs a higher score to come before.
    """

    def __init__(self, least: np.ndarray, most: np.ndarray):
        self.least, self.most = least, most
        self.held = tuple(np.empty(0, np.int64) for _ in range(3))
        self.new: list[tuple] = []
        self.waiting = 0

    def add(self, line: np.ndarray, score: np.ndarray, place: np.ndarray) -> None:
        self.new.append((line, score, place))
        self.waiting += len(line)
        if self.waiting > max(PENDING, len(self.held[0])):
            self.settle()

    def settle(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Only what is needed of the rows so far, by line, score in descending order, and place."""
        if self.new:
            line, score, place = (np.concatenate(x) for x in zip(self.held, *self.new, strict=True))
            order = np.lexsort((place, -score, line))
            line, score, place = line[order], score[order], place[order]
            keep = self.needed(line, score, np.searchsorted(line, line))
            self.held, self.new, self.waiting = (line[keep], score[keep], place[keep]), [], 0
        return self.held


class Best(Kept):
    """The first ``count`` rows of every line."""

    def __init__(self, lines: int, count: int):
        super().__init__(np.full(lines, LOWEST), np.full(lines, NO_ID))
        self.count = count

    def needed(self, line: np.ndarray, score: np.ndarray, start: np.ndarray) -> np.ndarray:
        rank = np.arange(len(line)) - start
        last = rank == self.count - 1
        self.least[line[last]] = score[last]
        return rank < self.count


class Windows(Kept):
    """The first ``count`` rows below each goal of a line, down to the goal's floor."""

    def __init__(self, goals: list[list[tuple[int, int]]], count: int):
        width = max(1, *map(len, goals))
        padded = np.array([g + [(LOWEST, NO_ID)] * (width - len(g)) for g in goals], np.int64).reshape(-1, width, 2)
        self.goals, self.floors = padded[:, :, 0], padded[:, :, 1]
        self.under = np.where(self.floors == NO_ID, NO_ID, np.maximum(self.floors, LOWEST + 1) - 1)
        super().__init__(self.under.min(axis=1), self.goals.max(axis=1))
        self.count = count

    def needed(self, line: np.ndarray, score: np.ndarray, start: np.ndarray) -> np.ndarray:
        keep = np.zeros(len(line), bool)
        for k in range(self.goals.shape[1]):
            inside = (score <= self.goals[line, k]) & (score >= self.floors[line, k])
            sums = np.cumsum(inside)
            rank = sums - (sums - inside)[start]
            keep |= inside & (rank <= self.count)
            last = inside & (rank == self.count)
            self.under[line[last], k] = score[last]
        self.least = self.under.min(axis=1)
        return keep


def sweep(kept: Kept, anchors: np.ndarray, rows: np.ndarray, bound: float, hide=None) -> None:
    """Meets the rows in order; ``hide`` gives (lines, places) of a span that are left out."""
    warmed()
    room, end = np.empty(len(anchors) * SPAN, np.float32), 0
    while end < len(rows):
        s, end = end, min(len(rows), end + min(SPAN, max(FIRST, end)))  # the first rows tell which scores the many later ones need
        scores = products(rows[s:end], anchors, bound, room)
        edge = EDGES.get(scores.dtype.type)
        least = kept.least
        if edge:  # all scores are within the edges, and whole numbers up to them exact
            least = np.clip(least, -edge, edge).astype(scores.dtype)
        for lines, places in hide(s, end) if hide else ():
            scores[np.ix_(places, lines)] = -edge if edge else LOWEST
        near = np.flatnonzero(scores.max(axis=0) > least)
        if 8 * len(near) > len(least):
            near = np.arange(len(least))
        elif len(near):
            scores, least = scores[:, near], least[near]
        if len(near) and len(at := np.flatnonzero(scores > least)):
            place, line = np.divmod(at, len(near))
            score, line = scores.ravel()[at].astype(np.int64), near[line]
            fits = np.flatnonzero(score <= kept.most[line])
            kept.add(line[fits], score[fits], place[fits] + s)


def packed_keys(anchor: np.ndarray, score: np.ndarray, negative: bool, vec_id: np.ndarray, row: np.ndarray) -> bytes:
    """The keys that ``pack`` makes, one after the other."""
    out = np.empty(len(anchor), KEYS)
    out["anchor"], out["negative"], out["row"] = anchor, negative, row
    out["score"] = np.uint64(FLIP - 1) - score.astype(np.uint64)
    out["vec_id"] = vec_id.astype(np.uint64) + np.uint64(FLIP)
    return out.tobytes()


def unpacked(keys: bytes) -> list[bytes]:
    return [bytes(keys[s : s + KEY.size]) for s in range(0, len(keys), KEY.size)]


def strips(n: int, vec: np.ndarray, anchor_bytes: int) -> Iterator[slice]:
    step = max(1, min(SPAN, anchor_bytes // vec[:1].nbytes))
    return (slice(s, s + step) for s in range(0, n, step))


def beside(anchors: dict, rows: dict) -> Iterator[tuple[Part, Part]]:
    """Anchors and rows whose vectors have the same length."""
    for (size, _), own in anchors.items():
        for width in (False, True):
            if (size, width) in rows:
                yield own, rows[size, width]


def best_positives(anchors: dict, rows: dict, positives: int, anchor_bytes: int) -> Iterator[bytes]:
    """Keys of the best same-label rows of a chunk for each anchor."""
    for own, held in beside(anchors, rows):
        bound = own.bound(held)
        for label in own.names:
            at, places = own.of(label), held.of(label)
            if not len(places):
                continue
            vec = held.vec if len(places) == len(held.vec) else held.vec[places]
            for s in strips(len(at), own.vec, anchor_bytes):
                mine = at[s]
                kept = Best(len(mine), positives + 1)  # one more, as an anchor may be among the rows
                sweep(kept, own.vec[mine], vec, bound)
                line, score, place = kept.settle()
                anchor, row, vec_id = own.row[mine[line]], held.row[places[place]], held.vec_id[places[place]]
                other = np.flatnonzero(anchor != row)
                anchor, score, row, vec_id = (x[other] for x in (anchor, score, row, vec_id))
                first = np.flatnonzero(np.arange(len(other)) - np.searchsorted(line[other], line[other]) < positives)
                yield packed_keys(anchor[first], score[first], False, vec_id[first], row[first])


def needed_negatives(
    anchors: dict, rows: dict, negatives: int, low: int, high: int, anchor_bytes: int
) -> Iterator[bytes]:
    """Keys of the rows that come first within the chunk for some positive score of an anchor."""
    for own, held in beside(anchors, rows):
        bound = own.bound(held)
        wanted = [[(g, f) for g in goals or () if (f := max(-(-low * g // high), LOWEST + 1)) <= g] for goals in own.goals]
        same = {int(label): held.of(label) for label in own.names}
        meets = np.array([len(same[int(label)]) < len(held.row) for label in own.label])
        # Without a goal a product only has to be seen to fit 64 bits.
        at = np.flatnonzero(meets & (np.array([bool(w) for w in wanted]) | (bound >= LONGEST)))
        for s in strips(len(at), own.vec, anchor_bytes):
            mine = at[s]
            labels = own.label[mine]
            apart = [(np.flatnonzero(labels == x), same[int(x)]) for x in np.unique(labels) if len(same[int(x)])]

            def hide(start: int, end: int, apart: list = apart) -> Iterator[tuple[np.ndarray, np.ndarray]]:
                for lines, places in apart:
                    a, b = np.searchsorted(places, (start, end))
                    if a < b:
                        yield lines, places[a:b] - start

            kept = Windows([wanted[i] for i in mine], negatives)
            sweep(kept, own.vec[mine], held.vec, bound, hide)
            line, score, place = kept.settle()
            yield packed_keys(own.row[mine[line]], score, True, held.vec_id[place], held.row[place])


def sorted_keys(told: DataFrame, also: RDD | None, partitions: int) -> RDD:
    """Keys dealt by their anchor and sorted within partitions."""
    keys = told.rdd.flatMap(lambda r: unpacked(r.keys))
    if also is not None:
        keys = keys.union(also)
    return keys.map(lambda k: (k, None)).repartitionAndSortWithinPartitions(
        partitions, partitionFunc=lambda k: zlib.crc32(k[:8])
    )


class Chunks:
    """Rows in chunks of at most about ``size`` bytes that hold few labels each.

    Labels are dealt into buckets by a hash, and a bucket of more than ``size`` bytes
    has several chunks. Small tables get more chunks than that takes, as far as
    there are cores.
    """

    def __init__(self, rows: DataFrame, size: int):
        cores = rows.sparkSession.sparkContext.defaultParallelism
        total = rows.agg(F.sum(F.length("vec"))).first()[0] or 0
        n = max(1, -(-total // size), min(4 * cores, -(-8 * total // size)))
        bucket = F.pmod(F.xxhash64("label"), F.lit(n)).cast("int")
        weights = dict(rows.groupBy(bucket).agg(F.sum(F.length("vec"))).collect())
        counts = [-(-weights.get(b, 0) * n // max(1, total)) for b in range(n)]
        ends = list(itertools.accumulate(counts))
        self.n = max(1, ends[-1])
        count = F.get(F.lit(counts), bucket)
        self.first = F.get(F.lit([0, *ends[:-1]]), bucket)
        self.own = (self.first + F.pmod(F.xxhash64("row"), count)).cast("int")
        self.last = self.first + count - 1

    def beside(self, rows: DataFrame, anchors: DataFrame, first: Column, last: Column) -> DataFrame:
        """A partition for each chunk: its rows in the order of their ids, then anchors from ``first`` to ``last``."""
        names = ["row", "vec_id", "label", "vec", "wide"]
        held = rows.select(self.own.alias("chunk"), F.lit(False).alias("asks"), *names, F.lit(None).cast("array<long>").alias("goals"))
        asked = anchors.select(
            F.explode(F.sequence(first, last)).alias("chunk"), F.lit(True).alias("asks"), *names, "goals"
        )
        return held.union(asked).repartitionById(self.n, "chunk").sortWithinPartitions(
            "asks", F.when(F.col("asks"), F.col("label")), F.col("vec_id").asc_nulls_last(), "row"
        )


def met(beside: DataFrame, work: Callable[[dict, dict], Iterator[bytes]]) -> DataFrame:
    """Keys that ``work`` finds for the anchors of a chunk, a batch at a time, and its rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        rows: dict | None = None
        for b in batches:
            cut = b.num_rows - (b.column("asks").true_count)
            if cut:
                waiting.append(b.slice(0, cut).select(["row", "vec_id", "label", "vec", "wide"]))
            if cut < b.num_rows:
                rows = parts(waiting) if rows is None else rows
                for keys in work(parts([b.slice(cut)]), rows):
                    yield pa.RecordBatch.from_arrays([pa.array([keys], pa.binary())], names=["keys"])

    return map_batches(beside.drop("chunk"), "keys binary", run)


def hard_negatives(
    vectors: DataFrame, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100,
    scale: int = 256, anchor_every: int = 100, shift_every: int = 7, labels: int = 10,
    anchor_bytes: int = ANCHOR_BYTES, row_bytes: int = ROW_BYTES,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score; see above.

    Anchors are the rows whose id ``anchor_every`` divides. Where ``shift_every``
    divides the id, the label is moved on by one among ``labels``. A negative
    belongs to a positive when low * positive <= high * negative <= high * positive.
    """
    spark: SparkSession = vectors.sparkSession
    ship_package(spark)
    rows = stored(prepared(vectors, scale, shift_every, labels), "negative-rows")
    chosen = stored(rows.where(F.col("vec_id") % anchor_every == 0), "negative-anchors")
    chunks = Chunks(rows, row_bytes)
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), chosen.count() * chunks.n // PER_TASK)

    idle = chosen.withColumn("goals", F.lit(None).cast("array<long>"))
    near = chunks.beside(rows, idle, chunks.first, chunks.last)
    same = met(near, lambda own, held: best_positives(own, held, positives, anchor_bytes))
    found = sorted_keys(same, None, partitions).mapPartitions(lambda part: first_positives(part, positives))
    found = stored(spark.createDataFrame(found, POSITIVES, verifySchema=False), "positives")

    goals = found.groupBy(F.col("anchor").alias("row")).agg(F.collect_set("score").alias("goals"))
    far = chunks.beside(rows, chosen.join(goals, "row", "left"), F.lit(0), F.lit(chunks.n - 1))
    other = met(far, lambda own, held: needed_negatives(own, held, negatives, low, high, anchor_bytes))
    opening = found.rdd.map(lambda r: pack(r.anchor, r.score, False, r.vec_id, 0))
    told = sorted_keys(other, opening, partitions).mapPartitions(lambda part: windows(part, negatives, low, high))
    named = lambda c: F.when(F.col(c) != NO_ID, F.col(c)).alias(c)
    return (
        spark.createDataFrame(told, FOUND, verifySchema=False)
        .join(chosen.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id")), "anchor")
        .select(
            "anchor_id", named("positive_id"), "rank", named("negative_id"), "positive_score", "negative_score"
        )
    )


SQL = """
WITH usable AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vec,
           row_number() OVER () AS row
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.row AS anchor, a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
           list_dot_product(a.vec, r.vec)::BIGINT AS score
    FROM usable a JOIN usable r ON a.row <> r.row AND len(a.vec) = len(r.vec)
    WHERE a.vec_id % 100 = 0
), positives AS (
    SELECT * FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.vec_id AS positive_id,
       row_number() OVER (PARTITION BY p.anchor, p.vec_id ORDER BY n.score DESC, n.vec_id)::INTEGER AS rank,
       n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor = p.anchor AND NOT n.same
WHERE 80 * p.score <= 100 * n.score AND n.score <= p.score
QUALIFY row_number() OVER (PARTITION BY p.anchor, p.vec_id ORDER BY n.score DESC, n.vec_id) <= 5
"""
