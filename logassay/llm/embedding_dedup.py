"""Near-duplicate vectors: random hyperplanes in several tables, exact cosine, components.

Equal vectors are one class. A class's signature in a table is the signs of its
products with ``bits`` random hyperplanes; ``bits`` grows with the logarithm of
the classes, so that unrelated vectors keep to buckets of a few rows, and the
number of tables follows from ``bits`` and the wanted recall at the threshold.
Buckets larger than ``block`` are cut into blocks, and pairs of blocks are tasks
of their own, so no bucket is gathered whole.

Block pairs are looked through twice. First with sketches alone, ``SKETCH`` signs
of each vector: a row goes on only if its sketch is near another's, as near as
those of linked vectors are but for one in 10^8. Vectors travel only to the block
pairs where they go on, and there cosines are compared in double precision. A
pair met in several tables counts only in the first; a block pair returns counts
and local component labels, one row per linked class, never its pairs.

Results: vectors that are null, empty, zero, or hold null or non-finite
components link with nothing (n_links 0, a component of their own), and neither
do vectors of different lengths; repeated rows are linked copies; rows with a
null id count as partners but never name a component unless alone; an empty
table gives an empty result; extra columns play no part.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logassay.llm.common import map_batches, stored
from logassay.llm.graph import components

SEED = 20240117
SKETCH = 128
ROWS_PER_TASK = 100_000
BYTES_PER_TASK = 24 << 20


def hyperplanes(size: int, bits: int, tables: int) -> np.ndarray:
    return np.random.default_rng([SEED, size]).standard_normal((size, bits * tables))


def plan_tables(classes: int, threshold: float, recall: float) -> tuple[int, int]:
    """Bits per table, and tables that find a pair at the threshold with the wanted chance."""
    bits = min(40, max(6, round(math.log2(max(classes, 1) / 8 + 1))))
    agree = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - agree))


def sketch_limit(threshold: float, bits: int) -> int:
    """Signs in which the sketches of linked vectors differ at most, six deviations above the mean."""
    p = math.acos(threshold) / math.pi
    return math.ceil(bits * p + 6 * math.sqrt(bits * p * (1 - p)))


def _vectors(column: pa.ListArray) -> list[np.ndarray | None]:
    """Usable vectors as doubles, null for the rest."""
    out: list[np.ndarray | None] = []
    for v in column:
        x = None if not v.is_valid else v.values
        if x is None or not len(x) or x.null_count:
            out.append(None)
            continue
        y = x.to_numpy(zero_copy_only=False).astype(np.float64) + 0.0
        out.append(y if np.isfinite(y).all() and y.any() else None)
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _described(vectors: DataFrame) -> DataFrame:
    kind = vectors.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            usable = [None if x is None else x.tobytes() for x in _vectors(b.column("embedding"))]
            cls = [None if x is None else hashlib.blake2b(x, digest_size=16).digest() for x in usable]
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), pa.array(cls, pa.binary()), pa.array(usable, pa.binary())],
                names=["vec_id", "cls", "vec"],
            )

    return map_batches(
        vectors.select("vec_id", "embedding"), f"vec_id {kind}, cls binary, vec binary", run
    )


def _signed(classes: DataFrame, bits: int, tables: int) -> DataFrame:
    """cls, vec, copies, the bucket in every table, and the first signs as a sketch of two longs."""
    weights = (1 << np.arange(bits, dtype=np.int64)).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for b in batches:
            rows = [np.frombuffer(x, dtype=np.float64) for x in b.column("vec").to_pylist()]
            signs: list[np.ndarray] = []
            sketches = np.zeros((len(rows), SKETCH // 8), dtype=np.uint8)
            for i, x in enumerate(rows):
                p = planes.setdefault(len(x), None)
                if p is None:
                    p = planes[len(x)] = hyperplanes(len(x), bits, tables)
                up = ((x / np.abs(x).max()) @ p) > 0
                signs.append(up.reshape(tables, bits) @ weights)
                first = np.packbits(up[:SKETCH])
                sketches[i, : len(first)] = first
            halves = sketches.view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    *[b.column(c) for c in ("cls", "vec", "copies")], pa.array(signs, pa.list_(pa.int64())),
                    pa.array(np.ascontiguousarray(halves[:, 0])), pa.array(np.ascontiguousarray(halves[:, 1])),
                ],
                names=["cls", "vec", "copies", "signs", "s1", "s2"],
            )

    return map_batches(
        classes.select("cls", "vec", "copies"),
        "cls binary, vec binary, copies long, signs array<long>, s1 long, s2 long", run,
    )


KEY = ("table", "bucket", "i", "j")


def _block_pairs(rows: pa.Table, *more: np.ndarray) -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
    """Each block pair's key, the rows of its first block (all, if it is one block), and its rows in order.

    ``more`` are values that rows must share besides the key.
    """
    keys = np.stack([rows.column(c).to_numpy() for c in KEY], axis=1)
    block = rows.column("block").to_numpy()
    order = np.lexsort((block, *more, *keys.T[::-1]))
    k = np.column_stack([keys, *more])[order]
    edges = np.append(np.flatnonzero(np.append(True, (k[1:] != k[:-1]).any(axis=1))), len(k))
    for s, e in zip(edges[:-1], edges[1:], strict=True):
        at, key = order[s:e], k[s]
        if len(at) > 1:
            yield key, len(at) if key[2] == key[3] else int(np.count_nonzero(block[at] == key[2])), at


def _going_on(rows: pa.Table, limit: int) -> pa.Table:
    """The rows that have a near sketch in their block pair."""
    sketch = np.stack([rows.column(c).to_numpy() for c in ("s1", "s2")], axis=1).view(np.uint64)
    keep = np.zeros(len(sketch), dtype=bool)
    for key, cut, at in _block_pairs(rows):
        left, right = (at, at) if key[2] == key[3] else (at[:cut], at[cut:])
        if not len(right):
            continue
        gap = np.zeros((len(left), len(right)), dtype=np.uint8)
        for half in (0, 1):
            gap += np.bitwise_count(sketch[left, half][:, None] ^ sketch[right, half][None, :])
        near = gap <= limit
        if left is right:
            np.fill_diagonal(near, False)
        keep[left] |= near.any(axis=1)
        keep[right] |= near.any(axis=0)
    return rows.select(["id", *KEY, "block"]).filter(pa.array(keep))


def _labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member of each member's component, for links a-b among n members."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _compared(rows: pa.Table, threshold: float) -> pa.RecordBatch:
    """Counts and local labels of all block pairs in one task's rows."""
    names = ["cls", "links", "root"]
    cls = np.array(rows.column("cls").to_pylist(), dtype=object)
    copies = rows.column("copies").to_numpy()
    raw = rows.column("vec").to_pylist()
    signs = np.array(rows.column("signs").to_pylist(), dtype=np.int64)
    sizes = np.array([len(x) for x in raw])
    out: dict[str, list] = {c: [] for c in names}
    for key, cut, at in _block_pairs(rows, sizes):
        table, i, j = key[0], key[2], key[3]
        unit = _unit(np.stack([np.frombuffer(raw[x], dtype=np.float64) for x in at]))
        near = unit[:cut] @ (unit if i == j else unit[cut:]).T >= threshold
        a, b = np.nonzero(np.triu(near, 1) if i == j else near)
        if i != j:
            b = b + cut
        first = (signs[at[a], :table] != signs[at[b], :table]).all(axis=1)
        a, b = a[first], b[first]
        if not len(a):
            continue
        links = np.bincount(a, weights=copies[at[b]], minlength=len(at))
        links += np.bincount(b, weights=copies[at[a]], minlength=len(at))
        label = _labels(len(at), a, b)
        for x in np.flatnonzero(links):
            out["cls"].append(cls[at[x]])
            out["links"].append(int(links[x]))
            out["root"].append(cls[at[label[x]]])
    return pa.RecordBatch.from_arrays(
        [pa.array(out["cls"], pa.binary()), pa.array(out["links"], pa.int64()), pa.array(out["root"], pa.binary())],
        names=names,
    )


def near_vectors(
    vectors: DataFrame, threshold: float = 0.95, recall: float = 0.9995, block: int = 1024
) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row; see the contract above."""
    spark = vectors.sparkSession
    rows = stored(_described(vectors), "vectors")
    classes = stored(
        rows.where("cls IS NOT NULL")
        .groupBy("cls")
        .agg(F.first("vec").alias("vec"), F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least_id")),
        "vector-classes",
    )
    bits, tables = plan_tables(classes.count(), threshold, recall)
    signed = stored(
        _signed(classes, bits, tables).withColumn("id", F.monotonically_increasing_id()), "signatures"
    )
    entries = signed.select("id", "s1", "s2", F.posexplode("signs").alias("table", "bucket"))
    buckets = (
        entries.groupBy("table", "bucket")
        .agg(F.ceil(F.count(F.lit(1)) / block).cast("long").alias("blocks"), F.count(F.lit(1)).alias("size"))
        .where("size > 1")
        .select("table", "bucket", "blocks")
    )
    placed = (
        entries.join(buckets, ["table", "bucket"])
        .withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .select(
            "id", "s1", "s2", "table", "bucket", "block",
            F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        )
    )
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(least, math.ceil(signed.count() * tables / ROWS_PER_TASK))
    limit = sketch_limit(threshold, min(SKETCH, bits * tables))

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if held:
            yield from _going_on(pa.Table.from_batches(held), limit).to_batches()

    kept = stored(
        map_batches(
            placed.repartition(tasks, *KEY), "id long, table int, bucket long, i long, j long, block long", sift
        ),
        "vector-blocks",
    )
    width = signed.agg(F.max(F.length("vec"))).first()[0] or 0
    tasks = max(least, math.ceil(kept.count() * (width + 8 * tables) / BYTES_PER_TASK))
    joined = kept.join(signed.drop("s1", "s2"), "id").repartition(tasks, *KEY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if held:
            yield _compared(pa.Table.from_batches(held), threshold)

    found = stored(map_batches(joined, "cls binary, links long, root binary", run), "vector-links")
    counts = found.groupBy("cls").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("cls").alias("a"), F.col("root").alias("b")))
    named = (
        classes.select("cls", "copies", "least_id")
        .join(counts, "cls", "left")
        .join(roots.select(F.col("node").alias("cls"), "root"), "cls", "left")
        .withColumn("root", F.coalesce("root", "cls"))
    )
    least = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    told = named.join(least, "root").select(
        "cls", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"
    )
    return (
        rows.select("vec_id", "cls")
        .join(told, "cls", "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
            F.when(F.col("cls").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
        )
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
    )
