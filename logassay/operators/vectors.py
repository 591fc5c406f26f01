"""The nearest vectors of many queries at once: inverted lists under coarse centroids.

Components become whole numbers, floor(scale * x), and scores are their inner
products, so nothing depends on the order of sums and any engine gets the same
neighbours. Centroids come from a few rounds of k-means whose sums are formed
per task; a row belongs to the list of its nearest centroid. A query looks only
into the lists of its nearest centroids (``probes`` of them).

Rows of a list are packed into blocks of bounded bytes and so are the queries
that look into it; a pair of blocks is one unit of work, a matrix product, of
which each query keeps its best ``top``. Those are merged by a rank filter that
runs ahead of the shuffle. A list that holds a third of all rows is many blocks.

Only the centroids are sent to all tasks, and their bytes are checked
(``CENTROID_BYTES``). Rows whose vector is null, empty, or holds null or
non-finite components take no part; a table with vectors of several lengths is
refused. Ties go to the smaller id; a query is not its own neighbour.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logassay.functions.numeric import ratio
from logassay.sources.scratch import materialize
from logassay.sources.workers import map_arrow, ship_package

CENTROID_BYTES = 64 << 20
ROW_BYTES = 4 << 20
QUERY_BYTES = 1 << 20
STRIP = 256
EXACT = float(1 << 53)


def whole_vectors(df: DataFrame, vec_id: str, vector: str, scale: int) -> DataFrame:
    """id, size and vec (whole numbers as bytes of doubles) of the usable rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for v in b.column("vector"):
                x = v.values if v.is_valid else None
                if x is None or not len(x) or x.null_count:
                    out.append(None)
                    continue
                y = np.floor(x.to_numpy(zero_copy_only=False).astype(np.float64) * scale) + 0.0
                out.append(y.tobytes() if np.isfinite(y).all() else None)
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(out, pa.binary())], names=["id", "vec"])

    rows = df.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).alias("vector"))
    found = map_arrow(rows, "id long, vec binary", run).where("id IS NOT NULL AND vec IS NOT NULL")
    return found.select("id", F.expr("length(vec) div 8").cast("int").alias("size"), "vec")


def stacked(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    cells = column.to_pylist()
    return np.frombuffer(b"".join(cells), dtype=np.float64).reshape(len(cells), -1)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers; an error where doubles would not be exact."""
    if np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * a.shape[1] >= EXACT:
        raise OverflowError("inner products need more than 53 bits; choose a smaller scale")
    return a @ b.T


class Centroids:
    """Centroids of one vector length, of checked size; nearest first, ties to the smaller number."""

    def __init__(self, vectors: np.ndarray):
        if vectors.nbytes > CENTROID_BYTES:
            raise ValueError(f"centroids of {vectors.nbytes} bytes are too large to send to every task; use fewer lists")
        self.vectors = vectors

    def order(self, x: np.ndarray, first: int) -> np.ndarray:
        own = np.einsum("ij,ij->i", self.vectors, self.vectors)
        distance = own - 2 * products(x, self.vectors)
        return np.argsort(distance, axis=1, kind="stable")[:, :first]

    def nearest(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([self.order(x[s : s + STRIP], 1)[:, 0] for s in range(0, len(x), STRIP)])


def first_centroids(rows: DataFrame, lists: int) -> np.ndarray:
    """The vectors of the ``lists`` rows that come first by a hash of their id."""
    chosen = rows.orderBy(F.md5(F.col("id").cast("string")), "id").limit(lists).select("vec").collect()
    return np.stack([np.frombuffer(r.vec, dtype=np.float64) for r in chosen])


def moved(rows: DataFrame, centroids: Centroids) -> np.ndarray:
    """Each list's mean, rounded down; a list without rows keeps its centroid."""
    shape = centroids.vectors.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = np.zeros(shape[0], dtype=np.int64), np.zeros(shape)
        for b in batches:
            x = stacked(b.column("vec"))
            if len(x):
                own = centroids.nearest(x)
                n += np.bincount(own, minlength=shape[0])
                np.add.at(total, own, x)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at), pa.array(n[at]), pa.array([total[i].tobytes() for i in at], pa.binary())],
            names=["list", "n", "total"],
        )

    def folded(table: pa.Table) -> pa.Table:
        total = stacked(table.column("total")).sum(axis=0)
        n = sum(table.column("n").to_pylist())
        return pa.table({"list": table.column("list")[:1], "mean": pa.array([np.floor(total / n).tobytes()], pa.binary())})

    partial = map_arrow(rows.select("vec"), "list long, n long, total binary", sums)
    out = centroids.vectors.copy()
    for r in partial.groupBy("list").applyInArrow(folded, "list long, mean binary").collect():
        out[r.list] = np.frombuffer(r.mean, dtype=np.float64)
    return out


def trained(rows: DataFrame, lists: int, rounds: int) -> Centroids:
    centroids = Centroids(first_centroids(rows, lists))
    for _ in range(rounds):
        centroids = Centroids(moved(rows, centroids))
    return centroids


def looked_up(rows: DataFrame, centroids: Centroids, probes: int) -> DataFrame:
    """id, vec, list, probe: each row with its ``probes`` nearest lists, probe 1 the nearest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in range(0, b.num_rows, STRIP):
                part = b.slice(s, STRIP)
                order = centroids.order(stacked(part.column("vec")), probes)
                at = np.repeat(np.arange(len(order)), order.shape[1])
                probe = np.tile(np.arange(1, order.shape[1] + 1, dtype=np.int64), len(order))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id").take(pa.array(at)), part.column("vec").take(pa.array(at)),
                     pa.array(order.ravel().astype(np.int64)), pa.array(probe)],
                    names=["id", "vec", "list", "probe"],
                )

    return map_arrow(rows.select("id", "vec"), "id long, vec binary, list long, probe long", run)


def _packed(rows: DataFrame, limit: int, name: str, *columns: str) -> DataFrame:
    """Rows of a list in blocks of about ``limit`` bytes, as one array each."""
    sizes = rows.groupBy("list").agg(F.ceil(F.sum(F.length("vec")) / limit).alias("_blocks"))
    block = F.pmod(F.xxhash64("id"), F.col("_blocks")).alias("_block")
    return (
        rows.join(sizes, "list")
        .groupBy("list", block)
        .agg(F.collect_list(F.struct("id", "vec", *columns)).alias(name))
        .drop("_block")
    )


def _best(scores: np.ndarray, ids: np.ndarray, own: np.ndarray, top: int) -> Iterator[tuple[int, np.ndarray]]:
    """Per query row the places of its ``top`` best, ties to the smaller id; ``ids`` ascend."""
    for i, line in enumerate(scores):
        at = np.flatnonzero(ids != own[i])
        if len(at) > top:
            least = np.partition(line[at], len(at) - top)[len(at) - top]
            at = at[line[at] >= least]
            at = at[np.argsort(-line[at], kind="stable")[:top]]
        yield i, at


def candidates(queries: DataFrame, lists: DataFrame, top: int) -> DataFrame:
    """query_id, probe, id, score: the best ``top`` of each block a query meets.

    ``queries`` and ``lists`` hold id, vec, list (and queries their probe).
    """
    met = _packed(queries, QUERY_BYTES, "asking", "probe").join(_packed(lists, ROW_BYTES, "held"), "list")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for asking, held in zip(b.column("asking"), b.column("held"), strict=True):
                a, h = asking.values, held.values
                own, probe, x = a.field("id").to_numpy(), a.field("probe").to_numpy(), stacked(a.field("vec"))
                ids = h.field("id").to_numpy()
                order = np.argsort(ids, kind="stable")
                ids, y = ids[order], stacked(h.field("vec"))[order]
                out: list[list[np.ndarray]] = [[], [], [], []]
                for s in range(0, len(x), STRIP):
                    scores = products(x[s : s + STRIP], y)
                    for i, at in _best(scores, ids, own[s : s + STRIP], top):
                        for column, values in zip(
                            out, (np.full(len(at), own[s + i]), np.full(len(at), probe[s + i]), ids[at], scores[i, at]),
                            strict=True,
                        ):
                            column.append(values.astype(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c) if c else np.zeros(0, np.int64)) for c in out],
                    names=["query_id", "probe", "id", "score"],
                )

    return map_arrow(met.select("asking", "held"), "query_id long, probe long, id long, score long", run)


def ranked(found: DataFrame, top: int, *keys: str) -> DataFrame:
    place = Window.partitionBy(*keys, "query_id").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(place).cast("bigint")).where(F.col("rank") <= top)


class Index:
    """Inverted lists of a table; ``lists`` defaults to the square root of its rows."""

    def __init__(self, rows: DataFrame, lists: int | None = None, rounds: int = 3):
        ship_package(rows.sparkSession)
        self.rows = rows
        self.count = rows.count()
        self.lists = lists or math.ceil(math.sqrt(self.count))
        if self.count:
            self.centroids = trained(rows, self.lists, rounds)
            self.table = materialize(looked_up(rows, self.centroids, 1).drop("probe"), "lists")

    def probes(self, queries: DataFrame, most: int) -> DataFrame:
        return looked_up(queries, self.centroids, most)

    def exact(self, queries: DataFrame, top: int) -> DataFrame:
        """query_id, id, score, rank against all rows, block by block."""
        one = F.lit(0).cast("long")
        found = candidates(
            queries.select("id", "vec", one.alias("list"), one.alias("probe")),
            self.rows.select("id", "vec", one.alias("list")), top,
        )
        return ranked(found, top).select("query_id", "id", "score", "rank")


def _one_length(df: DataFrame, vec_id: str, vector: str, scale: int) -> DataFrame:
    rows = materialize(whole_vectors(df, vec_id, vector, scale), "vectors")
    sizes = rows.agg(F.min("size").alias("least"), F.max("size").alias("most")).first()
    if sizes.least != sizes.most:
        raise ValueError(f"vectors of {sizes.least} to {sizes.most} components cannot be compared")
    return rows.select("id", "vec")


def top_k(
    df: DataFrame, vec_id: str, vector: str, every: int, top: int, probes: int, scale: int = 256, rounds: int = 3
) -> DataFrame:
    """query_id, rank, id, score: neighbours of the rows whose id ``every`` divides, from ``probes`` lists."""
    rows = _one_length(df, vec_id, vector, scale)
    index = Index(rows, rounds=rounds)
    queries = rows.where(F.col("id") % every == 0)
    if not index.count:
        return df.sparkSession.createDataFrame([], "query_id long, rank long, id long, score long")
    found = candidates(index.probes(queries, probes), index.table, top)
    return ranked(found, top).select("query_id", "rank", "id", "score")


def recall_curve(
    df: DataFrame, vec_id: str, vector: str, every: int, top: int, probes: Sequence[int], scale: int = 256,
    rounds: int = 3,
) -> DataFrame:
    """One row per number of probes: queries with neighbours, their neighbours, how many were found, recall,
    and the rows compared as a share of all (query, row) pairs.

    Truth is the comparison of the same queries with all rows.
    """
    rows = _one_length(df, vec_id, vector, scale)
    index = Index(rows, rounds=rounds)
    queries = rows.where(F.col("id") % every == 0)
    spark = df.sparkSession
    if not index.count:
        return spark.createDataFrame([], "probes long, queries long, neighbours long, found long, recall double, compared double")
    asked = materialize(index.probes(queries, max(probes)), "probes")
    truth = materialize(index.exact(queries, top).select("query_id", "id"), "truth")
    within = F.explode(F.filter(F.array(*[F.lit(p).cast("long") for p in probes]), lambda p: p >= F.col("probe")))
    found = ranked(candidates(asked, index.table, top).withColumn("probes", within), top, "probes")
    # At most ``top`` rows of each query on either side.
    hits = found.join(truth, ["query_id", "id"]).groupBy("probes").agg(F.count(F.lit(1)).alias("found"))
    sizes = index.table.groupBy("list").agg(F.count(F.lit(1)).alias("_rows"))
    cost = asked.withColumn("probes", within).join(sizes, "list").groupBy("probes").agg(F.sum("_rows").alias("_rows"))
    totals = truth.agg(F.count_distinct("query_id").alias("queries"), F.count(F.lit(1)).alias("neighbours")).first()
    found_of = F.coalesce("found", F.lit(0))
    grid = spark.createDataFrame([(p,) for p in probes], "probes long")
    return (
        grid.join(hits, "probes", "left")
        .join(cost, "probes", "left")
        .select(
            "probes",
            F.lit(totals.queries).cast("long").alias("queries"),
            F.lit(totals.neighbours).cast("long").alias("neighbours"),
            found_of.alias("found"),
            F.round(ratio(found_of, F.lit(totals.neighbours)), 6).alias("recall"),
            F.round(ratio(F.coalesce("_rows", F.lit(0)), F.lit(totals.queries * index.count)), 6).alias("compared"),
        )
    )
