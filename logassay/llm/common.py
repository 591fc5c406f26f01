"""Helpers the operators share: column intake, row keys, scratch tables, Arrow loops."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logassay.sources.scratch import materialize

PACKAGE = Path(__file__).resolve().parents[1]
_shipped: set[str] = set()

# Texts are worked on in slices of about this size, so a task's memory does not
# depend on how many rows Spark puts into an Arrow batch.
SLICE_BYTES = 1 << 20


def texts_of(df: DataFrame, *columns: str) -> DataFrame:
    """Only the needed columns, whatever else the table holds; a null text becomes empty."""
    return df.select(*[df[c] for c in columns]).withColumn(
        "text", F.coalesce(F.col("text").cast("string"), F.lit(""))
    )


def packed(docs: DataFrame) -> DataFrame:
    """``doc`` (all columns as a struct), doc_id, text as it is, and the row key.

    Operators that pass rows on work beside the struct, so no column of theirs
    can clash with one of the table.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    return docs.select(
        whole, "doc_id", "text", F.xxhash64("doc_id", F.coalesce("text", F.lit(""))).alias("_k")
    )


def unpacked(columns: list[str], **instead: Column) -> list[Column]:
    """The columns of the struct ``doc``; ``instead`` replaces some of them and adds others."""
    kept = [instead.pop(c).alias(c) if c in instead else F.col(f"doc.`{c}`") for c in columns]
    return [*kept, *[v.alias(c) for c, v in instead.items()]]


def row_key() -> Column:
    """With doc_id it tells rows apart; rows equal in both are interchangeable."""
    return F.xxhash64("doc_id", "text")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Written to the shared folder and read back: lineage is cut, lost executors cost nothing."""
    return materialize(df, f"llm-{label}")


def ship_package(spark: SparkSession) -> None:
    """Makes this package importable in the Python workers, once per application.

    The driver's archive travels through Spark's own file distribution.
    """
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        folder = tempfile.mkdtemp(prefix="logassay-")
        archive = shutil.make_archive(
            f"{folder}/logassay-package", "zip", PACKAGE.parent, PACKAGE.name
        )
        spark.sparkContext.addPyFile(archive)
        _shipped.add(app)


def map_batches(
    df: DataFrame, schema: str, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]
) -> DataFrame:
    ship_package(df.sparkSession)
    return df.mapInArrow(run, schema)


def map_texts(
    df: DataFrame, schema: str, work: Callable[[list[bytes], dict[str, list]], dict[str, object]],
    names: list[str] | None = None,
) -> DataFrame:
    """Runs ``work`` over slices of rows; it gets the texts as UTF-8 and the other columns.

    ``work`` returns the columns of ``schema`` as lists or arrays; ``names`` lists
    them where nested types make the schema harder to take apart.
    """
    names = names or [part.split()[0] for part in schema.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                raw = part.column("text").cast(pa.binary()).to_pylist()
                rest = {c: part.column(c).to_pylist() for c in part.schema.names if c != "text"}
                out = work(raw, rest)
                yield pa.RecordBatch.from_arrays([as_arrow(out[c]) for c in names], names=names)

    return map_batches(df, schema, run)


def as_arrow(values) -> pa.Array:
    return values if isinstance(values, pa.Array) else pa.array(values)


def slices(batch: pa.RecordBatch, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``limit`` bytes of text, at least one row each."""
    sizes = pc.binary_length(batch.column("text")).to_pylist()
    start = held = 0
    for i, size in enumerate(sizes):
        if held and held + (size or 0) > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size or 0
    if start < len(sizes):
        yield batch.slice(start)
