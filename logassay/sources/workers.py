"""Python workers: the package shipped to them, and Arrow batches through a function."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

PACKAGE = Path(__file__).resolve().parents[1]
_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Makes this package importable in the workers, once per application, by Spark's file distribution."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        folder = tempfile.mkdtemp(prefix="logassay-")
        archive = shutil.make_archive(f"{folder}/logassay-core", "zip", PACKAGE.parent, PACKAGE.name)
        spark.sparkContext.addPyFile(archive)
        _shipped.add(app)


def map_arrow(
    df: DataFrame, schema: str, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]
) -> DataFrame:
    ship_package(df.sparkSession)
    return df.mapInArrow(run, schema)
