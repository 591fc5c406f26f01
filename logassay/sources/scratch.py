"""Scratch tables in the folder the cluster shares.

Intermediate results that several reports read are written there as Parquet
and read back: lineage is cut, later reads prune columns, and a lost executor
costs nothing but its running tasks.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
_local_folders: dict[str, str] = {}
_written: dict[str, list[str]] = {}


def scratch_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a temporary folder only in local mode."""
    shared = spark.conf.get(SETTING, None)
    if shared:
        return shared
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {SETTING} to a folder all executors share")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="logassay-")
    return _local_folders[context.applicationId]


def scratch_path(spark: SparkSession, label: str) -> str:
    path = f"{scratch_folder(spark).rstrip('/')}/logassay-{label}-{uuid.uuid4().hex}"
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def written(spark: SparkSession) -> int:
    """How many scratch tables this application has asked for so far."""
    return len(_written.get(spark.sparkContext.applicationId, []))


def release(spark: SparkSession, since: int = 0) -> None:
    """Removes scratch tables asked for after ``since``; frames that read them end with them."""
    paths = _written.get(spark.sparkContext.applicationId, [])
    jvm, settings = spark._jvm, spark._jsc.hadoopConfiguration()
    for path in paths[since:]:
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(settings).delete(place, True)
    del paths[since:]


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Writes the frame to the shared folder and returns the written table."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
