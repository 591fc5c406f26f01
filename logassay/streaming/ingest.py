"""Typed ingest that takes up only the CSV files not yet converted.

The batch ingest rewrites a table; here the file stream's checkpoint remembers
what was read, so a rerun after new files (or a failure) continues where the
last one ended, and each file lands once.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from logassay.roles import Roles
from logassay.sources.tables import ParquetLayout, raw_schema, typed


def ingest_new_files(
    spark: SparkSession,
    csv_folder: str,
    parquet: str,
    checkpoint: str,
    roles: Roles = Roles(),
    layout: ParquetLayout = ParquetLayout(),
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Starts a run over the files present now; it ends by itself (``awaitTermination``)."""
    lines = (
        spark.readStream.schema(raw_schema(roles))
        .option("header", True)
        .option("enforceSchema", False)
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(csv_folder)
    )
    writer = (
        typed(lines, roles)
        .writeStream.format("parquet")
        .option("path", parquet)
        .option("checkpointLocation", checkpoint)
        .options(**layout.options())
        .outputMode("append")
        .trigger(availableNow=True)
    )
    if layout.partition_by:
        writer = writer.partitionBy(*layout.partition_by)
    return writer.start()
