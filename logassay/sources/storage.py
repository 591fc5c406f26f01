"""Bytes and full-read time of the same table in two formats."""

from __future__ import annotations

import time
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logassay.functions.numeric import ratio
from logassay.operators.verdict import merge_facts


def footprint(df: DataFrame, name: str) -> DataFrame:
    """One row: files, bytes and rows behind a file-based frame."""
    return (
        df.select(
            F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size")
        )
        .groupBy("path", "size")
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(
            F.count(F.lit(1)).alias(f"{name}_files"),
            F.sum("size").alias(f"{name}_bytes"),
            F.sum("n").alias(f"{name}_rows"),
        )
    )


def storage_footprint(csv: DataFrame, parquet: DataFrame) -> DataFrame:
    """Sizes side by side and how many times smaller Parquet is."""
    facts = merge_facts(footprint(csv, "csv"), footprint(parquet, "parquet"))
    factor = ratio(F.col("csv_bytes"), F.col("parquet_bytes"))
    return facts.withColumn("size_ratio", F.round(factor, 4)).withColumn("smaller", factor > 1.0)


def full_read_seconds(df: DataFrame, runs: int = 2) -> float:
    """Seconds to read every column, last of ``runs``. A count would be pruned to almost nothing."""
    taken = 0.0
    for _ in range(runs):
        start = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        taken = time.perf_counter() - start
    return taken


def compare_formats(csv: DataFrame, parquet: DataFrame, runs: int = 2) -> DataFrame:
    """One row: size ratio, both read times, and whether Parquet wins on both."""
    seconds: Mapping[str, float] = {
        "csv_seconds": full_read_seconds(csv, runs),
        "parquet_seconds": full_read_seconds(parquet, runs),
    }
    out = storage_footprint(csv, parquet).withColumns({k: F.lit(v) for k, v in seconds.items()})
    faster = F.col("parquet_seconds") < F.col("csv_seconds")
    return out.withColumn("better", faster & F.col("smaller"))
