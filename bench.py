"""Times the headline queries and full table reads; prints one JSON line.

BENCH_SF_DIR   input folder            (default /root/testdata/sf0.1)
BENCH_CPUS     local cores             (default 8)
BENCH_ROWS     least rows of the read test (default 4676570, the published size)

Each query runs twice and the second run counts, so class loading and code
generation stay out. Results go to a noop sink, which makes Spark produce every
row and column without bringing them to the driver. The table of the read test
repeats the log with shifted keys and measures, so that its files compress like
a log and not like copies; rows per second and core are given for both formats.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F  # noqa: E402

from logassay.plans import inputs  # noqa: E402
from logassay.plans.catalog import QUERIES  # noqa: E402
from logassay.session import build_session  # noqa: E402
from logassay.sources import storage, tables  # noqa: E402

HEADLINE = (
    "daily_dup_structure", "dup_summary", "dedup_ladder", "exact_duplicates", "duplicate_pairs",
    "scale_profile", "measure_profile", "user_longtail", "item_longtail", "daily_activity",
    "ratio_consistency", "date_time_consistency", "epoch_date_consistency", "offset_profile",
    "matrix_coverage_sparse", "feature_coverage", "day_overlap", "user_subset", "date_segments",
    "user_gaps", "peak_neighbors", "dedupe_last", "segment_sequences", "point_in_time_features",
    "utf8_validity", "typed_ingest", "verdicts",
)


def timed(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def sink(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    rows = int(os.environ.get("BENCH_ROWS", "4676570"))
    work = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark = build_session(
        "logassay-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            # Recording a Python call site per expression costs more than planning it.
            "spark.python.sql.dataFrameDebugging.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    seconds: dict[str, float] = {}
    for name in HEADLINE:
        for _ in range(2):
            seconds[name] = round(timed(lambda: sink(QUERIES[name](spark, sf_dir))), 3)

    log = inputs.log(spark, sf_dir)
    copies = -(-rows // log.count())
    turn = F.col("_n")
    large = (
        log.withColumn("_n", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
        .withColumns(
            {
                "user_id": F.col("user_id") + turn * 1000,
                "item_id": F.pmod(F.col("item_id") + turn * 37, F.lit(10_000)),
                "played_ms": F.col("played_ms") + F.pmod(F.xxhash64("epoch_s", "_n"), F.lit(5000)),
                "epoch_s": F.col("epoch_s") + turn * F.lit(0.25),
                "ratio": F.col("ratio") * (F.lit(1.0) + turn / 1000),
            }
        )
        .drop("_n")
    )
    large.repartition(int(cpus)).write.option("header", True).csv(f"{work}/csv")
    csv = tables.read_csv(spark, f"{work}/csv", tables.raw_schema(inputs.ROLES))
    seconds["ingest_csv_to_parquet"] = round(
        timed(lambda: tables.ingest(spark, f"{work}/csv", f"{work}/parquet")), 3
    )
    parquet = spark.read.parquet(f"{work}/parquet")
    seconds["full_read_csv"] = round(storage.full_read_seconds(csv), 3)
    seconds["full_read_parquet"] = round(storage.full_read_seconds(parquet), 3)
    sizes = storage.storage_footprint(csv, parquet).first().asDict()
    spark.stop()

    print(
        json.dumps(
            {
                "metric": "total seconds of headline queries and full reads",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "read_rows": sizes["parquet_rows"],
                "rows_per_second_and_core": {
                    name: round(sizes["parquet_rows"] / seconds[f"full_read_{name}"] / int(cpus))
                    for name in ("csv", "parquet")
                },
                "csv_mb": round(sizes["csv_bytes"] / 1e6, 1),
                "parquet_mb": round(sizes["parquet_bytes"] / 1e6, 1),
                "size_ratio": sizes["size_ratio"],
            }
        )
    )


if __name__ == "__main__":
    main()
