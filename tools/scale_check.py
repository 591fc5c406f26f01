"""Runs the heavy operators on an enlarged log whose hottest pair holds a third of all rows.

    python tools/scale_check.py [copies]

Prints, per operator, the seconds taken and, from Spark's event log, every
stage worth looking at: tasks, median and slowest task, records and shuffle
size. A hot key that is not folded before a shuffle shows as a slowest task
far above the median.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from collections import defaultdict
from collections.abc import Callable
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from logassay.operators import (  # noqa: E402
    calendar, contract, coverage, dedupe, duplicates, profile, sequences,
)
from logassay.plans import inputs  # noqa: E402
from logassay.session import build_session  # noqa: E402

SOURCE = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
R = inputs.ROLES

OPERATORS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "daily_dup_structure": lambda t: duplicates.daily_dup_structure(t, R),
    "dup_summary": lambda t: duplicates.dup_summary(t, R),
    "dedupe_exact": dedupe.drop_exact,
    "dedupe_last": lambda t: dedupe.keep_last(t, R),
    "long_tail": lambda t: profile.long_tail(t, R.user),
    "scale_profile": lambda t: profile.scale_profile(t, R),
    "measure_profile": lambda t: profile.measure_profile(t, R.ratio),
    "daily_activity": lambda t: profile.daily_activity(t, R),
    "offset_profile": lambda t: contract.offset_profile(t, R),
    "matrix_coverage": lambda t: coverage.matrix_coverage(t, R),
    "key_subset": lambda t: coverage.key_subset(t, R.user, t, R.user),
    "date_segments": lambda t: calendar.date_segments(t, R.day),
    "user_segments": lambda t: calendar.date_segments(t, R.day, [R.user]),
    "segment_sequences": lambda t: sequences.segment_sequences(t, R),
}


def enlarged(spark: SparkSession, copies: int) -> DataFrame:
    """Each copy has users of its own, but every third one is folded onto a single pair and day."""
    grown = (
        inputs.log(spark, SOURCE)
        .withColumn("c", F.explode(F.sequence(F.lit(1), F.lit(copies))))
        .withColumn("user_id", F.col("user_id") + F.col("c") * 1_000_000)
        .withColumn("played_ms", F.col("played_ms") + F.col("c"))
    )
    hot = F.col("c") % 3 == 0
    one = {"user_id": 1, "item_id": 1, "day": inputs.PARTIAL_DOUBLE}
    return grown.withColumns({k: F.when(hot, v).otherwise(F.col(k)) for k, v in one.items()}).drop("c")


def stages(folder: str) -> None:
    named: dict[int, str] = {}
    tasks: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    for file in Path(folder).iterdir():
        for line in file.open():
            event = json.loads(line)
            if event["Event"] == "SparkListenerJobStart":
                for stage in event["Stage IDs"]:
                    named.setdefault(stage, event["Properties"].get("spark.job.description", ""))
            elif event["Event"] == "SparkListenerTaskEnd" and "Task Metrics" in event:
                m = event["Task Metrics"]
                tasks[event["Stage ID"]].append(
                    (
                        m["Executor Run Time"],
                        m["Shuffle Read Metrics"]["Total Records Read"],
                        m["Shuffle Write Metrics"]["Shuffle Bytes Written"],
                    )
                )
    print(f"{'operator':22}{'tasks':>6}{'median ms':>11}{'max ms':>9}{'records in':>12}{'shuffle MB':>12}")
    for stage, seen in sorted(tasks.items()):
        times = sorted(t for t, _, _ in seen)
        if named.get(stage) in OPERATORS and times[-1] >= 200:
            print(
                f"{named[stage]:22}{len(seen):>6}{times[len(times) // 2]:>11}{times[-1]:>9}"
                f"{sum(r for _, r, _ in seen):>12}{sum(b for _, _, b in seen) / 1e6:>12.1f}"
            )


def main(copies: int) -> None:
    work = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    os.makedirs(f"{work}/events")
    spark = build_session(
        "logassay-scale",
        f"local[{os.environ.get('BENCH_CPUS', '8')}]",
        **{
            "spark.sql.shuffle.partitions": "64",
            "spark.driver.memory": "16g",
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": f"file://{work}/events",
            "spark.eventLog.rolling.enabled": "false",
            "spark.eventLog.compress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    enlarged(spark, copies).repartition(32).write.parquet(f"{work}/log")
    table = spark.read.parquet(f"{work}/log")
    print(f"rows {table.count():,}")
    for name, operator in OPERATORS.items():
        spark.sparkContext.setJobDescription(name)
        start = time.perf_counter()
        operator(table).write.format("noop").mode("overwrite").save()
        print(f"{name:22}{time.perf_counter() - start:8.2f} s", flush=True)
    spark.stop()
    stages(f"{work}/events")


if __name__ == "__main__":
    main(int(sys.argv[1]) if len(sys.argv) > 1 else 60)
