from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

from pyspark.sql import functions as F  # noqa: E402

from logassay.roles import Roles  # noqa: E402
from logassay.session import build_session  # noqa: E402

TESTDATA = Path("/root/testdata")
SMALL, MIDDLE = str(TESTDATA / "sf0.001"), str(TESTDATA / "sf0.01")

FIXTURE_ROLES = Roles(
    user="user_id", item="video_id", day="date", wall_time="time", epoch="timestamp",
    numerator="play_duration", denominator="video_duration", ratio="watch_ratio",
)


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "logassay-tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "3",
            "spark.python.sql.dataFrameDebugging.enabled": "false",
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def planted_log(spark, sf_dir):
    """The fixture of FIXTURES.md section 2: gaps, a whole-day copy, a partial copy, wrong days."""
    base = spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr(
        "event_id",
        "user_id",
        "cast(regexp_extract(props, '([0-9]+)', 1) as bigint) AS video_id",
        "cast(floor(value * 100) as bigint) AS play_duration",
        "cast(5000 + (cast(regexp_extract(props, '([0-9]+)', 1) as int) % 17) * 1000 as bigint) AS video_duration",
        "ts + interval '8' hour AS time",
        "unix_micros(cast(ts as timestamp)) / 1000000.0D AS timestamp",
    )
    base = (
        base.withColumn("shown", F.expr("CASE WHEN event_id % 499 = 0 THEN time - interval '1' day ELSE time END"))
        .withColumn("date", F.expr("cast(date_format(shown, 'yyyyMMdd') as bigint)"))
        .withColumn("watch_ratio", F.expr("cast(play_duration as double) / cast(video_duration as double)"))
        .where(~F.col("date").between(20240108, 20240111) & ~F.col("date").between(20240122, 20240123))
    )
    whole = base.where("date = 20240115")
    partial = base.where("date = 20240105").withColumn(
        "play_duration", F.expr("play_duration + CASE WHEN event_id % 20 = 0 THEN 1 ELSE 0 END")
    )
    return base.unionByName(whole).unionByName(partial).select(*FIXTURE_ROLES.columns)


@pytest.fixture(scope="session")
def planted(spark):
    return planted_log(spark, MIDDLE).cache()


@pytest.fixture(scope="session")
def panel(spark):
    """FIXTURES.md section 3: an almost full 20 x 20 matrix with some rows without time."""
    ids = spark.range(400).selectExpr("id div 20 AS u", "id % 20 AS v")

    def build(step):
        return ids.where(f"(u * 31 + v) % {step} <> 7").selectExpr(
            "u AS user_id",
            "v AS video_id",
            "bigint(1000) AS play_duration",
            "bigint(2000) AS video_duration",
            "CASE WHEN (u + v) % 25 <> 0 THEN timestamp_ntz'2024-01-02 08:00:00' END AS time",
            "CASE WHEN (u + v) % 25 <> 0 THEN bigint(20240102) END AS date",
            "CASE WHEN (u + v) % 25 <> 0 THEN 1704153600.0D END AS timestamp",
            "0.5D AS watch_ratio",
        )

    return build
