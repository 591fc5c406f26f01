"""Typed CSV reading and Parquet writing."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logassay.functions import clock
from logassay.roles import Roles


def raw_schema(roles: Roles) -> T.StructType:
    """Text layout of an interaction log.

    The clock and the day stay text here: the clock's fraction length varies,
    and a day column with blank cells may be written as '20200705.0'.
    """
    kinds = {
        roles.user: T.LongType(),
        roles.item: T.LongType(),
        roles.numerator: T.LongType(),
        roles.denominator: T.LongType(),
        roles.wall_time: T.StringType(),
        roles.day: T.StringType(),
        roles.epoch: T.DoubleType(),
        roles.ratio: T.DoubleType(),
    }
    return T.StructType([T.StructField(c, kinds[c]) for c in roles.columns])


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header and a declared schema; the file is never sampled to guess types.

    Header names are checked against the schema. Cells that do not fit become
    null (PERMISSIVE); ``bad_rows`` counts them.
    """
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


CORRUPT = "_corrupt_record"
# Doubles up to here hold every whole number.
WHOLE_LIMIT = float(2**53)


def bad_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One row: total rows and rows with a cell that does not fit the schema."""
    kept = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    lines = (
        spark.read.schema(kept)
        .option("header", True)
        .option("enforceSchema", False)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path)
    )
    # Spark refuses to read the corrupt column alone: parsing the others is what fills it.
    cells = F.xxhash64(*[F.col(c) for c in schema.names])
    return lines.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(F.when(F.col(CORRUPT).isNotNull(), cells)).alias("bad_rows"),
    )


def whole_day(text: Column, day_type: str = "bigint") -> Column:
    """A day cell that is a whole number ('20240101' or '20240101.0'), else null.

    Fractions, NaN, infinities and numbers beyond 2^53 are no days.
    """
    number = text.try_cast("double")
    whole = number.between(-WHOLE_LIMIT, WHOLE_LIMIT) & (F.rint(number) == number)
    return F.when(whole, number).cast(day_type)


def typed(raw: DataFrame, roles: Roles, day_type: str = "bigint") -> DataFrame:
    """Text columns of a log to their types: lenient clock, whole-number day, numbers as they read."""
    numbers = {
        c: F.col(c).try_cast(kind)
        for c, kind in (
            (roles.user, "bigint"), (roles.item, "bigint"), (roles.numerator, "bigint"),
            (roles.denominator, "bigint"), (roles.epoch, "double"), (roles.ratio, "double"),
        )
        if c in raw.columns and isinstance(raw.schema[c].dataType, T.StringType)
    }
    day = whole_day(F.col(roles.day), day_type)
    return raw.withColumns(
        {roles.wall_time: clock.parse_wall_clock(F.col(roles.wall_time)), roles.day: day, **numbers}
    )


@dataclass(frozen=True)
class ParquetLayout:
    """``row_group_rows`` caps rows per row group; left at None, the 128 MB block size decides,
    which suits large tables better."""

    compression: str = "zstd"
    row_group_rows: int | None = None
    file_rows: int | None = None
    partition_by: tuple[str, ...] = ()

    def options(self) -> dict[str, str]:
        chosen = {"compression": self.compression}
        if self.row_group_rows:
            chosen["parquet.block.row.count.limit"] = str(self.row_group_rows)
        if self.file_rows:
            chosen["maxRecordsPerFile"] = str(self.file_rows)
        return chosen


def write_parquet(
    df: DataFrame, path: str, layout: ParquetLayout = ParquetLayout(), mode: str = "errorifexists"
) -> None:
    """Unordered, task-wise write; no shuffle."""
    writer = df.write.mode(mode).options(**layout.options())
    if layout.partition_by:
        writer = writer.partitionBy(*layout.partition_by)
    writer.parquet(path)


def ingest(
    spark: SparkSession,
    csv: str,
    parquet: str,
    roles: Roles = Roles(),
    layout: ParquetLayout = ParquetLayout(),
    mode: str = "errorifexists",
) -> DataFrame:
    """CSV log to a typed Parquet table: one job without a shuffle. Returns the written table."""
    write_parquet(typed(read_csv(spark, csv, raw_schema(roles)), roles), parquet, layout, mode)
    return spark.read.parquet(parquet)
