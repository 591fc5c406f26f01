"""Positions in a global order, without a window in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logassay.sources.scratch import materialize

# monotonically_increasing_id() keeps the place within the partition in its lower bits.
PLACE_BITS = 33


def parallelism(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _stretches(df: DataFrame, order: list[Column], label: str) -> DataFrame:
    """The rows range partitioned and sorted, written, with the number of their partition and place.

    Each partition is a stretch of the global order; writing them keeps the
    bounds the same for every later read.
    """
    placed = (
        df.repartitionByRange(parallelism(df), *order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    placed = materialize(placed, label)
    return placed.withColumn("_part", F.shiftright("_at", PLACE_BITS))


def _before(sizes: DataFrame, names: list[str]) -> DataFrame:
    """Sums over all earlier partitions: one row for each partition, so it may be broadcast."""
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return F.broadcast(
        sizes.select("_part", *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"{n}_before") for n in names])
    )


def positions(df: DataFrame, order: list[Column], name: str, salt: Column | None = None) -> DataFrame:
    """``df`` with ``name``: the row's place, from 1, when all rows are sorted by ``order``.

    A row's place within its partition comes with the sort; only the partitions'
    sizes are summed up in one task. Rows equal in ``order`` take places in any
    order; where many may be, ``salt`` lets their stretch be cut.
    """
    placed = _stretches(df, order if salt is None else [*order, salt], "positions")
    offsets = _before(placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows")), ["_rows"])
    place = F.col("_at").bitwiseAND(F.lit((1 << PLACE_BITS) - 1)) + 1
    return placed.join(offsets, "_part").select(*df.columns, (F.col("_rows_before") + place).alias(name))


def running_sums(df: DataFrame, order: list[Column], sums: dict[str, str]) -> DataFrame:
    """``df`` with a column for each of ``sums`` (name -> column): the sum over all rows before.

    Rows should differ in ``order``; those that do not stand in any order.
    """
    placed = _stretches(df, order, "sums")
    totals = placed.groupBy("_part").agg(*[F.sum(c).alias(f"_{n}") for n, c in sums.items()])
    offsets = _before(totals, [f"_{n}" for n in sums])
    own = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    near = placed.withColumns({f"_{n}": F.coalesce(F.sum(c).over(own), F.lit(0)) for n, c in sums.items()})
    return near.join(offsets, "_part").select(
        *df.columns, *[(F.col(f"_{n}") + F.col(f"_{n}_before")).alias(n) for n in sums]
    )
