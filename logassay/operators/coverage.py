"""Coverage of key products and comparison of the key sets of two tables.

Two tables are compared by tagging and stacking their keys and grouping once:
each side folds its repeated keys before the single shuffle, so a key that
holds a third of a table costs no more than any other, and no join is needed.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logassay.functions.numeric import filtered_sum, percent, total
from logassay.operators.order import parallelism, positions
from logassay.roles import Roles


def matrix_coverage(df: DataFrame, roles: Roles) -> DataFrame:
    """Observed pairs against users x items. The product is a number, never a table.

    ``expected_pairs`` and ``gap`` are null when the product exceeds a bigint; the
    percentage is then still right. Rows lacking a key are counted in ``keyless_rows``.
    """
    keyed = F.col(roles.user).isNotNull() & F.col(roles.item).isNotNull()
    pairs = df.groupBy(*roles.pair).agg(F.count(F.lit(1)).alias("n")).withColumn("_keyed", keyed)
    sizes = pairs.agg(
        F.count_distinct(F.when(F.col("_keyed"), F.col(roles.user))).alias("users"),
        F.count_distinct(F.when(F.col("_keyed"), F.col(roles.item))).alias("items"),
        F.count_if("_keyed").alias("actual_pairs"),
        F.count_if(F.col("_keyed") & (F.col("n") > 1)).alias("dup_pairs"),
        filtered_sum(~F.col("_keyed"), F.col("n")).alias("keyless_rows"),
    )
    product = F.col("users").cast("double") * F.col("items").cast("double")
    return sizes.withColumn("expected_pairs", F.try_multiply("users", "items")).select(
        "users",
        "items",
        "expected_pairs",
        "actual_pairs",
        (F.col("expected_pairs") - F.col("actual_pairs")).alias("gap"),
        percent(F.col("actual_pairs"), product).alias("coverage_pct"),
        "dup_pairs",
        "keyless_rows",
    )


def gap_cells(df: DataFrame, roles: Roles, block: int = 4096) -> DataFrame:
    """Every (user, item) that never occurs, of the users and items that do.

    Items are numbered and cut in blocks of ``block``. A user's items of a block
    are taken out of the block's whole list; what is left comes out, so the product
    of users and items is never formed and the work follows users times blocks and
    the gaps themselves. A block's list is copied once per shuffle partition, that
    users of one block are spread over many tasks.
    """
    spread = parallelism(df)
    keyed = F.col(roles.user).isNotNull() & F.col(roles.item).isNotNull()
    seen = df.where(keyed).select(F.col(roles.user).alias("u"), F.col(roles.item).alias("i")).distinct()
    numbered = positions(seen.select("i").distinct(), [F.col("i")], "_at")
    numbered = numbered.select("i", F.expr(f"(_at - 1) div {block}").alias("_block"))
    lists = numbered.groupBy("_block").agg(F.collect_list("i").alias("_all"))
    lists = lists.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))))
    own = seen.join(numbered, "i").groupBy("u", "_block").agg(F.collect_list("i").alias("_own"))
    users = seen.select("u").distinct().withColumn("_salt", F.pmod(F.xxhash64("u"), F.lit(spread)).cast("int"))
    cells = users.join(lists, "_salt").join(own, ["u", "_block"], "left")
    missing = F.when(F.col("_own").isNull(), F.col("_all")).otherwise(F.array_except("_all", "_own"))
    return cells.select(F.col("u").alias(roles.user), F.explode(missing).alias(roles.item))


def find_column(df: DataFrame, fragment: str) -> str | None:
    """First column whose name contains the fragment, ignoring case."""
    return next((c for c in df.columns if fragment.lower() in c.lower()), None)


def feature_coverage(
    base: DataFrame, base_key: str, source: DataFrame, source_key: str, name: str
) -> DataFrame:
    """One row: size, keys and date range of a feature source, and the share of base keys in it.

    A source without a date-like column has a null range. Null keys are left out of the key sets.
    """
    date_column = find_column(source, "date")
    date_type = dict(source.dtypes)[date_column] if date_column else "string"
    when = F.col(date_column) if date_column else F.lit(None).cast("string")
    offered = source.select(
        F.col(source_key).alias("_key"), F.lit(False).alias("_base"), when.alias("_when"),
        F.lit(1).cast("bigint").alias("_rows"),
    )
    wanted = base.select(
        F.col(base_key).alias("_key"), F.lit(True).alias("_base"),
        F.lit(None).cast(date_type).alias("_when"), F.lit(0).cast("bigint").alias("_rows"),
    )
    keyed = offered.unionByName(wanted).groupBy("_key").agg(
        F.max("_base").alias("_base"), F.sum("_rows").alias("_rows"),
        F.min("_when").alias("_from"), F.max("_when").alias("_to"),
    )
    known = F.col("_key").isNotNull()
    in_base, in_source = known & F.col("_base"), known & (F.col("_rows") > 0)
    facts = keyed.agg(
        total(F.col("_rows")).alias("rows"),
        F.count_if(in_source).alias("items"),
        F.min("_from").cast("string").alias("date_min"),
        F.max("_to").cast("string").alias("date_max"),
        F.count_if(in_base).alias("base_items"),
        F.count_if(in_base & in_source).alias("covered_items"),
    )
    return facts.select(
        F.lit(name).alias("source"),
        F.lit(len(source.columns)).cast("bigint").alias("columns"),
        F.lit(date_column).cast("string").alias("date_column"),
        "*",
        percent(F.col("covered_items"), F.col("base_items"), 2).alias("coverage_pct"),
    )


def key_presence(left: DataFrame, left_key: str, right: DataFrame, right_key: str) -> DataFrame:
    """Each non-null key of either table with a flag for each side (a full outer membership)."""
    both = left.select(
        F.col(left_key).alias("key"), F.lit(True).alias("in_left"), F.lit(False).alias("in_right")
    ).unionByName(
        right.select(
            F.col(right_key).alias("key"), F.lit(False).alias("in_left"), F.lit(True).alias("in_right")
        )
    )
    return (
        both.where(F.col("key").isNotNull())
        .groupBy("key")
        .agg(F.max("in_left").alias("in_left"), F.max("in_right").alias("in_right"))
    )


def presence_counts(presence: DataFrame) -> DataFrame:
    """One row: keys on each side, shared, and on one side only."""
    left, right = F.col("in_left"), F.col("in_right")
    return presence.agg(
        F.count(F.lit(1)).alias("all_keys"),
        F.count_if(left).alias("left_keys"),
        F.count_if(right).alias("right_keys"),
        F.count_if(left & right).alias("shared_keys"),
        F.count_if(left & ~right).alias("left_only"),
        F.count_if(right & ~left).alias("right_only"),
    )


def key_subset(left: DataFrame, left_key: str, right: DataFrame, right_key: str) -> DataFrame:
    """Is every key of the left table also in the right one."""
    return presence_counts(key_presence(left, left_key, right, right_key)).withColumn(
        "is_subset", F.col("left_only") == 0
    )


def key_union(left: DataFrame, left_key: str, right: DataFrame, right_key: str) -> DataFrame:
    return key_presence(left, left_key, right, right_key).select("key")


def shared_keys(left: DataFrame, left_key: str, right: DataFrame, right_key: str) -> DataFrame:
    """Distinct non-null left keys that also occur on the right (semi-join)."""
    wanted = right.select(F.col(right_key).alias("key")).distinct()
    return left.select(F.col(left_key).alias("key")).distinct().join(wanted, "key", "left_semi")


def missing_keys(left: DataFrame, left_key: str, right: DataFrame, right_key: str) -> DataFrame:
    """Distinct non-null left keys that do not occur on the right (anti-join)."""
    wanted = right.select(F.col(right_key).alias("key")).distinct()
    keys = left.select(F.col(left_key).alias("key")).where(F.col("key").isNotNull()).distinct()
    return keys.join(wanted, "key", "left_anti")


def subset_offenders(
    left: DataFrame, left_key: str, right: DataFrame, right_key: str, n: int = 10
) -> DataFrame:
    """The n smallest left keys absent on the right (a top-n report)."""
    return missing_keys(left, left_key, right, right_key).orderBy("key").limit(n)


def day_availability(left: DataFrame, left_day: str, right: DataFrame, right_day: str) -> DataFrame:
    """Every day of either table with a presence flag per table; the null day is left out."""
    return key_presence(left, left_day, right, right_day).withColumnRenamed("key", "day")


def day_overlap(left: DataFrame, left_day: str, right: DataFrame, right_day: str) -> DataFrame:
    """Days in each table, shared, and on one side only."""
    names: Mapping[str, str] = {
        "all_keys": "all_days", "left_keys": "left_days", "right_keys": "right_days",
        "shared_keys": "shared_days",
    }
    return presence_counts(key_presence(left, left_day, right, right_day)).withColumnsRenamed(names)
