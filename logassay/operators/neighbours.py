"""Items that go together, from who touched both: co-occurrence with cosine norm, and Swing.

Both start from the distinct (user, item) pairs. Pairs of items or of users are
formed inside tasks from lists (``meetings``); shuffled are lists, not pairs: a
user's list goes to each block of items it holds one of, an item's list of
users to each block of users. Only possible neighbours, or items that similar
users share, leave a task.

``member_pairs`` gives the pairs of lists as rows of a table: a list is cut in
blocks, and every pair of blocks is a row of its own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logassay.operators import order
from logassay.operators.meetings import BLOCK_MEMBERS, Lists, block_count, counted, packed_lists, runs, similar, spread
from logassay.roles import Roles
from logassay.sources.scratch import materialize

BLOCK = 64
NAME_BITS = 31
NO_ITEMS = pa.schema([(c, pa.int64()) for c in ("a", "b", "item")]).empty_table()
NO_MEETINGS = pa.schema([(c, pa.int64()) for c in ("x", "y", "c")]).empty_table()
SLACK = 1e-8  # more than a rounding to 9 digits and the sums' own error


def member_pairs(df: DataFrame, group: str, member: str, block: int = BLOCK) -> DataFrame:
    """group, a, b (a < b): every pair of members of a group once; ``df`` holds distinct rows.

    Members are dealt to the blocks of their group by a hash. A block is sent
    once for each block of its group, itself included.
    """
    sizes = df.groupBy(group).agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("_blocks"))
    several = sizes.where("_blocks > 1")
    dealt = df.join(several, group, "left").withColumn("_blocks", F.coalesce("_blocks", F.lit(1)))
    lists = (
        dealt.withColumn("_block", F.pmod(F.xxhash64(group, member), F.col("_blocks")).cast("int"))
        .groupBy(group, "_block", "_blocks")
        .agg(F.collect_list(member).alias("_list"))
    )
    other = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))
    halves = lists.withColumn("_other", other).select(
        group,
        F.least("_block", "_other").alias("_i"),
        F.greatest("_block", "_other").alias("_j"),
        F.when(F.col("_block") <= F.col("_other"), F.col("_list")).alias("_left"),
        F.when(F.col("_block") >= F.col("_other"), F.col("_list")).alias("_right"),
    )
    # One or two rows meet here, a block and the other one of the pair.
    met = halves.groupBy(group, "_i", "_j").agg(
        F.first("_left", ignorenulls=True).alias("_left"), F.first("_right", ignorenulls=True).alias("_right")
    )
    pairs = met.where(F.col("_left").isNotNull() & F.col("_right").isNotNull()).select(
        group, (F.col("_i") == F.col("_j")).alias("_same"), F.explode("_left").alias("_a"), "_right"
    )
    pairs = pairs.select(group, "_same", "_a", F.explode("_right").alias("_b"))
    return pairs.where(~F.col("_same") & (F.col("_a") != F.col("_b")) | (F.col("_a") < F.col("_b"))).select(
        group, F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")
    )


def _distinct(df: DataFrame, roles: Roles) -> DataFrame:
    known = F.col(roles.user).isNotNull() & F.col(roles.item).isNotNull()
    return df.where(known).select(F.col(roles.user).alias("u"), F.col(roles.item).alias("i")).distinct()


def _ranked(rows: DataFrame, item: str, order: list[Column], values: list[str], top: int) -> DataFrame:
    """The first ``top`` neighbours of each item ranked from 1."""
    place = Window.partitionBy(item).orderBy(*order, f"neighbour_{item}")
    return (
        rows.withColumn("rank", F.row_number().over(place).cast("bigint"))
        .where(F.col("rank") <= top)
        .select(item, "rank", f"neighbour_{item}", *values)
    )


def nearest(
    a: np.ndarray, b: np.ndarray, n: np.ndarray, of_a: np.ndarray, of_b: np.ndarray, top: int
) -> np.ndarray:
    """Which rows may be among the first ``top`` of their a by n / sqrt(of_a * of_b), rounded.

    Rows are sorted by a and b. All within a rounding of the value at place
    ``top`` stay; of those with the same n and of_b, which tie, the first ``top``.
    """
    starts, length = runs(a)
    rank = np.repeat(np.arange(len(starts)), length)
    value = 2.0 * rank - n / np.sqrt(of_a.astype(np.float64) * of_b)  # a cosine is at most 1
    last = np.sort(value)[starts + np.minimum(top, length) - 1]
    kept = np.flatnonzero(value <= last[rank] + SLACK)
    kept = kept[np.lexsort((b[kept], of_b[kept], n[kept], rank[kept]))]
    tied = np.stack((rank[kept], n[kept], of_b[kept]))
    starts = np.flatnonzero(np.concatenate(([True], (tied[:, 1:] != tied[:, :-1]).any(axis=0))))
    place = np.arange(len(kept)) - np.repeat(starts, np.diff(starts, append=len(kept)))
    return kept[place < top]


def item_neighbours(df: DataFrame, roles: Roles, top: int, block: int = BLOCK_MEMBERS) -> DataFrame:
    """Per item its ``top`` items (a top-n report) by users_both / sqrt(users * users of the other).

    Ties go to the smaller item. Items without a neighbour have no row. Items
    are numbered by users and item, so a number tells its users by a list of at
    most sqrt(2 * pairs) bounds, and equal counts of equal users tie in order.
    """
    touched = materialize(_distinct(df, roles), "touched")
    users = touched.groupBy("i").agg(F.count(F.lit(1)).alias("n"))
    items = order.positions(users, [F.col("n"), F.col("i")], "code")
    bounds = items.groupBy("n").agg(F.min("code").alias("first")).orderBy("n").collect()
    first = np.array([r["first"] for r in bounds], dtype=np.int64)
    degree = np.array([r["n"] for r in bounds], dtype=np.int64)
    blocks = block_count(touched, "u", items.count(), block)
    listed = touched.join(items.select("i", "code"), "i").select(F.col("u").alias("g"), F.col("code").alias("m"))

    def met(table: pa.Table) -> pa.Table:
        found = []
        for a, b, n in counted(Lists(table), blocks):
            of_a, of_b = (degree[np.searchsorted(first, x, side="right") - 1] for x in (a, b))
            kept = nearest(a, b, n, of_a, of_b, top)
            found.append((a[kept], b[kept], n[kept]))
        cells = [np.concatenate(x) for x in zip(*found, strict=True)] or [np.zeros(0, np.int64)] * 3
        return pa.table(dict(zip(("a", "b", "users_both"), cells, strict=True)))

    lists = packed_lists(listed.repartition("g").sortWithinPartitions("g", "m"), blocks)
    # Written, as a lost executor would have its blocks met again.
    both = materialize(lists.groupBy("block").applyInArrow(met, "a long, b long, users_both long"), "met")
    product = F.col("_n.n").cast("double") * F.col("_m.n")
    scored = (
        both.join(items.alias("_n"), F.col("a") == F.col("_n.code"))
        .join(items.alias("_m"), F.col("b") == F.col("_m.code"))
        .select(
            F.col("_n.i").alias(roles.item), F.col("_m.i").alias(f"neighbour_{roles.item}"), "users_both",
            F.round(F.col("users_both") / F.sqrt(product), 9).alias("cosine"),
        )
    )
    return _ranked(scored, roles.item, [F.desc("cosine")], ["users_both", "cosine"], top)


def _lists_of_users(touched: DataFrame, shared: int, block: int) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    """Items' lists of users for each block of users, the numbered items and users, and the blocks.

    A list's name is the item's place from rare to frequent and its place by id.
    Users are numbered by the item that heads all but their ``shared`` - 1 most
    frequent ones, so a user skips no less than its later partners would.
    """
    touched = materialize(touched, "touched")
    degree = touched.groupBy("i").agg(F.count(F.lit(1)).alias("n"))
    items = order.positions(order.positions(degree, [F.col("n"), F.col("i")], "_place"), [F.col("i")], "code")
    if items.count() >= 1 << NAME_BITS:
        raise ValueError(f"more than 2^{NAME_BITS} items")
    name = F.shiftleft("_place", NAME_BITS).bitwiseOR(F.col("code"))
    placed = materialize(touched.join(items, "i").select("u", name.alias("g")), "placed")
    tops = placed.groupBy("u").agg(F.max("g").alias("_top"), F.count(F.lit(1)).alias("_n"))
    if shared != 2:
        down = F.sort_array(F.collect_list("g"), asc=False)
        tops = placed.groupBy("u").agg(F.get(down, F.lit(max(0, shared - 2))).alias("_top"), F.count(F.lit(1)).alias("_n"))
    users = order.positions(tops.where(F.col("_n") >= shared).select("u", "_top"), [F.col("_top"), F.col("u")], "m")
    blocks = block_count(placed, "g", users.count(), block)
    rows = placed.join(users.select("u", "m"), "u").select("g", "m")
    lists = packed_lists(rows.repartition("g").sortWithinPartitions("g", "m"), blocks, tails=True)
    return lists, items.select("i", "code"), users.select("u", "m"), blocks


def similar_users(touched: DataFrame, shared: int, block: int = BLOCK_MEMBERS) -> DataFrame:
    """a, b, items: pairs of users with at least ``shared`` items in common, and those items.

    Items are ordered from rare to frequent. Two users with ``shared`` common
    items have one among all but the ``shared`` - 1 most frequent items of each,
    so those are not paired up: of every user the hubs are left out, which
    would make most pairs, and no pair is lost.
    """
    lists, items, users, blocks = _lists_of_users(touched, shared, block)

    def met(table: pa.Table) -> pa.Table:
        found = []
        for a, b, n, names in similar(Lists(table), blocks, shared):
            codes = np.bitwise_and(names, (1 << NAME_BITS) - 1)
            found.append(pa.table({"a": np.repeat(a, n), "b": np.repeat(b, n), "item": codes}))
        return pa.concat_tables(found) if found else NO_ITEMS

    rows = lists.groupBy("block").applyInArrow(met, "a long, b long, item long")
    numbered = rows.join(items, F.col("item") == F.col("code")).groupBy("a", "b")
    pairs = numbered.agg(F.array_sort(F.collect_list("i")).alias("items"))
    x, y = users.select(F.col("m").alias("a"), F.col("u").alias("_u")), users.select(F.col("m").alias("b"), F.col("u").alias("_v"))
    return pairs.join(x, "a").join(y, "b").select(
        F.least("_u", "_v").alias("a"), F.greatest("_u", "_v").alias("b"), "items"
    )


def swing_neighbours(df: DataFrame, roles: Roles, top: int, alpha: int = 1, block: int = BLOCK_MEMBERS) -> DataFrame:
    """Per item its ``top`` items (a top-n report) by the Swing score.

    Each pair of users that touched both items adds 1 / (alpha + the number of
    items the two users share). Ties go to the smaller item. Pairs of users end
    inside their task; what is shuffled is items met, once, by the item they are counted for.
    """
    lists, items, _, blocks = _lists_of_users(_distinct(df, roles), 2, block)

    def met(table: pa.Table) -> pa.Table:
        found = []
        for _, _, n, names in similar(Lists(table), blocks, 2):
            codes = np.bitwise_and(names, (1 << NAME_BITS) - 1)
            size = np.repeat(n, n)
            later = np.repeat(np.cumsum(n), n) - np.arange(len(codes)) - 1
            x, y = np.repeat(codes, later), codes[spread(np.arange(len(codes)) + 1, later)]
            c = np.repeat(size, later)
            found.append(pa.table({"x": np.append(x, y), "y": np.append(y, x), "c": np.append(c, c)}))
        return pa.concat_tables(found) if found else NO_MEETINGS

    pairs = lists.groupBy("block").applyInArrow(met, "x long, y long, c long")
    # Counts by size are exact, so the sum does not depend on the order of rows.
    counted = pairs.repartition(order.parallelism(df), "x").groupBy("x", "y", "c").agg(F.count(F.lit(1)).alias("n"))
    scored = counted.groupBy("x", "y").agg(
        F.sum("n").alias("user_pairs"),
        F.round(F.sum(F.col("n") / (alpha + F.col("c"))), 9).alias("swing"),
    )
    # Numbers are places by id, so ties among them go to the smaller item.
    place = Window.partitionBy("x").orderBy(F.desc("swing"), "y")
    best = scored.withColumn("rank", F.row_number().over(place).cast("bigint")).where(F.col("rank") <= top)
    best = materialize(best, "met")
    return (
        best.join(items.alias("_n"), F.col("x") == F.col("_n.code"))
        .join(items.alias("_m"), F.col("y") == F.col("_m.code"))
        .select(
            F.col("_n.i").alias(roles.item), "rank", F.col("_m.i").alias(f"neighbour_{roles.item}"),
            "user_pairs", "swing",
        )
    )
