"""Connected components of a link table, by alternating large and small stars.

Every round is two aggregations and two joins over the links, each link once; a
hub's rows are aggregated before the shuffle and its join rows may be split by
Spark. Each round's links are written to the shared folder, which cuts the
lineage. The rounds end when all links are stars, which one aggregation over the
nodes tells; only its one row reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logassay.llm.common import stored


def _are_stars(links: DataFrame) -> bool:
    """Whether every upper end has one lower end, and no lower end is an upper one (or there are no links)."""
    ends = links.select(F.col("hi").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionAll(
        links.select(F.col("lo").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not nodes.agg(F.max(F.col("up") + F.when(F.col("up") > 0, F.col("down")).otherwise(0) > 1)).first()[0]


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (smallest node reachable) for every node of columns a, b.

    Nodes can be of any type with an order. Null ends and links of a node to
    itself are left out; repeated links count once; no links, no rows.
    """
    pairs = stored(
        links.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
        .distinct(),
        "links",
    )
    while not _are_stars(pairs):
        both = pairs.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(
            pairs.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
        least = both.groupBy("u").agg(F.least(F.first("u"), F.min("v")).alias("m"))
        # Only a node's larger neighbours move to its least one, so each link is joined once.
        large = pairs.join(least, F.col("lo") == F.col("u")).select("hi", F.col("m").alias("lo"))
        lowest = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = (
            large.join(lowest, "hi")
            .select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
            .unionAll(lowest.select("hi", F.col("m").alias("lo")))
            .where(F.col("hi") != F.col("lo"))
            .distinct()
        )
        pairs = stored(small, "links")
    roots = pairs.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
    return roots.unionAll(pairs.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())


def joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``roots`` (node, root) after further links (a, b): only links between different components count,
    and the components are the nodes they are followed through."""
    root_of = lambda c: roots.select(F.col("node").alias(c), F.col("root").alias(f"r{c}"))
    between = (
        links.join(root_of("a"), "a", "left")
        .join(root_of("b"), "b", "left")
        .select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))
    )
    upper = stored(components(between).select(F.col("node").alias("root"), F.col("root").alias("top")), "upper")
    below = roots.join(upper, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    # Nodes that had no link so far, and roots, which are their own.
    new = upper.join(roots.select(F.col("node").alias("root")), "root", "left_anti")
    return below.unionAll(new.select(F.col("root").alias("node"), F.col("top").alias("root")))
