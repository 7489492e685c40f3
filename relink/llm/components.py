"""Connected components of a link table, in Spark alone: alternating stars, lineage cut in the shared folder each round."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..lineage import cut


def _least(pairs: DataFrame) -> DataFrame:
    """Per node the smallest neighbour. A partial minimum is taken before the shuffle, so a hub costs one row a task; the
    result is cut, so that a join with it shuffles both sides and adaptive execution can split a hub's rows."""
    return cut(pairs.groupBy("a").agg(F.min("b").alias("m")))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = _least(both).select("a", F.least("a", "m").alias("m"))
    return (both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .where("a <> b").distinct())


def _small_star(links: DataFrame) -> DataFrame:
    least = _least(links)  # every link points from its larger to its smaller end
    joined = links.join(least, "a")
    return (joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct())


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in `links` (a, b); component is the smallest node reachable.

    Each round contracts stars onto their least node; the number of rounds grows with the logarithm of a component's size.
    A round's links are checkpointed, and the rounds end when neither their number nor their sums change. Links that are
    null or join a node to itself are left out; no links give no rows.
    """
    now = cut(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = None
    while True:
        sums = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(sums) == state or not sums[0]:
            break
        state = tuple(sums)
        now = cut(_small_star(_large_star(now)))
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
