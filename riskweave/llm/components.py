"""Connected components of a link table, by alternating large-star and small-star
rounds (Kiveris et al. 2014). Each round is joins and sums on the link table, cut
with a checkpoint; only two numbers a round reach the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed


def _smallest(links: DataFrame) -> DataFrame:
    """The smallest neighbour of each node. A checkpoint, so that the join that
    follows reads both sides from an exchange and AQE can split a hot node."""
    return checkpointed(links.groupBy("u").agg(F.min("v").alias("m")))


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links(a, b)``: root is the smallest node
    reachable. Self-links and repeats are ignored; no links, no rows."""
    a, b = F.col("a"), F.col("b")
    e = checkpointed(links.filter(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    state = _state(e)
    while True:
        # large star: each larger neighbour moves to the smallest of the neighbourhood
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = checkpointed(
            both.join(_smallest(both), "u").filter(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct())
        # small star: each smaller neighbour, and the node, move to the smallest one
        least = _smallest(large)
        moved = large.join(least, "u").filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = checkpointed(moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        if (now := _state(e)) == state:
            break
        state = now
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
