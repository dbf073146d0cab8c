"""Frequent itemsets of any length, level by level (M3).

A basket is kept with the itemsets of the last level that it holds. The next level's
candidates grow from the frequent itemsets of this one: two that differ in their last
item alone are joined, and a candidate with an infrequent subset is dropped before
anything is counted. Candidates hang under their prefix, as children of a node of the
prefix tree, and a basket looks only under the nodes that it has reached: one join of
baskets and nodes, one filter on the basket's items, one count that collapses in the
stage of the join. Beside a node a basket keeps only its items behind the node's last one, as no
others can follow, and what the longest itemsets reach is counted without being kept.

Sizes: equal baskets are one row. At most ``C(w, k) / min_support`` itemsets of k items are
frequent, for baskets of w items on average (their supports add up to that); the level
that is sent to the tasks is counted first, and joined by a shuffle if it is larger than
``SENT_NODES``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

SENT_NODES = 200_000  # prefix nodes that go to every task; more are joined by a shuffle


def _behind(item: str) -> Column:
    """The basket's items after ``item``."""
    return F.filter("items", lambda x: x > F.col(item)).alias("items")


def _grown(level: DataFrame, size: int) -> DataFrame:
    """``(prefix, item, node)``: the candidates of ``size`` items under each frequent itemset
    of one item less, all of whose subsets are frequent; ``node`` numbers them."""
    a = level.select("node", "itemset", F.slice("itemset", 1, size - 2).alias("head"), F.element_at("itemset", -1).alias("last"))
    b = a.select("head", F.col("last").alias("item"))
    pairs = a.join(b, "head").filter(F.col("item") > F.col("last")).select(
        F.col("node").alias("prefix"), "item", F.concat("itemset", F.array("item")).alias("itemset"))
    if size > 2:
        # every subset without one item must be frequent; the two that were joined are
        places = F.sequence(F.lit(0), F.lit(size - 3))
        subset = F.filter("itemset", lambda x, i: i != F.col("drop"))
        lacking = (pairs.select("itemset", F.explode(places).alias("drop")).select("itemset", subset.alias("part"))
                   .join(level.select(F.col("itemset").alias("part")), "part", "left_anti").select("itemset"))
        pairs = pairs.join(lacking, "itemset", "left_anti")
    return materialize(pairs.withColumn("node", F.monotonically_increasing_id()))


def frequent_by_level(baskets: DataFrame, min_support: float, max_len: int | None = None, items: str = "items",
                      n: Column | None = None) -> DataFrame:
    """``(itemset ARRAY sorted, size, count)`` of all itemsets of up to ``max_len`` items (any
    number, if None) in at least ``min_support`` of the baskets. An item counts once in a
    basket; a null or empty basket counts as one without items."""
    if max_len is not None and max_len < 1:
        raise ValueError("max_len must be 1 or more")
    n = n if n is not None else baskets.select(F.count(F.lit(1))).scalar()
    enough = F.col("count") / n >= F.lit(float(min_support))
    known = F.array_sort(F.array_distinct(F.filter(items, lambda x: x.isNotNull())))
    distinct = materialize(baskets.filter(F.col(items).isNotNull()).groupBy(known.alias("items"))
                           .agg(F.count(F.lit(1)).alias("times")))
    single = (distinct.select(F.explode("items").alias("item"), "times").groupBy("item")
              .agg(F.sum("times").alias("count")).filter(enough))
    level = materialize(single.select(F.array("item").alias("itemset"), "count", F.monotonically_increasing_id().alias("node")))
    found = [level.select("itemset", F.lit(1).alias("size"), "count")]
    # baskets at the nodes that they have reached, with the items behind these
    reached = distinct.select("items", "times", F.explode("items").alias("item")).join(
        level.select(F.col("itemset")[0].alias("item"), "node"), "item").select(_behind("item"), "times", "node")
    size = 1
    while (max_len is None or size < max_len) and not level.isEmpty():
        size += 1
        grown = _grown(level, size)
        children = grown.groupBy("prefix").agg(F.collect_list(F.struct("item", "node")).alias("children"))
        nodes = children.count()
        if not nodes:
            break
        children = F.broadcast(children) if nodes <= SENT_NODES else children
        reached = reached.join(children, F.col("node") == F.col("prefix")).select(
            "items", "times", F.explode(F.filter("children", lambda c: F.array_contains("items", c["item"]))).alias("child"))
        reached = reached.select(_behind("child.item"), "times", F.col("child.node").alias("node"))
        if size != max_len:
            reached = materialize(reached)  # counted, and read again for the next level
        counts = reached.groupBy("node").agg(F.sum("times").alias("count")).filter(enough)
        level = materialize(grown.join(counts, "node").select("itemset", "count", "node"))
        found.append(level.select("itemset", F.lit(size).alias("size"), "count"))
        kept = level.select("node")
        reached = reached.join(F.broadcast(kept) if nodes <= SENT_NODES else kept, "node", "left_semi")
    return reduce(DataFrame.unionByName, found)
