"""Forests as tables (L6, L8, L12): stored, read back, scored and refreshed.

A forest is a table with a row for each node: ``tree``, ``node`` (0 is the root; numbered
without gaps), ``feature`` (position in the feature array, -1 in a leaf), ``threshold`` (a value
at or below it goes left), ``categories`` (or the values that go left; NULL for a threshold),
``left``, ``right`` (-1 in a leaf), ``gain``, ``stats`` (weight of each class) and ``depth``. Its size
is set by the model's parameters (trees x 2^(depth + 1)), not by the data, so all trees may
travel to every task.

Scoring runs in the JVM (``kernels``): a loop over the trees, in each one down its nodes. Votes are
added up tree by tree, as Spark ML does, so its probabilities come out alike.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize
from .kernels import JvmForest

MAX_NODES = 4_000_000  # of a forest that is sent to the tasks
COLUMNS = ("tree", "node", "feature", "threshold", "categories", "left", "right", "gain", "stats", "depth")


def export_forest(model: PipelineModel, path: str) -> DataFrame:
    """Write the forest of a fitted pipeline to ``path`` with Spark ML's own writer; its nodes."""
    model.stages[-1].write().overwrite().save(path)
    return read_forest(SparkSession.active(), path)


def read_forest(spark: SparkSession, path: str) -> DataFrame:
    """The nodes of a forest that Spark ML wrote to ``path``."""
    n = F.col("nodeData")
    split, leaf = n["split"], n["leftChild"] < 0
    first = F.get(split["leftCategoriesOrThreshold"], F.lit(0))
    nominal = ~leaf & (split["numCategories"] >= 0)
    nodes = spark.read.parquet(f"{path.rstrip('/')}/data").select(
        F.col("treeID").alias("tree"), n["id"].alias("node"), F.when(leaf, -1).otherwise(split["featureIndex"]).alias("feature"),
        F.when(~leaf & ~nominal, first).alias("threshold"),
        F.when(nominal, split["leftCategoriesOrThreshold"]).alias("categories"), n["leftChild"].alias("left"),
        n["rightChild"].alias("right"), F.when(~leaf, n["gain"]).alias("gain"), n["impurityStats"].alias("stats"))
    return with_depth(nodes)


def with_depth(nodes: DataFrame) -> DataFrame:
    """Add each node's distance from the root; a step down for each level."""
    nodes = materialize(nodes)
    level = nodes.filter("node = 0").withColumn("depth", F.lit(0))
    found = [level]
    while True:
        below = level.select("tree", F.explode(F.array("left", "right")).alias("node"), (F.col("depth") + 1).alias("depth"))
        level = materialize(nodes.join(below.filter("node > 0"), ["tree", "node"]))
        if level.isEmpty():
            return reduce(DataFrame.unionByName, found).select(*COLUMNS)
        found.append(level)


def check_forest(nodes: DataFrame) -> int:
    """The depth of the forest; an error if nodes are missing or too many."""
    r = nodes.groupBy("tree").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("a"), F.max("node").alias("b"),
                                  F.max("depth").alias("d"))
    r = r.agg(F.sum("n").alias("n"), F.count_if((F.col("a") != 0) | (F.col("b") != F.col("n") - 1)).alias("bad"),
              F.max("d").alias("d")).first()
    if not r["n"] or r["bad"]:
        raise ValueError("a tree's nodes must be numbered 0, 1, ... without gaps")
    if r["n"] > MAX_NODES:
        raise ValueError(f"more than {MAX_NODES} nodes")
    return r["d"]


def score(df: DataFrame, nodes: DataFrame, features: str, n_classes: int) -> DataFrame:
    """Add ``probability`` (array) and ``prediction`` (position of the largest, the first
    of equals) from the array column ``features``. A missing feature (NULL, NaN) goes right, as
    NaN does in Spark ML."""
    forest = JvmForest.of_table(nodes, check_forest(nodes), n_classes)
    out = df.withColumn("__votes", forest.votes(F.col(features).cast("array<double>")))
    total = F.aggregate("__votes", F.lit(0.0), lambda s, v: s + v)
    out = out.withColumn("probability", F.transform("__votes", lambda v: F.try_divide(v, total)))
    best = F.array_position("__votes", F.array_max("__votes")) - 1
    return out.withColumn("prediction", best.cast("double")).drop("__votes")


def leaves(df: DataFrame, nodes: DataFrame, features: str) -> DataFrame:
    """Add ``leaves``: for each tree the node that the row ends in."""
    forest = JvmForest.of_table(nodes, check_forest(nodes))
    return df.withColumn("leaves", forest.leaves(F.col(features).cast("array<double>")))


def ancestors(nodes: DataFrame) -> DataFrame:
    """``(tree, leaf, node)``: every leaf with itself and all nodes above it."""
    edges = materialize(nodes.filter("left > 0").select("tree", F.col("node").alias("__up"), F.explode(F.array("left", "right")).alias("node")))
    level = nodes.filter("left < 0").select("tree", F.col("node").alias("leaf"), "node")
    found = [level]
    while True:
        level = materialize(level.join(edges, ["tree", "node"]).select("tree", "leaf", F.col("__up").alias("node")))
        if level.isEmpty():
            return reduce(DataFrame.unionByName, found)
        found.append(level)


def refresh(nodes: DataFrame, df: DataFrame, features: str, label: str, n_classes: int, weight: str | None = None) -> DataFrame:
    """The same splits with ``stats`` and ``gain`` (Gini) of the rows of ``df``; ``label`` is a class
    position. Rows are counted by leaf, in the scan's own stage, and leaves added up to the nodes above."""
    w = F.col(weight) if weight else F.lit(1.0)
    number = F.posexplode("leaves").alias("__at", "leaf")
    ends = leaves(df, nodes, features).select(F.col(label).cast("int").alias("__c"), w.cast("double").alias("__w"), number)
    counts = ends.groupBy("__at", "leaf").agg(*[F.sum(F.when(F.col("__c") == c, F.col("__w")).otherwise(0.0)).alias(f"__{c}")
                                                for c in range(n_classes)])
    # trees are numbered by their place in the array
    order = Window.orderBy("tree")
    places = nodes.select("tree").distinct().select("tree", (F.row_number().over(order) - 1).alias("__at"))
    above = ancestors(nodes).join(F.broadcast(places), "tree")
    sums = above.join(counts, ["__at", "leaf"], "left").groupBy("tree", "node").agg(
        *[F.coalesce(F.sum(f"__{c}"), F.lit(0.0)).alias(f"__{c}") for c in range(n_classes)])
    stats = F.array(*[F.col(f"__{c}") for c in range(n_classes)])
    fresh = materialize(nodes.drop("stats", "gain").join(sums.select("tree", "node", stats.alias("stats")), ["tree", "node"]))
    side = {s: fresh.select("tree", F.col("node").alias(s), F.col("stats").alias(f"__{s}")) for s in ("left", "right")}
    both = fresh.join(side["left"], ["tree", "left"], "left").join(side["right"], ["tree", "right"], "left")
    n = {c: _total(F.col(c)) for c in ("stats", "__left", "__right")}
    lost = _impure(F.col("stats")) - _impure(F.col("__left")) - _impure(F.col("__right"))
    gain = F.when(F.col("left") > 0, F.coalesce(F.try_divide(lost, n["stats"]), F.lit(0.0)))
    return both.withColumn("gain", gain).select(*COLUMNS)


def _total(stats: Column) -> Column:
    return F.aggregate(stats, F.lit(0.0), lambda s, x: s + x)


def _impure(stats: Column) -> Column:
    """n times the Gini impurity: n - sum of squares / n."""
    n = _total(stats)
    return n - F.coalesce(F.try_divide(F.aggregate(stats, F.lit(0.0), lambda s, x: s + x * x), n), F.lit(0.0))


def importance(nodes: DataFrame, names: Sequence[str]) -> DataFrame:
    """``(feature, importance)`` of every name: the weighted gains of the splits on it, as a
    share of their tree's, averaged over the trees that split at all."""
    inner = nodes.filter("feature >= 0").groupBy("tree", "feature").agg(F.sum(F.col("gain") * _total(F.col("stats"))).alias("g"))
    share = inner.withColumn("s", F.try_divide("g", F.sum("g").over(Window.partitionBy("tree"))))
    by = share.groupBy("feature").agg(F.sum("s").alias("s"))
    whole = by.withColumn("importance", F.try_divide("s", F.sum("s").over(Window.partitionBy(F.lit(1)))))
    every = nodes.sparkSession.createDataFrame([(i, n) for i, n in enumerate(names)], "at int, name string")
    return (every.join(whole, F.col("at") == F.col("feature"), "left")
            .select(F.col("name").alias("feature"), F.coalesce("importance", F.lit(0.0)).alias("importance")))
