"""The inner loops of forests on the JVM, for what neither an expression nor numpy does fast.

``Forests.java`` lies beside this file. It is compiled once a session by the compiler that Spark
itself uses for its generated code, and goes to the executors as a jar, as any added jar does.
"""

from __future__ import annotations

import io
import os
import uuid
import zipfile

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_LOADED: dict = {}


def _kernels(spark: SparkSession):
    from ..sources.order_risk import session_key
    key = session_key(spark)
    if key not in _LOADED:
        with open(os.path.join(os.path.dirname(__file__), "Forests.java"), encoding="utf-8") as f:
            source = f.read()
        jvm, sc = spark._jvm, spark.sparkContext
        compiler = jvm.org.codehaus.janino.SimpleCompiler()
        compiler.setParentClassLoader(jvm.java.lang.Thread.currentThread().getContextClassLoader())
        compiler.cook(source)
        jar = io.BytesIO()
        with zipfile.ZipFile(jar, "w") as z:
            for name, code in compiler.getBytecodes().items():
                z.writestr(f"{name.replace('.', '/')}.class", bytes(code))
        path = os.path.join(sc._temp_dir, f"riskweave-{uuid.uuid4().hex}.jar")  # goes with the session
        with open(path, "wb") as f:
            f.write(jar.getvalue())
        spark.sql(f"ADD JAR '{path}'")
        loader = spark._jsparkSession.sharedState().jarClassLoader()
        _LOADED.clear()
        _LOADED[key] = jvm.java.lang.Class.forName("riskweave.Forests", True, loader).newInstance()
    return _LOADED[key]


class JvmForest:
    """A forest that the JVM walks; ``votes`` and ``leaves`` of a column of feature arrays or vectors."""

    def __init__(self, spark: SparkSession, forest):
        self._kernels, self._forest = _kernels(spark), forest

    @classmethod
    def of_model(cls, spark: SparkSession, model) -> JvmForest:
        """From a fitted Spark ML forest."""
        return cls(spark, _kernels(spark).forest(model._java_obj))

    @classmethod
    def of_table(cls, nodes: DataFrame, depth: int, n_classes: int = 0) -> JvmForest:
        """From the table of nodes (``forest``), where a node's place is its number; without classes it has no votes."""
        stats, none = F.col("stats"), F.array_repeat(F.lit(0.0), n_classes)
        total = F.aggregate(stats, F.lit(0.0), lambda s, x: s + x)
        share = F.when(total > 0, F.transform(stats, lambda x: x / total)).otherwise(F.transform(stats, lambda x: F.lit(0.0)))
        share = F.when(F.col("left") >= 0, none).otherwise(share) if n_classes else none
        t = nodes.select("tree", "node", "feature", F.col("threshold").cast("double").alias("threshold"), "left", "right",
                         F.col("categories").cast("array<double>").alias("categories"), share.alias("share"))
        t = t.toArrow().sort_by([("tree", "ascending"), ("node", "ascending")])
        c = {name: t[name].combine_chunks() for name in t.column_names}
        length = np.diff(c["share"].offsets)
        width = max(n_classes, int(length.max()))
        shares = np.zeros((len(t), width))
        shares[np.arange(width) < length[:, None]] = np.nan_to_num(c["share"].flatten().to_numpy(zero_copy_only=False))
        shares[:, n_classes:] = 0.0  # no class of these
        node = {name: c[name].to_numpy() for name in ("node", "feature", "left", "right")}
        first = np.flatnonzero(node["node"] == 0)
        root = np.repeat(first, np.diff(np.r_[first, len(t)]))
        nominal = c["categories"].is_valid().to_numpy(zero_copy_only=False)
        feature = np.where(c["share"].is_valid().to_numpy(zero_copy_only=False), node["feature"], -2)
        table = np.column_stack([feature, *[np.where(node[s] < 0, -1, node[s] + root) for s in ("left", "right")],
                                 np.where(nominal, nominal.cumsum() - 1, -1)])
        parts = ((first, "<i4"), (table, "<i4"), (c["threshold"].to_numpy(zero_copy_only=False), "<f8"),
                 (shares, "<f8"), (np.diff(c["categories"].offsets)[nominal], "<i4"),
                 (c["categories"].flatten().to_numpy(zero_copy_only=False), "<f8"))
        spark = nodes.sparkSession
        return cls(spark, _kernels(spark).forest(width, max(depth, 1), *[np.ascontiguousarray(v, kind).tobytes() for v, kind in parts]))

    def votes(self, features: Column) -> Column:
        """The classes' shares in the leaves, added up tree by tree."""
        return _column(self._kernels.votes(self._forest, features._jc))

    def leaves(self, features: Column) -> Column:
        """For each tree the number of the node where the row ends."""
        return _column(self._kernels.leaves(self._forest, features._jc))


def _column(jc) -> Column:
    from pyspark.sql.classic.column import Column as Classic
    return Classic(jc)


def count_packs(packs: DataFrame, n_features: int, node_block: int, seed: int, bags: np.ndarray, trees: list[tuple | None]) -> DataFrame:
    """Packs ``(pack, cells)`` of a byte a feature to counts ``(tree, block, counts)`` of the open nodes. A tree is ``(above, steps,
    drawn, starts, size)``: the nodes above (feature, last cell that goes left, left, right; -1: a leaf), level by level, and how many
    levels; then of each open node, whose numbers follow on, the features drawn and the places of their counts among ``size``."""
    from pyspark.sql.classic.dataframe import DataFrame as Classic
    parts = []
    for tree in trees:
        if tree is None:
            parts.append([0] * 5)
            continue
        above, steps, drawn, starts, size = tree
        parts += [[len(above), *drawn.shape, steps, size], above.ravel(), np.stack([drawn, starts], axis=2).ravel()]
    spark, flat = packs.sparkSession, np.concatenate(parts).astype("<i4").tobytes()
    return Classic(_kernels(spark).counts(packs._jdf, n_features, node_block, seed, bags.tobytes(), flat), spark)
