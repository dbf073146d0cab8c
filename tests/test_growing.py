"""Forests grown from packed counts, against brute force and Spark ML's own training."""

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from riskweave.operators import forest as fr
from riskweave.operators import growing as gr
from riskweave.operators import model as ml

ROWS = 400


def _rows(n=ROWS):
    rng = np.random.default_rng(5)
    x, z = rng.normal(size=n).round(2), rng.integers(0, 4, n).astype(float)
    y = np.where(x + 0.3 * z > 0.8, 2.0, np.where(z > 2, 1.0, 0.0))
    return x, z, np.where(rng.random(n) < 0.1, 0.0, y)


def _frame(spark, x, z, y, weights=(1.0, 2.5, 0.5)):
    rows = [(float(a), float(b), float(c), weights[int(c)]) for a, b, c in zip(x, z, y)]
    df = spark.createDataFrame(rows, "x double, z double, y double, w double").coalesce(1)
    return VectorAssembler(inputCols=["x", "z"], outputCol="features", handleInvalid="keep").transform(df)


def _forest(**kw):
    return RandomForestClassifier(labelCol="y", weightCol="w", featuresCol="features",
                                  **{"numTrees": 3, "maxDepth": 4, "seed": 9, "maxBins": 16} | kw)


def _gini(n):
    return 1 - (n * n).sum() / n.sum() ** 2


def test_each_split_is_the_best_of_its_rows(spark, tmp_path):
    x, z, y = _rows()
    forest = _forest()
    model = gr.grow_forest(_frame(spark, x, z, y), forest)
    model.write().overwrite().save(str(tmp_path / "f"))
    nodes = {(r["tree"], r["node"]): r for r in fr.read_forest(spark, str(tmp_path / "f")).collect()}
    weights, values = np.array([1.0, 2.5, 0.5]), np.stack([x, z])
    shares = np.arange(1, gr.SKETCH) / gr.SKETCH
    cuts = [gr.thresholds(np.quantile(v, shares, method="inverted_cdf"), 16) for v in values]
    assert len(cuts[1]) == 3 and len(cuts[0]) == 15
    for t in range(3):
        taken = gr.bag(gr.bag_table(), 9, t, 0, ROWS)

        def count(rows, taken=taken):
            return np.array([taken[rows & (y == c)].sum() for c in range(3)]) * weights

        def check(node, rows, depth, t=t, count=count):
            r = nodes[t, node]
            assert r["stats"] == pytest.approx(count(rows)) and depth <= 4
            if r["left"] < 0:
                return 1
            gains = {}
            for f in (0, 1):  # two features: a node draws both
                for c in cuts[f]:
                    left, right = count(rows & (values[f] <= c)), count(rows & (values[f] > c))
                    if left.sum() and right.sum():
                        n = left.sum() + right.sum()
                        gains[f, c] = _gini(left + right) - left.sum() / n * _gini(left) - right.sum() / n * _gini(right)
            assert r["gain"] == pytest.approx(max(gains.values()))
            assert r["gain"] == pytest.approx(gains[r["feature"], r["threshold"]])
            goes = values[r["feature"]] <= r["threshold"]
            return check(r["left"], rows & goes, depth + 1) + check(r["right"], rows & ~goes, depth + 1)

        assert check(0, np.ones(ROWS, bool), 0) > 2


def test_as_good_as_spark_ml_and_the_same_again(spark):
    x, z, y = _rows(3000)
    df = _frame(spark, x, z, y)
    forest = _forest(numTrees=20, maxDepth=5)
    ours, again, theirs = gr.grow_forest(df, forest), gr.grow_forest(df, forest), forest.fit(df)
    right = [m.transform(df).filter("prediction = y").count() for m in (ours, theirs)]
    assert abs(right[0] - right[1]) < 60
    assert ours.featureImportances.toArray() == pytest.approx(theirs.featureImportances.toArray(), abs=0.1)
    assert ours.toDebugString.split("\n")[1:] == again.toDebugString.split("\n")[1:]
    assert ours.getNumTrees == 20 and ours.numClasses == 3 and ours.numFeatures == 2


def test_packs_counted_together_or_apart_give_one_forest(spark, monkeypatch):
    x, z, y = _rows()
    df = _frame(spark, x, z, y)
    monkeypatch.setattr(gr, "PACK_ROWS", 64)
    one = gr.grow_forest(df, _forest()).toDebugString.split("\n")[1:]
    monkeypatch.setattr(gr, "BLOCK_ROWS", 64)
    monkeypatch.setattr(gr, "NODE_BLOCK", 1)
    assert gr.grow_forest(df, _forest()).toDebugString.split("\n")[1:] == one


def test_training_holds_no_rows_on_executors(spark):
    """Spark ML's training kept 300 counts and 300 node numbers a row in memory."""
    x, z, y = _rows()
    seen = spark.sparkContext._jsc.sc().getPersistentRDDs().size()
    model = ml._fit([], _frame(spark, x, z, y).coalesce(1), _forest())
    assert spark.sparkContext._jsc.sc().getPersistentRDDs().size() == seen
    assert not model.stages[-1].getCacheNodeIds()


def test_bags_are_poisson_counts():
    table = gr.bag_table()
    share = np.bincount(table, minlength=4) / len(table)
    assert share[:4] == pytest.approx(np.exp(-1) / np.array([1, 1, 2, 6]), abs=1e-4) and table.mean() == pytest.approx(1, abs=1e-3)


def test_one_class_constant_features_and_faults(spark):
    n = 30
    same = gr.grow_forest(_frame(spark, np.zeros(n), np.ones(n), np.arange(n) % 3), _forest())
    assert same.totalNumNodes == 3
    alone = gr.grow_forest(_frame(spark, np.arange(n), np.ones(n), np.zeros(n)), _forest())
    assert alone.totalNumNodes == 3 and alone.numClasses == 2
    df = _frame(spark, *_rows())
    with pytest.raises(ValueError, match="number of its class"):
        gr.grow_forest(df.filter("false"), _forest())
    with pytest.raises(ValueError, match="number of its class"):
        gr.grow_forest(df.withColumn("y", F.expr("nullif(y, 1)")), _forest())
    with pytest.raises(ValueError, match="NaN or infinite"):
        gr.grow_forest(_frame(spark, np.array([1.0, float("nan")]), np.ones(2), np.zeros(2)), _forest())
    with pytest.raises(ValueError, match="equal within a class"):
        gr.grow_forest(df.withColumn("w", F.col("x")), _forest())


def test_a_task_counts_in_place_by_small_blocks(monkeypatch):
    """Counting made new arrays of all counts and of 2^18 rows for each feature drawn."""
    import tracemalloc

    import pyarrow as pa

    n, k, rng = 200_000, 3, np.random.default_rng(2)
    x, y = rng.integers(0, 8, (n, 4)).astype(float), rng.integers(0, k, n)
    cuts, bins = [np.arange(7) + 0.5] * 4, np.full(4, 8)
    monkeypatch.setattr(gr, "TaskContext", type("Task", (), {"get": lambda: type("One", (), {"partitionId": lambda _: 1})()}))
    rows = pa.RecordBatch.from_pydict({"x": pa.array(list(x)), "y": pa.array(y.astype(float))})
    packs = list(gr._packer(cuts, k, "u1")(iter([rows])))
    root, leaf = gr.Level(np.array([[1, 2]]), bins, k), -1
    root.feature, root.last, root.below = np.array([1]), np.array([3 * k + k - 1]), np.array([[leaf, 0]])
    below = gr.Level(np.array([[0, 3]]), bins, k)
    tracemalloc.start()
    out = list(gr._counter([[root, below]], 4, 9, "u1")(iter(packs)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    found = np.frombuffer(out[0].column(2)[0].as_py(), np.uint32).reshape(2, 8, k)
    taken = np.concatenate([gr.bag(gr.bag_table(), 9, 0, (1 << 32) + i, min(gr.PACK_ROWS, n - a))
                            for i, a in enumerate(range(0, n, gr.PACK_ROWS))])
    right = x[:, 1] > 3.5
    for place, f in enumerate((0, 3)):
        want = np.zeros((8, k), int)
        np.add.at(want, (x[right, f].astype(int), y[right]), taken[right])
        assert (found[place] == want).all()
    assert peak < 3 << 20
