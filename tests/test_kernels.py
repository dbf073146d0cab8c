"""The forests' loops on the JVM against numpy and row by row."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from riskweave.operators import forest as fr
from riskweave.operators import growing as gr
from riskweave.operators import kernels

SCHEMA = ("tree int, node int, feature int, threshold double, categories array<double>, left int, right int, gain double, "
          "stats array<double>, depth int")


def _full_trees(trees, depth, features, k, rng):
    """Complete trees, children of node i at 2 i + 1 and 2 i + 2."""
    inner, rows = 2 ** depth - 1, []
    for t in range(trees):
        for n in range(2 * inner + 1):
            split = n < inner
            rows.append((t, n, int(rng.integers(features)) if split else -1, float(rng.normal()) if split else None,
                         None, 2 * n + 1 if split else -1, 2 * n + 2 if split else -1, None,
                         None if split else [float(v) for v in rng.integers(0, 9, k)], int(np.log2(n + 1))))
    return rows


def test_counts_equal_numpys(spark):
    """Packs of several sizes and numbers beyond 32 bits, a whole tree, nodes that became leaves and a tree that is done."""
    rng, k, features = np.random.default_rng(4), 3, 6
    bins = np.array([8, 20, 2, 64, 5, 85])
    numbers = [0, 1, (3 << 32) + 5, 2 ** 32 - 1]
    packs = [(p, np.stack([rng.integers(0, b, n) * k + rng.integers(0, k, n) for b in bins], axis=1).astype("u1"))
             for p, n in zip(numbers, (1000, 1, 16384, 4097))]
    trees = []
    for _ in range(3):
        levels, open_nodes = [], 1
        for at in range(7):
            drawn = np.sort(rng.random((open_nodes, features)).argsort(1)[:, :3], axis=1)
            level = gr.Level(drawn, bins, k)
            levels.append(level)
            if at == 6:
                break
            level.feature = drawn[np.arange(open_nodes), rng.integers(0, 3, open_nodes)]
            level.last = (rng.random(open_nodes) * bins[level.feature]).astype(int) * k + k - 1
            level.below = np.full((open_nodes, 2), -1)
            goes_on = rng.random((open_nodes, 2)) < 0.8
            goes_on[0, 0] = True
            level.below[goes_on] = np.arange(goes_on.sum())
            open_nodes = int(goes_on.sum())
        trees.append(levels)
    trees.append([gr.Level(np.array([[1, 4]]), bins, k)])
    trees[1][-1].feature = np.zeros(1)  # no open nodes
    for seed in (42, -7, 2 ** 40):
        batch = pa.RecordBatch.from_pydict({"pack": pa.array(numbers, pa.int64()), "cells": pa.array([c.tobytes() for _, c in packs], pa.binary())})
        want = {(t, b): c for out in gr._counter(trees, features, seed, "u1")(iter([batch]))
                for t, b, c in zip(*(out.column(i).to_pylist() for i in range(3)))}
        df = spark.createDataFrame([(p, bytearray(c.tobytes())) for p, c in packs], "pack long, cells binary").coalesce(1)
        out = kernels.count_packs(df, features, gr.NODE_BLOCK, seed, gr.bag_table(), [gr._walked(t) for t in trees]).collect()
        assert {(r["tree"], r["block"]): bytes(r["counts"]) for r in out} == want and len(out) == len(want) > 2
        assert {t for t, _ in want} == {0, 2, 3}


def test_one_forest_whether_counted_in_numpy_or_on_the_jvm(spark, monkeypatch):
    from test_growing import _forest, _frame, _rows
    df = _frame(spark, *_rows())
    one = gr.grow_forest(df, _forest()).toDebugString.split("\n")[1:]
    monkeypatch.setattr(gr, "count_packs", lambda packs, n, block, seed, bags, trees: pytest.fail("counted on the JVM"))
    monkeypatch.setattr(gr, "BYTE_CELLS", 1)
    assert gr.grow_forest(df, _forest()).toDebugString.split("\n")[1:] == one


def test_a_large_forest_is_walked_by_compiled_code(spark):
    """Trees were folded by expressions that Spark does not compile: 3.6 ms a row of 300 trees (F1)."""
    rng, k, features = np.random.default_rng(8), 3, 18
    rows = _full_trees(100, 8, features, k, rng)
    nodes = spark.createDataFrame(rows, SCHEMA).cache()
    df = spark.range(200).select("id", F.array(*[F.rand(i) * 4 - 2 for i in range(features)]).alias("x")).localCheckpoint()
    scored = fr.score(df, nodes, "x", k)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "UDF(" in plan and "threshold" not in plan and "Subquery" not in plan
    tree = {(r[0], r[1]): r for r in rows}
    for r in scored.collect():
        votes = np.zeros(k)
        for t in range(100):
            at = 0
            while tree[t, at][5] >= 0:
                at = tree[t, at][5 if r["x"][tree[t, at][2]] <= tree[t, at][3] else 6]
            stats = np.array(tree[t, at][8])
            votes += stats / stats.sum() if stats.sum() else 0.0
        assert r["probability"] == pytest.approx((votes / votes.sum()).tolist()) and r["prediction"] == votes.argmax()


def test_missing_rows_and_weights(spark):
    """No features: right all the way. A leaf without weights gives NULL; a class that it lacks, or one too many, has no votes."""
    def votes(stats, x, k=2):
        nodes = spark.createDataFrame([(0, 0, 0, 1.0, None, 1, 2, 0.5, None, 0), (0, 1, -1, None, None, -1, -1, None, stats, 1),
                                       (0, 2, -1, None, None, -1, -1, None, [1.0, 3.0], 1)], SCHEMA)
        r = fr.score(spark.createDataFrame([(x,)], "x array<double>"), nodes, "x", k).first()
        return r["probability"], r["prediction"]

    assert votes([3.0, 1.0], [0.5]) == ([0.75, 0.25], 0.0)
    assert votes([3.0, 1.0], None) == votes([3.0, 1.0], []) == votes([3.0, 1.0], [None]) == ([0.25, 0.75], 1.0)
    assert votes(None, [0.5]) == (None, None) and votes(None, [1.5]) == ([0.25, 0.75], 1.0)
    assert votes([3.0], [0.5]) == ([1.0, 0.0], 0.0)
    assert votes([3.0, 1.0], [0.5], 3) == ([0.75, 0.25, 0.0], 0.0)
    assert votes([1.0, 1.0, 2.0], [0.5]) == ([0.5, 0.5, 0.0], 0.0)


def test_leaves_of_categories_and_thresholds(spark):
    nodes = spark.createDataFrame([
        (4, 0, 1, None, [0.0, 2.0], 1, 2, 0.5, [1.0], 0), (4, 1, -1, None, None, -1, -1, None, [1.0], 1), (4, 2, -1, None, None, -1, -1, None, [1.0], 1),
        (9, 0, 0, 0.5, None, 1, 4, 0.5, [1.0], 0), (9, 1, 1, None, [1.0], 2, 3, 0.5, [1.0], 1), (9, 2, -1, None, None, -1, -1, None, [1.0], 2),
        (9, 3, -1, None, None, -1, -1, None, [1.0], 2), (9, 4, -1, None, None, -1, -1, None, [1.0], 1)], SCHEMA)
    rows = [([0.5, 2.0], [1, 3]), ([0.4, 1.0], [2, 2]), ([0.6, 0.0], [1, 4]), ([float("nan"), 1.0], [2, 4]), ([0.1, None], [2, 3])]
    df = spark.createDataFrame(rows, "x array<double>, want array<int>")
    assert all(r["leaves"] == r["want"] for r in fr.leaves(df, nodes, "x").collect())
