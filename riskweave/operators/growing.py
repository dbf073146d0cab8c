"""Growing a random forest level by level (L5, L7), for every tree at once.

The rows are binned once: a byte a feature (bin and class in one number), kept in packs of
``PACK_ROWS`` rows as Parquet in the shared folder. A level is one job over the packs. A task
draws each tree's bag again (from the seed, the tree and the pack's number, so a repeated task
draws the same), walks the bag down the splits known so far and counts bins and classes at
the level's nodes; the counts of all tasks are exchanged by tree and block of nodes, and the best
split of each node is found where they meet. Only splits travel to the driver. What a task holds
is a tree's counts and a pack's (in numpy ``BLOCK_ROWS`` rows') working arrays, beside its packs; these
arrays are small enough for a core's cache, and counts are added in place. Cells of one byte are
counted by a loop in the JVM (``kernels``), wider ones in numpy.

The rules are those of Spark ML's forests: bags are Poisson(1) counts (here to 1/65536), a node
draws its own features, candidate thresholds are fixed for the whole forest (midpoints
of all values, or of about ``max_bins`` equal shares), Gini gain on weighted counts, a node with one class or
without a gain is a leaf, and two sibling leaves of one class are merged. Counts are whole
numbers, so a sum does not depend on the order of its parts. The result is a Spark ML model.

Defined cases: weights must be equal within a class; no rows, a missing label, or a feature
that is missing or infinite is an error, as it is to Spark ML.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.quantile import fractions_array
from ..session import ensure_checkpoint_dir
from .kernels import count_packs

PACK_ROWS = 1 << 14  # rows drawn together, the unit that moves
BLOCK_ROWS = 1 << 14  # rows counted together: whole packs, until there are as many
BYTE_CELLS = 256  # bins x classes that a byte tells apart
NODE_BLOCK = 64  # nodes of a tree whose counts meet in one row
SKETCH = 10_000  # equal shares of a feature that thresholds are chosen from
EPSILON = 2.0 ** -52


def thresholds(values: np.ndarray, max_bins: int) -> np.ndarray:
    """Candidate thresholds from equal shares of a feature: between all its values, or at
    steps of about equal weight if it has more than ``max_bins``."""
    v, n = np.unique(values, return_counts=True)
    middle = v[:-1] / 2 + v[1:] / 2
    if len(v) <= max_bins:
        return middle
    step = n.sum() / max_bins
    seen, goal, out = n[0], step, []
    for i in range(1, len(v)):
        if abs(seen - goal) < abs(seen + n[i] - goal):
            out.append(middle[i - 1])
            goal += step
        seen += n[i]
    return np.array(out[:max_bins - 1])


def bag_table() -> np.ndarray:
    """Poisson(1) counts by a 16-bit draw."""
    p = np.exp(-1.0) * np.cumprod(np.r_[1.0, 1.0 / np.arange(1, 12)])
    return np.searchsorted(np.cumsum(p) * 65536, np.arange(65536) + 0.5).astype(np.uint8)


def bag(table: np.ndarray, seed: int, tree: int, pack: int, rows: int) -> np.ndarray:
    """How often a tree takes each row of a pack."""
    draw = np.random.SFC64([seed & (2 ** 64 - 1), tree, pack])
    return table.take(draw.random_raw(-(-rows // 4)).astype("<u8", copy=False).view("<u2")[:rows])


def _packer(cuts: list[np.ndarray], n_classes: int, kind: str):
    """Rows ``(x, y)`` to packs: ``cells`` holds, row by row, bin * classes + class of each feature."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, k = TaskContext.get().partitionId() << 32, 0
        for b in batches:
            y = b.column(1).to_numpy(zero_copy_only=False)
            x = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(len(y), len(cuts))
            for a in range(0, len(y), PACK_ROWS):
                part, label = x[a:a + PACK_ROWS], y[a:a + PACK_ROWS].astype(np.int64)
                cells = np.stack([np.searchsorted(c, part[:, f], "left") * n_classes + label for f, c in enumerate(cuts)], axis=1)
                yield pa.RecordBatch.from_pydict({"pack": pa.array([first + k], pa.int64()),
                                                  "cells": pa.array([cells.astype(kind).tobytes()], pa.binary())})
                k += 1
    return pack


class Level:
    """The nodes of one tree at one depth that are not leaves for certain: the features each draws,
    and, once split, feature, last cell that goes left and the children's places below (-1: a leaf)."""

    def __init__(self, drawn: np.ndarray, bins: np.ndarray, n_classes: int):
        self.drawn = drawn
        size = bins[drawn] * n_classes
        self.ends = np.cumsum(size.ravel())
        self.starts = (self.ends - size.ravel()).reshape(drawn.shape)  # of a (node, feature)'s counts
        self.feature = self.last = self.below = None

    def step(self, cells: int, times: int) -> tuple[np.ndarray, np.ndarray]:
        """Feature by ``node * cells``, and the place below, so many ``times``, by ``node * cells + cell``;
        what has come to a leaf is at the place after the last node."""
        end, m = self.below.max() + 1, len(self.below)
        feature = np.zeros((m + 1, cells), np.int64)
        feature[:m, 0] = self.feature
        below = np.append(np.where(self.below < 0, end, self.below), [[end, end]], axis=0) * times
        right = np.arange(cells) > np.append(self.last, 0)[:, None]
        return feature.ravel(), np.where(right, below[:, 1:], below[:, :1]).ravel()


def _walked(levels: list[Level]) -> tuple | None:
    """A tree as ``count_packs`` takes it; None if it has no open nodes."""
    *done, last = levels
    if last.feature is not None:
        return None
    first = np.cumsum([0] + [len(above.below) for above in done])
    above = [np.column_stack([a.feature, a.last, np.where(a.below < 0, -1, a.below + n)]) for a, n in zip(done, first[1:])]
    return np.concatenate([np.zeros((0, 4), int), *above]), len(done), last.drawn, last.starts, last.ends[-1]


def _counter(trees: list[list[Level]], n_features: int, seed: int, kind: str):
    """Packs to counts of the deepest level, rows ``(tree, block, counts)``: what ``count_packs`` does on the JVM, for cells of any width."""
    def blocks(batches):
        packs, cells, held = [], [], 0
        for b in batches:
            for pack, data in zip(b.column(0).to_pylist(), b.column(1)):
                part = np.frombuffer(data.as_buffer(), kind)
                packs.append((pack, len(part) // n_features))
                cells.append(part)
                held += len(part) // n_features
                if held >= BLOCK_ROWS:
                    yield packs, np.concatenate(cells)
                    packs, cells, held = [], [], 0
        if packs:
            yield packs, np.concatenate(cells)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, held = bag_table(), list(blocks(batches))
        n_cells = max((int(cells.max()) + 1 for _, cells in held), default=0)
        out, size = [], 0
        for t, levels in enumerate(trees):
            if not held or not levels or levels[-1].feature is not None:
                continue
            level, total = levels[-1], np.zeros(levels[-1].ends[-1])
            steps = [above.step(n_cells, n_cells if below.feature is not None else 1) for above, below in zip(levels, levels[1:])]
            drawn = [(np.ascontiguousarray(f), np.ascontiguousarray(a)) for f, a in zip(level.drawn.T, level.starts.T)]
            for packs, cells in held:
                taken = np.concatenate([bag(table, seed, t, pack, n) for pack, n in packs])
                _count(steps, drawn, cells, taken, n_features, total)
            total = total.astype(np.uint32)
            ends = np.r_[0, level.ends[level.drawn.shape[1] - 1::level.drawn.shape[1]]]
            for block, a in enumerate(range(0, len(ends) - 1, NODE_BLOCK)):
                part = total[ends[a]:ends[min(a + NODE_BLOCK, len(ends) - 1)]]
                out.append((t, block, part.tobytes()))
                size += part.nbytes
            if size > 4 << 20:
                yield _batch(out)
                out, size = [], 0
        if out:
            yield _batch(out)
    return count


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    t, block, counts = zip(*rows)
    return pa.RecordBatch.from_pydict({"tree": pa.array(t, pa.int32()), "block": pa.array(block, pa.int32()),
                                       "counts": pa.array(counts, pa.binary())})


def _count(steps: list[tuple], drawn: list[tuple], cells: np.ndarray, taken: np.ndarray, n_features: int, total: np.ndarray) -> None:
    """Walk a tree's bag down to its last level; add to ``total`` how often each (node, feature drawn, cell) occurs there."""
    row = np.flatnonzero(taken > 0)
    weight, row = taken.take(row).astype(np.float64), row * n_features
    node = np.zeros(len(row), np.int64)
    for feature, below in steps:
        cell = feature.take(node)
        cell += row
        node += cells.take(cell)
        node = below.take(node)
    inside = np.flatnonzero(node < len(drawn[0][0]))
    if len(inside) < len(node):
        node, row, weight = node.take(inside), row.take(inside), weight.take(inside)
    for feature, start in drawn:
        cell = feature.take(node)
        cell += row
        place = start.take(node)
        place += cells.take(cell)
        np.add.at(total, place, weight)


def _gini(n: np.ndarray) -> np.ndarray:
    total = n.sum(-1)
    return 1.0 - np.divide((n * n).sum(-1), total * total, out=np.ones_like(total), where=total > 0)


def best_splits(counts: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of ``counts`` (node, feature, bin, class): each node's whole counts, best feature (its place among
    those drawn), last bin that goes left, gain (0 or less: none) and the counts on the left."""
    whole = counts[:, 0].sum(1)
    left = counts.cumsum(2)[:, :, :-1]
    right = whole[:, None, None] - left
    l, r, w = left * weights, right * weights, whole * weights
    share = np.divide(l.sum(-1), w.sum(-1)[:, None, None], out=np.zeros(l.shape[:-1]), where=w.sum(-1)[:, None, None] > 0)
    gain = _gini(w)[:, None, None] - share * _gini(l) - (1.0 - share) * _gini(r)
    gain[(left.sum(-1) == 0) | (right.sum(-1) == 0)] = 0.0
    at = gain.reshape(len(gain), -1).argmax(1)
    f, cut = np.unravel_index(at, gain.shape[1:])
    node = np.arange(len(gain))
    return whole, f, cut, gain[node, f, cut], left[node, f, cut]


def _chooser(drawn: list[np.ndarray | None], bins: np.ndarray, weights: np.ndarray):
    """Counts, met by tree and block, to splits: a row of arrays for each."""
    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict = {}
        for b in batches:
            for t, block, counts in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                part = np.frombuffer(counts.as_buffer(), np.uint32)
                if (t, block) in sums:
                    sums[t, block] += part
                else:
                    sums[t, block] = part.astype(np.int64)
        k, width = len(weights), max(bins.max(), 2)
        for (t, block), flat in sums.items():
            mine = drawn[t][block * NODE_BLOCK:(block + 1) * NODE_BLOCK]
            dense = np.zeros((*mine.shape, width, k), np.int64)
            dense[np.arange(width) < bins[mine][..., None]] = flat.reshape(-1, k)
            whole, f, cut, gain, left = best_splits(dense, weights)
            feature = mine[np.arange(len(mine)), f]
            yield pa.RecordBatch.from_pydict({
                "tree": pa.array([t], pa.int32()), "block": pa.array([block], pa.int32()),
                **{c: pa.array([v.astype(d).tobytes()], pa.binary()) for c, v, d in (
                    ("whole", whole, "i8"), ("feature", feature, "i8"), ("cut", cut, "i8"), ("gain", gain, "f8"), ("left", left, "i8"))}})
    return choose


class _Tree:
    """A tree's nodes as they are found: parallel lists, children by position."""

    def __init__(self):
        self.stats, self.gain, self.split, self.children, self.open = [], [], [], [], []

    def add(self, stats) -> int:
        self.stats.append(stats)
        self.gain.append(-1.0)
        self.split.append(None)
        self.children.append(None)
        return len(self.stats) - 1


def _nodes(t: int, tree: _Tree, weights: np.ndarray, cuts: list[np.ndarray]) -> list[tuple]:
    """A tree's rows in Spark ML's order (a node, its left side, its right side), sibling leaves of one class merged."""
    stats = [s * weights for s in tree.stats]
    best = [float(np.argmax(s)) for s in stats]
    for at in range(len(stats) - 1, -1, -1):  # children lie behind their parents
        pair = tree.children[at]
        if pair and not tree.children[pair[0]] and not tree.children[pair[1]] and best[pair[0]] == best[pair[1]]:
            tree.children[at] = None
            best[at] = best[pair[0]]
    out: list = []

    def write(at: int) -> int:
        number, pair = len(out), tree.children[at]
        out.append(None)
        left, right = (write(pair[0]), write(pair[1])) if pair else (-1, -1)
        f, cut = tree.split[at] if pair else (-1, None)
        out[number] = (t, {"id": number, "prediction": best[at], "impurity": float(_gini(stats[at])),
                           "impurityStats": stats[at].tolist(), "rawCount": int(tree.stats[at].sum()),
                           "gain": tree.gain[at] if pair else -1.0, "leftChild": left, "rightChild": right,
                           "split": {"featureIndex": int(f), "leftCategoriesOrThreshold": [float(cuts[f][cut])] if pair else [],
                                     "numCategories": -1}})
        return number

    write(0)
    return out


_NODE = pa.struct([("id", pa.int32()), ("prediction", pa.float64()), ("impurity", pa.float64()), ("impurityStats", pa.list_(pa.float64())),
                   ("rawCount", pa.int64()), ("gain", pa.float64()), ("leftChild", pa.int32()), ("rightChild", pa.int32()),
                   ("split", pa.struct([("featureIndex", pa.int32()), ("leftCategoriesOrThreshold", pa.list_(pa.float64())),
                                        ("numCategories", pa.int32())]))])


def grow_forest(df: DataFrame, forest: RandomForestClassifier) -> RandomForestClassificationModel:
    """Fit ``forest`` (Gini, all rows, no limits on a node but ``maxDepth``) to ``df``; its features all count
    as continuous."""
    from ..sources.order_risk import _file_system
    spark = df.sparkSession
    folder = f"{ensure_checkpoint_dir(spark)}/forest-{uuid.uuid4().hex}"
    where, fs = _file_system(spark, folder)
    try:
        return _grow(df, forest, folder)
    finally:
        fs.delete(where, True)


def _grow(df: DataFrame, forest: RandomForestClassifier, folder: str) -> RandomForestClassificationModel:
    spark, seed, depth = df.sparkSession, forest.getSeed(), forest.getMaxDepth()
    label, weight, max_bins = forest.getLabelCol(), forest.getWeightCol(), forest.getMaxBins()
    df.select(vector_to_array(forest.getFeaturesCol()).alias("x"), F.col(label).cast("double").alias("y"),
              F.col(weight).cast("double").alias("w")).write.parquet(f"{folder}/rows")
    rows = spark.read.parquet(f"{folder}/rows")
    # one row for each class
    classes = rows.groupBy("y").agg(F.count(F.lit(1)).alias("n"), F.min("w").alias("a"), F.max("w").alias("b"),
                                     F.count_if(F.exists("x", lambda v: F.isnan(v) | (F.abs(v) == float("inf")))).alias("bad")).collect()
    if not classes or any(r["y"] is None or not float(r["y"]).is_integer() or r["y"] < 0 for r in classes):
        raise ValueError("a forest needs rows, each with the number of its class")
    if any(r["bad"] for r in classes):
        raise ValueError("features must not be NaN or infinite")
    if any(r["a"] is None or r["a"] != r["b"] for r in classes):
        raise ValueError("weights must be equal within a class")
    n_classes = max(int(max(r["y"] for r in classes)) + 1, 2)
    weights = np.zeros(n_classes)
    for r in classes:
        weights[int(r["y"])] = r["a"]
    n_features = len(rows.select("x").first()["x"])
    shares = fractions_array(SKETCH)
    # one row for each feature
    sketch = dict(rows.select(F.posexplode("x").alias("f", "v")).groupBy("f").agg(F.percentile_approx("v", shares, 2 * SKETCH)).collect())
    cuts = [thresholds(np.array(sketch[f], float), max_bins) for f in range(n_features)]
    bins = np.array([len(c) + 1 for c in cuts])
    kind = "u1" if bins.max() * n_classes <= BYTE_CELLS else "u4"

    cores = spark.sparkContext.defaultParallelism
    (rows.select("x", "y").mapInArrow(_packer(cuts, n_classes, kind), "pack long, cells binary")
     .repartition(2 * cores).write.parquet(f"{folder}/packs"))
    packs = spark.read.parquet(f"{folder}/packs")

    usable = np.flatnonzero(bins > 1)
    n_drawn = min(int(np.ceil(np.sqrt(n_features))), max(len(usable), 1))
    if not len(usable):
        usable = np.array([0])

    def level(t: int, at: int, n: int) -> Level:
        order = np.random.default_rng([seed & (2 ** 64 - 1), t, at]).random((n, len(usable))).argsort(1)[:, :n_drawn]
        return Level(np.sort(usable[order], axis=1), bins, n_classes)

    trees = [_Tree() for _ in range(forest.getNumTrees())]
    levels = [[level(t, 0, 1)] for t in range(len(trees))]
    for tree in trees:
        tree.open = [tree.add(np.zeros(n_classes, np.int64))]
    for at in range(max(depth, 1)):
        if not any(tree.open for tree in trees):
            break
        if kind == "u1":
            counts = count_packs(packs, n_features, NODE_BLOCK, seed, bag_table(), [_walked(mine) for mine in levels])
        else:
            counts = packs.mapInArrow(_counter(levels, n_features, seed, kind), "tree int, block int, counts binary")
        drawn = [mine[-1].drawn if tree.open else None for mine, tree in zip(levels, trees)]
        found = counts.repartition(cores, "tree", "block").mapInArrow(
            _chooser(drawn, bins, weights),
            "tree int, block int, whole binary, feature binary, cut binary, gain binary, left binary").collect()
        parts: dict = {}
        for r in sorted(found, key=lambda r: (r["tree"], r["block"])):
            parts.setdefault(r["tree"], []).append(r)
        for t, part in parts.items():
            whole, feature, cut, gain, left = (np.frombuffer(b"".join(bytes(r[c]) for r in part), d) for c, d in (
                ("whole", "i8"), ("feature", "i8"), ("cut", "i8"), ("gain", "f8"), ("left", "i8")))
            _split(trees[t], levels[t][-1], whole.reshape(-1, n_classes), feature, cut, gain, left.reshape(-1, n_classes),
                   n_classes, weights, at, depth)
            if trees[t].open:
                levels[t].append(level(t, at + 1, len(trees[t].open)))

    stored = [n for t, tree in enumerate(trees) for n in _nodes(t, tree, weights, cuts)]
    return _as_model(spark, forest, n_features, n_classes, stored, f"{folder}/model")


def _split(tree: _Tree, level: Level, whole, feature, cut, gain, left, n_classes, weights, at, depth) -> None:
    """Enter a level's best splits in its tree; ``open`` are then the nodes to split next."""
    below = np.full((len(whole), 2), -1, np.int64)
    mine, tree.open = tree.open, []
    for i, node in enumerate(mine):
        tree.stats[node] = whole[i]
        if gain[i] <= 0 or depth == 0:
            continue
        tree.gain[node], tree.split[node] = float(gain[i]), (int(feature[i]), int(cut[i]))
        sides = (left[i], whole[i] - left[i])
        tree.children[node] = tuple(tree.add(s) for s in sides)
        for side, child in enumerate(tree.children[node]):
            if at + 1 < depth and _gini(sides[side] * weights) >= EPSILON:
                below[i, side] = len(tree.open)
                tree.open.append(child)
    level.feature, level.last, level.below = feature, cut * n_classes + n_classes - 1, below
    level.drawn = level.starts = level.ends = None


def _as_model(spark, forest: RandomForestClassifier, n_features: int, n_classes: int, nodes: list[tuple],
              path: str) -> RandomForestClassificationModel:
    """The nodes as a Spark ML model: those of a model of the same settings take the place of its own."""
    one = spark.createDataFrame([(float(c), 1.0, Vectors.dense([float(c)] * n_features)) for c in range(n_classes)],
                                [forest.getLabelCol(), forest.getWeightCol(), forest.getFeaturesCol()]).coalesce(1)
    forest.fit(one).write().save(path)
    t, data = zip(*nodes)
    table = pa.table({"treeID": pa.array(t, pa.int32()), "nodeData": pa.array(data, _NODE)})
    spark.createDataFrame(table).write.mode("overwrite").parquet(f"{path}/data")
    return RandomForestClassificationModel.load(path)
