"""Forests as tables against Spark ML's own forests."""

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskweave.operators import forest as fr


@pytest.fixture(scope="module")
def fitted(spark):
    rng = np.random.default_rng(2)
    rows = [(int(i), float(rng.normal()), float(rng.integers(0, 4)), "abcde"[rng.integers(0, 5)], float(rng.uniform(0.5, 3))) for i in range(600)]
    rows = [(*r, float((r[1] > 0.3) + (r[3] in "bd" and r[2] > 1))) for r in rows]
    df = spark.createDataFrame(rows, "id int, x double, z double, c string, w double, label double")
    model = Pipeline(stages=[StringIndexer(inputCol="c", outputCol="ci", stringOrderType="alphabetAsc"),
                             VectorAssembler(inputCols=["x", "z", "ci"], outputCol="features"),
                             RandomForestClassifier(numTrees=7, maxDepth=5, seed=3, weightCol="w")]).fit(df)
    done = model.transform(df).withColumn("x_array", vector_to_array("features")).cache()
    return model, done


@pytest.fixture(scope="module")
def nodes(fitted, tmp_path_factory):
    return fr.export_forest(fitted[0], str(tmp_path_factory.mktemp("forest") / "f")).cache()


def test_scores_equal_spark_ml_row_by_row(fitted, nodes):
    model, done = fitted
    assert nodes.filter("categories is not null").count() > 0 and nodes.filter("threshold is not null").count() > 0
    got = fr.score(done.withColumnsRenamed({"probability": "p", "prediction": "y"}), nodes, "x_array", 3)
    rows = got.select(vector_to_array("p").alias("p"), "y", "probability", "prediction").collect()
    assert len(rows) == 600
    for r in rows:
        assert r["prediction"] == r["y"] and r["probability"] == pytest.approx(r["p"], abs=1e-12)


def test_scoring_runs_without_python(fitted, nodes):
    plan = fr.score(fitted[1].select("id", "x_array"), nodes, "x_array", 3)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_importances_equal_spark_ml(fitted, nodes):
    got = {r["feature"]: r["importance"] for r in fr.importance(nodes, ["x", "z", "ci"]).collect()}
    want = fitted[0].stages[-1].featureImportances.toArray()
    assert [got[c] for c in ("x", "z", "ci")] == pytest.approx(want.tolist(), abs=1e-9)
    assert fr.importance(nodes, ["x", "z", "ci", "more"]).filter("feature = 'more'").first()["importance"] == 0.0


def test_refresh_counts_every_row_at_every_node(fitted, nodes):
    _, done = fitted
    fresh = {(r["tree"], r["node"]): r for r in fr.refresh(nodes, done, "x_array", "label", 3, "w").collect()}
    assert len(fresh) == nodes.count()
    rows = done.select("x_array", "label", "w").collect()
    trees = {}
    for r in nodes.collect():
        trees.setdefault(r["tree"], {})[r["node"]] = r
    for t, tree in trees.items():
        want = {n: np.zeros(3) for n in tree}
        for r in rows:
            at = 0
            while True:
                want[at][int(r["label"])] += r["w"]
                n = tree[at]
                if n["left"] < 0:
                    break
                v = r["x_array"][n["feature"]]
                at = n["left"] if (v in n["categories"] if n["categories"] is not None else v <= n["threshold"]) else n["right"]
        for n, stats in want.items():
            assert fresh[t, n]["stats"] == pytest.approx(stats.tolist())
            if tree[n]["left"] >= 0:
                gini = lambda s: s.sum() - (s @ s) / s.sum() if s.sum() else 0.0
                gain = (gini(stats) - gini(want[tree[n]["left"]]) - gini(want[tree[n]["right"]])) / stats.sum() if stats.sum() else 0.0
                assert fresh[t, n]["gain"] == pytest.approx(gain, abs=1e-12)


def test_missing_features_go_right_and_damaged_forests_are_refused(spark):
    schema = ("tree int, node int, feature int, threshold double, categories array<double>, left int, right int, gain double, "
              "stats array<double>, depth int")
    stump = [(0, 0, 0, 1.0, None, 1, 2, 0.5, [5.0, 5.0], 0), (0, 1, -1, None, None, -1, -1, None, [4.0, 0.0], 1),
             (0, 2, -1, None, None, -1, -1, None, [0.0, 0.0], 1)]
    nodes = spark.createDataFrame(stump, schema)
    df = spark.createDataFrame([(1, [1.0]), (2, [1.5]), (3, [None]), (4, [float("nan")])], "id int, x array<double>")
    got = {r["id"]: (r["probability"], r["prediction"]) for r in fr.score(df, nodes, "x", 2).collect()}
    assert got[1] == ([1.0, 0.0], 0.0)
    assert got[2] == got[3] == got[4] == ([None, None], 0.0)  # a leaf that no row reached has no vote
    with pytest.raises(ValueError):
        fr.score(df, nodes.filter("node <> 1"), "x", 2)
    with pytest.raises(ValueError):
        fr.score(df, nodes.limit(0), "x", 2)
    one = spark.createDataFrame([stump[1][:1] + (0,) + stump[1][2:9] + (0,)], schema)  # a lone leaf
    assert {r["prediction"] for r in fr.score(df, one, "x", 2).collect()} == {0.0}
