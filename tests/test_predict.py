"""Predictions by the JVM's loop against Spark ML's own; reports that predict once."""

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import functions as F

from riskweave.operators import evaluate as ev
from riskweave.operators import model as ml


@pytest.fixture(scope="module")
def fitted(spark):
    rng = np.random.default_rng(6)
    rows = [(i, float(rng.normal()), float(rng.integers(0, 5)), "abcde"[rng.integers(0, 5)]) for i in range(500)]
    rows = [(*r, ("no", "some", "yes")[int(r[1] > 0.2) + int(r[3] in "bd" and r[2] > 1)]) for r in rows]
    df = spark.createDataFrame(rows, "id int, x double, z double, c string, risk_label string").repartition(3).cache()
    stages = [StringIndexer(inputCol="c", outputCol="ci", stringOrderType="alphabetAsc"),
              VectorAssembler(inputCols=["x", "z", "ci"], outputCol="features"),
              StringIndexer(inputCol="risk_label", outputCol="label", stringOrderType="alphabetAsc"),
              RandomForestClassifier(numTrees=15, maxDepth=5, seed=3)]
    return Pipeline(stages=stages).fit(df), df


def test_predictions_equal_spark_mls_without_its_scorer(fitted):
    model, df = fitted
    ours, theirs = ml.predict(model, df), ml.predict(model, df, spark_ml=True)
    assert ours.columns == theirs.columns
    plan = ours._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert {r["id"]: r["predicted"] for r in ours.collect()} == {r["id"]: r["predicted"] for r in theirs.collect()}
    want = {r["id"]: r for r in theirs.collect()}
    for r in ours.collect():
        w = want[r["id"]]
        assert r["prediction"] == w["prediction"]
        assert r["rawPrediction"].toArray() == pytest.approx(w["rawPrediction"].toArray(), abs=1e-12)
        assert r["probability"].toArray() == pytest.approx(w["probability"].toArray(), abs=1e-12)


def test_thresholds_are_kept_to(fitted):
    model, df = fitted
    forest = model.stages[-1].copy()
    forest._set(thresholds=[0.9, 0.05, 0.05])
    shifted = type(model)([*model.stages[:-1], forest])
    got, want, usual = ([r["predicted"] for r in d.orderBy("id").collect()] for d in (
        ml.predict(shifted, df), ml.predict(shifted, df, spark_ml=True), ml.predict(model, df)))
    assert got == want != usual


def test_fraud_scores_equal_spark_mls(fitted):
    model, df = fitted
    ours = {r["id"]: r["score"] for r in ml.fraud_probability(model, df).collect()}
    theirs = {r["id"]: r["probability"][1] for r in model.transform(df).collect()}
    assert ours == pytest.approx(theirs, abs=1e-12)


def test_a_report_predicts_each_row_once(spark):
    """The report reads the confusion counts three times; each time all rows were predicted again."""
    calls = spark.sparkContext.accumulator(0)

    def guess(v):
        calls.add(1)
        return "a" if v % 3 else "b"

    df = spark.range(300).select(F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("label"),
                                 F.udf(guess)("id").alias("prediction"))
    report = {r["class"]: r for r in ev.classification_report(df).collect()}
    assert calls.value == 300
    assert report["a"]["support"] == 150 and report["a"]["recall"] == pytest.approx(2 / 3) and report["accuracy"]["f1_score"] == pytest.approx(0.5)


def test_an_auc_scores_each_row_once(spark):
    """The filter on missing scores worked a score out again (F4); rows without score or label still do not count."""
    calls = spark.sparkContext.accumulator(0)

    def score(v):
        calls.add(1)
        return None if v < 20 else float(v % 7)

    df = spark.range(200).select(F.when(F.col("id") > 189, None).when(F.col("id") % 3 == 0, 1).otherwise(0).alias("label"),
                                 F.udf(score, "double")("id").alias("score"))
    kept = [(i % 3 == 0, float(i % 7)) for i in range(20, 190)]
    pos, neg = [v for y, v in kept if y], [v for y, v in kept if not y]
    want = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / len(pos) / len(neg)
    assert ev.roc_auc(df).first()["auc"] == pytest.approx(want, abs=1e-12)
    assert calls.value == 190
