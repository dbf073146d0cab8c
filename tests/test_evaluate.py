import numpy as np
import pandas as pd
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from riskweave.operators import evaluate as ev


def test_largest_remainder_split(spark):
    # small_classes fixture: 7 / 5 / 3 -> test 4 (ceil 3.75): quotas 1.8667/1.25/0.75 -> 2/1/1
    rows = [(i, "a") for i in range(7)] + [(10 + i, "b") for i in range(5)] + [(20 + i, "c") for i in range(3)]
    df = spark.createDataFrame(rows, "order_id long, label string")
    s = ev.stratified_split(df, "label", 0.25, 42, buckets=4)
    got = {r.label: r["count"] for r in s.filter(F.col("split") == "test").groupBy("label").count().collect()}
    assert got == {"a": 2, "b": 1, "c": 1}
    assert s.count() == 15


def test_split_quotas_match_published_supports(spark):
    # class sizes 447 / 10,482 / 1,071 -> published test supports 112 / 2,620 / 268
    rows = [(i, "Fraud Risk") for i in range(447)] + [(1000 + i, "Normal") for i in range(10482)] + \
           [(20000 + i, "Return Risk") for i in range(1071)]
    df = spark.createDataFrame(rows, "order_id long, label string")
    s = ev.stratified_split(df, "label", 0.25, 42)
    got = {r.label: r["count"] for r in s.filter(F.col("split") == "test").groupBy("label").count().collect()}
    assert got == {"Fraud Risk": 112, "Normal": 2620, "Return Risk": 268}


def test_classification_report_zero_division(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "a"), ("b", "a"), ("c", "a")], "label string, prediction string")
    r = {x["class"]: x for x in ev.classification_report(df).collect()}
    assert r["b"].precision == 0.0 and r["b"].f1_score == 0.0
    assert r["a"].precision == 0.5 and r["a"].recall == 1.0
    assert r["accuracy"].f1_score == 0.5 and r["accuracy"].support == 4
    assert abs(r["macro avg"].precision - 0.5 / 3) < 1e-12


def _auc_bruteforce(y, s):
    pos = [b for a, b in zip(y, s) if a == 1]
    neg = [b for a, b in zip(y, s) if a == 0]
    tot = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg)
    return tot / (len(pos) * len(neg))


def test_auc_ties_exact(spark):
    # tied_scores fixture
    y = [1, 0, 1, 0, 1, 0, 0, 1]
    s = [0.9, 0.9, 0.5, 0.5, 0.5, 0.1, 0.1, 0.2]
    df = spark.createDataFrame(list(zip(y, s)), "label int, score double")
    assert ev.roc_auc(df, buckets=4).first().auc == _auc_bruteforce(y, s)


def test_auc_matches_exact_evaluator(spark):
    rng = np.random.default_rng(11)
    y = rng.integers(0, 2, 3000)
    s = np.round(rng.random(3000) + y * 0.3, 3)
    pdf = pd.DataFrame({"label": y.astype(float), "score": s})
    df = spark.createDataFrame(pdf)
    ours = ev.roc_auc(df, buckets=64).first().auc
    from pyspark.ml.functions import array_to_vector
    vec = df.withColumn("raw", array_to_vector(F.array(-F.col("score"), F.col("score"))))
    ml = BinaryClassificationEvaluator(rawPredictionCol="raw", labelCol="label", numBins=0).evaluate(vec)
    assert abs(ours - ml) < 1e-12
    assert abs(ours - _auc_bruteforce(y.tolist(), s.tolist())) < 1e-12


def test_confusion_matrix_all_classes(spark):
    df = spark.createDataFrame([("a", "a"), ("b", "a")], "label string, prediction string")
    m = ev.confusion_matrix(df, ["a", "b", "c"]).collect()
    assert [r.actual for r in m] == ["a", "b", "c"]
    assert [r["a"] for r in m] == [1, 1, 0] and [r["c"] for r in m] == [0, 0, 0]


def test_predictions_outside_the_classes_are_counted(spark):
    rows = [("a", "a"), ("a", "x"), ("a", None), ("b", "a"), ("b", "b")]
    pred = spark.createDataFrame(rows, "label string, prediction string")
    got = {r["actual"]: (r["a"], r["b"], r["elsewhere"]) for r in ev.confusion_matrix(pred, ["a", "b", "c"], other="elsewhere").collect()}
    assert got == {"a": (1, 0, 2), "b": (1, 1, 0), "c": (0, 0, 0)}
    assert ev.confusion_matrix(pred, ["a", "b"]).columns == ["actual", "a", "b"]
