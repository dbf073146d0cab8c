from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from riskweave.operators import evaluate as ev
from riskweave.operators import model as ml
from riskweave.sources import order_risk

from conftest import SF_SMALL


def test_label_encode_equals_alphabetical_indexer(spark):
    df = order_risk(spark, SF_SMALL)
    enc = ml.label_encode(df, ["country", "payment_method"])
    for c in ["country", "payment_method"]:
        idx = StringIndexer(inputCol=c, outputCol="i", stringOrderType="alphabetAsc").fit(df).transform(df)
        a = {r.order_id: r[f"{c}_enc"] for r in enc.select("order_id", f"{c}_enc").collect()}
        b = {r.order_id: int(r.i) for r in idx.select("order_id", "i").collect()}
        assert a == b


def test_forest_pipeline_end_to_end(spark):
    df = ml.label_encode(order_risk(spark, SF_SMALL))
    split = ev.stratified_split(df, "risk_label", 0.25, 42)
    train, test = split.filter(F.col("split") == "train"), split.filter(F.col("split") == "test")
    model = ml.fit_risk_model(train, num_trees=20, max_depth=5)
    pred = ml.predict(model, test)
    assert pred.count() == test.count()
    assert set(r.predicted for r in pred.select("predicted").distinct().collect()) <= {
        "Fraud Risk", "Normal", "Return Risk"}
    imp = ml.feature_importance(model).toPandas()
    assert len(imp) == 18 and abs(imp["importance"].sum() - 1.0) < 1e-9
    assert list(ml.top_drivers(ml.feature_importance(model), 10).toPandas()["feature"]) == \
        list(imp.sort_values(["importance", "feature"], ascending=[False, True])["feature"][:10])
    report = {r["class"]: r for r in ev.classification_report(pred, "risk_label", "predicted").collect()}
    assert report["accuracy"].support == test.count()


def test_fraud_probability_auc(spark):
    df = ml.label_encode(order_risk(spark, SF_SMALL))
    split = ev.stratified_split(df, "is_fraud", 0.25, 42)
    model = ml.fit_fraud_model(split.filter(F.col("split") == "train"), num_trees=20, max_depth=5)
    scored = ml.fraud_probability(model, split.filter(F.col("split") == "test"))
    auc = ev.roc_auc(scored, "is_fraud", "score").first().auc
    assert 0.5 < auc <= 1.0
