"""The reference's two programs as compositions of the operators.

``risk_report`` = validation, enterprise rates, scorecards, breaches, trend,
plot data and (optionally) the classifiers; ``eda_report`` = numeric profile,
outliers, distributions, decomposition, forecast and association rules.
Both return a dict of lazy DataFrames; ``write_report_pack`` persists them.
The prepared order table is materialized once and shared by every report.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import basket as mb
from ..operators import evaluate as ev
from ..operators import forecast as fc
from ..operators import model as ml
from ..operators import profile as pf
from ..operators import scorecard as sc
from ..operators import validate as vd
from ..sources.order_risk import prepare_order_risk


def risk_report(orders: DataFrame, multiplier: float = 2.0, with_models: bool = False,
                num_trees: int = 300, max_depth: int = 10) -> dict[str, DataFrame]:
    df = prepare_order_risk(orders)
    cards = sc.risk_scorecards(df)
    out = {
        "Validation Log": vd.validation_log(df),
        "Enterprise Summary": sc.enterprise_rates(df),
        "Monthly Trend": sc.monthly_trend(df),
        "Appetite Breaches": sc.breach_log(cards, df, multiplier),
        "Risk Label Counts": sc.value_counts(df, ["risk_label"]),
        "Correlation": pf.correlation_matrix(df),
    }
    for d in sc.RISK_DIMENSIONS:
        out[f"By {d}"] = sc.scorecard_sheet(cards, d)
    if with_models:
        encoded = ml.label_encode(df)  # the whole table before the split
        split = ev.stratified_split(encoded, "risk_label", 0.25, 42)
        model = ml.fit_risk_model(split.filter(F.col("split") == "train"), num_trees=num_trees,
                                  max_depth=max_depth)
        pred = ml.predict(model, split.filter(F.col("split") == "test"))
        out["Classification Report"] = ev.classification_report(pred, "risk_label", "predicted")
        out["Confusion Matrix"] = ev.confusion_matrix(pred, ["Fraud Risk", "Normal", "Return Risk"],
                                                      "risk_label", "predicted")
        out["Feature Importance"] = ml.feature_importance(model)
        fsplit = ev.stratified_split(encoded, "is_fraud", 0.25, 42)
        fmodel = ml.fit_fraud_model(fsplit.filter(F.col("split") == "train"), num_trees=num_trees,
                                    max_depth=max_depth)
        out["Fraud AUC"] = ev.roc_auc(ml.fraud_probability(fmodel, fsplit.filter(F.col("split") == "test")),
                                      "is_fraud", "score")
    return out


def eda_report(orders: DataFrame, horizon: int = 3, min_support: float = 0.004) -> dict[str, DataFrame]:
    df = prepare_order_risk(orders)
    series = fc.monthly_series(df)
    fs = mb.frequent_itemsets(mb.order_items(df), min_support, 3)
    rules = mb.association_rules(fs, 1.0)
    return {
        "Numeric Summary": pf.numeric_summary(df),
        "Outliers": pf.iqr_outliers(df),
        "Histograms": pf.histogram(df),
        "Box Stats": pf.box_stats(df),
        "Device Risk": sc.segment_rates(df, "device_type"),
        "Category Counts": sc.value_counts(df, ["country", "device_type", "traffic_source", "payment_method"]),
        "Decomposition": fc.seasonal_decompose(series, "orders"),
        "Forecast": fc.forecast_table(series, horizon=horizon),
        "Actual vs Forecast": fc.actual_vs_forecast(series, horizon=horizon),
        "Fraud Rules": mb.outcome_rules(rules, "is_fraud"),
        "Return Rules": mb.outcome_rules(rules, "is_returned"),
    }
