"""The published report files against this library's operators."""

import os

import pandas as pd

from conftest import GOLDEN
from riskweave.operators import evaluate as ev
from riskweave.operators import model
from riskweave.operators import profile as pf
from riskweave.operators import scorecard as sc


def test_summary_and_outlier_bounds(spark):
    # five points at the published quantiles have just these quantiles
    want = pd.read_csv(os.path.join(GOLDEN, "eda_numeric_summary.csv"), index_col=0)
    bounds = pd.read_csv(os.path.join(GOLDEN, "eda_outlier_report.csv"), index_col=0)
    assert list(want.index) == list(pf.NUMERIC_SUMMARY_COLS) and list(bounds.index) == list(pf.OUTLIER_COLS)
    df = spark.createDataFrame(want[["min", "25%", "50%", "75%", "max"]].T.astype(float).reset_index(drop=True))
    got = pf.numeric_summary(df).toPandas().set_index("column")
    for theirs, ours in [("min", "min"), ("25%", "p25"), ("50%", "p50"), ("75%", "p75"), ("max", "max")]:
        assert got.loc[want.index, ours].tolist() == want[theirs].tolist()
    found = pf.iqr_outliers(df).toPandas().set_index("column")
    for c in ("lower_bound", "upper_bound"):
        assert found.loc[bounds.index, c].tolist() == bounds[c].tolist()
    assert set(bounds.columns) <= set(found.columns)


def test_breach_log(spark):
    # 475 of 12,000 orders by gift card, 39 of the 447 frauds among them
    rows = [("Gift Card" if i < 475 else "PayPal", int(i < 39 or i >= 12_000 - 408), 0, i, 1.0, 4.0, "Normal")
            for i in range(12_000)]
    df = spark.createDataFrame(rows, "payment_method string, is_fraud int, is_returned int, order_id long, "
                                     "order_value_eur double, review_score double, risk_label string")
    got = sc.breach_log(sc.risk_scorecards(df, ["payment_method"]), df, 2.0).toPandas()
    want = pd.read_csv(os.path.join(GOLDEN, "risk_appetite_breach_log.csv"))
    assert got[list(want.columns)].astype({"orders": float}).values.tolist() == want.values.tolist()


def test_classification_report_rows(spark):
    with open(os.path.join(GOLDEN, "model_classification_report.txt")) as f:
        lines = [x.rsplit(None, 2) for x in f.read().splitlines()[1:] if x.strip()]
    support = {x[0].strip(): int(x[-1]) for x in lines}
    classes = [c for c in ("Fraud Risk", "Normal", "Return Risk")]
    want = [next(n for name, n in support.items() if name.startswith(c)) for c in classes]
    rows = [(c, "Normal") for c, n in zip(classes, want) for _ in range(n)]
    got = ev.classification_report(spark.createDataFrame(rows, "label string, prediction string")).collect()
    assert [r["class"] for r in got] == [*classes, "accuracy", "macro avg", "weighted avg"]
    assert [r["support"] for r in got] == [int(x[-1]) for x in lines]
    assert [round(r["f1_score"], 4) for r in got][3] == round(2620 / 3000, 4)


def test_feature_names():
    names = pd.read_csv(os.path.join(GOLDEN, "feature_importance.csv"), index_col=0).index
    assert sorted(names) == sorted(model.FEATURE_COLS)
