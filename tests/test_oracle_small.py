"""Registered queries against their DuckDB oracle at sf0.001 (the driver
does the same at sf0.01)."""

import math
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry

from conftest import SF_SMALL

FAST = ["S1_order_risk", "A1_enterprise_rates", "A2_risk_scorecards", "B1_breach_log", "A3_monthly_trend",
        "V7_validation_log", "V7_mapping_losses", "V2_duplicate_line_keys", "A7_numeric_summary", "A8_iqr_outliers",
        "A10_correlation_matrix", "A13_box_stats", "F2_seasonal_decompose", "F5_forecast_table",
        "M5_fraud_rules", "M5_return_rules", "L3_stratified_split", "L9_classification_report",
        "L11_roc_auc_order_value"]


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, pd.Timestamp):
        return str(v.date())
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float) and v.is_integer():
        return int(v)
    return str(v) if not isinstance(v, (int, float)) else v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, con, name):
    got = entry.queries()[name](spark, SF_SMALL).toPandas()
    want = con.execute(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    cols = sorted(got.columns)
    g = sorted(tuple(_norm(x) for x in r) for r in got[cols].itertuples(index=False, name=None))
    w = sorted(tuple(_norm(x) for x in r) for r in want[cols].itertuples(index=False, name=None))
    assert g == w


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["dimension", "segment", "fraud_rate_pct", "orders"]
    assert df.count() >= 0


def test_every_query_has_a_callable_and_most_an_oracle():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    assert len(o) >= 0.7 * len(q)
