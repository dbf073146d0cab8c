import datetime as dt
import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskweave.operators import forecast as fc

from conftest import GOLDEN


@pytest.fixture(scope="module")
def golden_series(spark):
    g = pd.read_csv(os.path.join(GOLDEN, "monthly_risk_trend.csv"))
    # exact counts come back as round(rate * orders) (they total 447 frauds, 1,112 returns)
    g["fraud_rate"] = (g.fraud_rate_pct * g.orders / 100).round() / g.orders
    g["return_rate"] = (g.return_rate_pct * g.orders / 100).round() / g.orders
    g["month"] = pd.to_datetime(g.month + "-01").dt.date
    g["t"] = range(len(g))
    return spark.createDataFrame(g[["month", "t", "orders", "fraud_rate", "return_rate"]])


@pytest.mark.parametrize("mode", ["ols", "optimize"])
def test_forecast_golden(golden_series, mode):
    want = pd.read_csv(os.path.join(GOLDEN, "forecast_next_3_months.csv"))
    got = fc.forecast_table(golden_series, horizon=3, mode=mode).toPandas()
    assert got["forecast_month"].tolist() == want["forecast_month"].tolist()
    assert got["forecasted_orders"].tolist() == want["forecasted_orders"].tolist()
    assert got["forecasted_fraud_rate_pct"].tolist() == want["forecasted_fraud_rate_%"].tolist()
    assert got["forecasted_return_rate_pct"].tolist() == want["forecasted_return_rate_%"].tolist()


def test_decomposition_parts_add_up(golden_series):
    d = fc.seasonal_decompose(golden_series, "orders").toPandas()
    assert d["trend"].notna().sum() == 24 and d["trend"].iloc[:6].isna().all()
    full = d.dropna()
    assert ((full.trend + full.seasonal + full.resid - full.observed).abs() < 1e-9).all()
    seas = d.groupby(d.t % 12)["seasonal"].first()
    assert abs(seas.sum()) < 1e-9


def test_gap_series_calendar(spark):
    # gap_series fixture: 30 months with 2 missing
    months = [dt.date(2020 + (i // 12), i % 12 + 1, 1) for i in range(30) if i not in (7, 19)]
    df = spark.createDataFrame([(m, 100 + i) for i, m in enumerate(months)], "month date, orders long")
    df = df.withColumn("fraud_rate", F.lit(0.1)).withColumn("return_rate", F.lit(0.2))
    full = fc.complete_calendar(df).orderBy("t").toPandas()
    assert len(full) == 30 and full["orders"].isna().sum() == 2
    assert full["t"].tolist() == list(range(30))
    d = fc.seasonal_decompose(fc.complete_calendar(df), "orders").toPandas()
    # windows touching a gap give no trend
    assert d.loc[d.t.between(1, 13), "trend"].isna().all()


def test_keyed_series_fit_in_parallel(golden_series):
    two = golden_series.withColumn("k", F.lit("a")).unionByName(
        golden_series.withColumn("k", F.lit("b")).withColumn("orders", F.col("orders") * 2))
    got = fc.forecast_table(two, keys=["k"], horizon=3).toPandas()
    a = got[got.k == "a"]["forecasted_orders"].tolist()
    b = got[got.k == "b"]["forecasted_orders"].tolist()
    assert a == [367.0, 312.0, 356.0] and b == [734.0, 625.0, 712.0]
