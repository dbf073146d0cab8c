"""The native smoother and the fitted parameters."""

import datetime as dt
import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import GOLDEN
from riskweave.operators import forecast as fc
from riskweave.operators import smoothing as sm


def months(n, skip=()):
    return [dt.date(2000 + i // 12, i % 12 + 1, 1) for i in range(n) if i not in skip]


def frame(spark, series, skip=()):
    rows = []
    for key, y in series.items():
        rows += [(key, m, float(v)) for m, v in zip(months(len(y), skip), np.delete(y, list(skip)), strict=True)]
    df = spark.createDataFrame(rows, "k string, month date, y double")
    return df


def plain(y, a, b, g, m, level, trend, seasons, ahead=3):
    """The recursion of the module's docstring, step by step."""
    seasons, sse = list(seasons), 0.0
    for i, v in enumerate(y):
        s = seasons[i % m] if m else 0.0
        if np.isnan(v):
            level += trend
            continue
        sse += (v - level - trend - s) ** 2
        new = a * (v - s) + (1 - a) * (level + trend)
        if m:
            seasons[i % m] = g * (v - level - trend) + (1 - g) * s
        trend, level = b * (new - level) + (1 - b) * trend, new
    n = len(y)
    return [level + h * trend + (seasons[(n + h - 1) % m] if m else 0.0) for h in range(1, ahead + 1)], sse


@pytest.mark.parametrize("period,skip", [(0, ()), (4, ()), (4, (9, 13)), (0, (1, 5))])
def test_fixed_parameters_equal_the_plain_recursion(spark, period, skip):
    rng = np.random.default_rng(1)
    y = 50 + rng.normal(size=30).cumsum() + np.tile([3, -1, 0, -2], 8)[:30]
    df = frame(spark, {"a": y}, skip)
    start = sm.with_start(sm.pack(df, "y", ["k"]), period).first()
    have = np.array([np.nan if v is None else v for v in start["y"]])
    assert np.isnan(have).sum() == len(skip)
    want, sse = plain(have, 0.3, 0.2, 0.25, period, start["level0"], start["trend0"], start["seasons0"])
    got = sm.holt_winters_fixed(df, "y", ["k"], 0.3, 0.2, 0.25, period).orderBy("h").collect()
    assert [r["forecast"] for r in got] == pytest.approx(want) and got[0]["sse"] == pytest.approx(sse)


def test_start_states_and_short_series(spark):
    line = 5.0 + 2.0 * np.arange(12)
    df = frame(spark, {"a": line, "b": line[:1], "c": line[:7]})
    got = sm.holt_winters_fixed(df, "y", ["k"], 0.5, 0.5, 0.0).orderBy("k", "h").collect()
    # a straight line is foretold without error; one month is too short
    assert [(r["k"], r["forecast"]) for r in got] == [("a", 29.0), ("a", 31.0), ("a", 33.0), ("c", 19.0), ("c", 21.0), ("c", 23.0)]
    assert all(r["sse"] < 1e-18 for r in got)
    assert {r["k"] for r in sm.holt_winters_fixed(df, "y", ["k"], 0.5, 0.5, 0.1, 4).collect()} == {"a"}
    assert sm.holt_winters_fixed(df.filter("false"), "y", ["k"], 0.5, 0.5).count() == 0


def test_smoother_runs_without_python(spark):
    df = frame(spark, {"a": np.arange(30.0)})
    plan = sm.holt_winters_fixed(df, "y", ["k"], 0.3, 0.2, 0.25, 4)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def simulate(rng, n, a, b, g, m, noise=1.0):
    level, trend, seasons, out = 100.0, 0.1, list(5 * rng.normal(size=m)), []
    for i in range(n):
        s = seasons[i % m] if m else 0.0
        v = level + trend + s + noise * rng.normal()
        new = a * (v - s) + (1 - a) * (level + trend)
        if m:
            seasons[i % m] = g * (v - level - trend) + (1 - g) * s
        trend, level = b * (new - level) + (1 - b) * trend, new
        out.append(v)
    return np.array(out)


@pytest.mark.parametrize("m,true", [(0, (0.6, 0.2, 0.0)), (4, (0.5, 0.1, 0.3))])
def test_planted_parameters_come_back(m, true):
    rng = np.random.default_rng(8)
    y = np.stack([simulate(rng, 600, *true, m) for _ in range(6)])
    got = sm.fit_batch(y, m, 6)
    assert np.abs(got["p"] - np.array(true)).mean(axis=0).max() < 0.08
    assert (got["sse"] <= got["grid_sse"]).all() and (got["grid_sse"] <= got["line_sse"]).all()
    assert (got["sse"] < got["grid_sse"]).any()  # the iteration goes beyond the grid


def test_a_finer_grid_finds_nothing_better():
    rng = np.random.default_rng(9)
    y = np.stack([simulate(rng, 80, *p, 4) for p in ((0.2, 0.05, 0.1), (0.9, 0.0, 0.05), (0.4, 0.4, 0.6))])
    got = sm.fit_batch(y, 4, 6)
    fine = sm.fit_batch(y, 4, 21)
    assert (got["sse"] <= fine["grid_sse"] * 1.002).all()


def test_bounds_hold():
    rng = np.random.default_rng(10)
    y = rng.normal(size=(20, 40)).cumsum(axis=1)
    p = sm.fit_batch(y, 4, 4)["p"]
    assert (p >= 0).all() and (p[:, 1] <= p[:, 0] + 1e-12).all() and (p[:, 2] <= 1 - p[:, 0] + 1e-12).all()


def test_refined_series_of_all_lengths(spark):
    rng = np.random.default_rng(11)
    series = {f"s{n}": simulate(rng, n, 0.5, 0.1, 0.3, 4) for n in (1, 5, 6, 20, 60)}
    fit = sm.refine(frame(spark, series), "y", ["k"], 4)
    done = sm.smooth(fit, F.col("alpha"), F.col("beta"), F.col("gamma"), 4).collect()
    rows = {r["k"]: r for r in done}
    assert rows["s1"]["fit_sse"] is None and rows["s5"]["alpha"] is None and rows["s1"]["ahead"] is None
    for k in ("s6", "s20", "s60"):
        assert rows[k]["sse"] == pytest.approx(rows[k]["fit_sse"], rel=1e-6, abs=1e-9) and len(rows[k]["ahead"]) == 3
        assert rows[k]["fit_sse"] <= rows[k]["grid_sse"] + 1e-9
    assert sm.refine(frame(spark, series).filter("false"), "y", ["k"], 4).count() == 0


def test_published_forecast_by_refinement(spark):
    g = pd.read_csv(os.path.join(GOLDEN, "monthly_risk_trend.csv"))
    g["fraud_rate"] = (g.fraud_rate_pct * g.orders / 100).round() / g.orders
    g["return_rate"] = (g.return_rate_pct * g.orders / 100).round() / g.orders
    g["month"] = pd.to_datetime(g.month + "-01").dt.date
    g["t"] = range(len(g))
    series = spark.createDataFrame(g[["month", "t", "orders", "fraud_rate", "return_rate"]])
    want = pd.read_csv(os.path.join(GOLDEN, "forecast_next_3_months.csv"))
    got = fc.forecast_table(series, horizon=3, mode="refine").toPandas()
    assert got["forecasted_orders"].tolist() == want["forecasted_orders"].tolist()
    assert got["forecasted_fraud_rate_pct"].tolist() == want["forecasted_fraud_rate_%"].tolist()
    assert got["forecasted_return_rate_pct"].tolist() == want["forecasted_return_rate_%"].tolist()
