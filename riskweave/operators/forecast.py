"""Monthly series, seasonal decomposition and forecasts.

Series are keyed: ``keys=()`` is the reference's single enterprise series,
``keys=("country",)`` fits one series per country in parallel. Monthly
tables have at most (#keys x #months) rows, so windows partitioned by the
series key hold one series each -- a size bounded by the calendar.

Fitting modes:
* ``mode="ols"`` (default): a regression, not a smoother: linear trend (+
  month-of-year levels) by least squares, the alpha = 0 limit of Holt /
  Holt-Winters, in two DataFrame aggregates. It reproduces the published forecasts,
  whose fitted smoothing is at that limit; where level or season drift it differs.
* ``mode="optimize"``: Holt / Holt-Winters with fitted smoothing parameters, by a
  grid over them and initial states by least squares (the one-step errors are linear
  in them). One row for each (series, alpha, beta, gamma) is spread over the tasks,
  so that a single series uses them all; the smallest error wins (``min_by``).
* ``mode="refine"``: the same model, fitted beyond the grid (``smoothing.refine``): whole
  series in batches, damped Gauss-Newton from the best grid points, for many series.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import np_round
from ..session import materialize


def _w(keys: Sequence[str]) -> Window:
    return Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))


def monthly_series(df: DataFrame, keys: Sequence[str] = (), date_col: str = "order_date",
                   key_col: str = "order_id", fraud: str = "is_fraud",
                   returned: str = "is_returned") -> DataFrame:
    """A4: ``(keys..., month DATE, t INT, orders, fraud_rate, return_rate)``;
    unrounded rates; ``t`` counts months from the series' first month."""
    keys = list(keys)
    month = F.trunc(F.col(date_col), "month").alias("month")
    s = (df.filter(F.col(date_col).isNotNull())
         .groupBy(*keys, month)
         .agg(F.count(F.col(key_col)).alias("orders"),
              F.avg(F.col(fraud)).alias("fraud_rate"),
              F.avg(F.col(returned)).alias("return_rate")))
    for k in keys:
        s = s.filter(F.col(k).isNotNull())
    first = F.min("month").over(_w(keys))
    return s.withColumn("t", F.months_between("month", first).cast("int"))


def complete_calendar(series: DataFrame, keys: Sequence[str] = (),
                      measures: Sequence[str] = ("orders", "fraud_rate", "return_rate")) -> DataFrame:
    """one row per month between each series' first and last month;
    months with no orders appear with NULL measures (never silently skipped)."""
    keys = list(keys)
    span = series.groupBy(*keys).agg(F.min("month").alias("m0"), F.max("month").alias("m1"))
    cal = span.select(*keys, "m0", F.explode(F.sequence("m0", "m1", F.expr("INTERVAL 1 MONTH"))).alias("month"))
    cal = cal.withColumn("t", F.months_between("month", "m0").cast("int")).drop("m0")
    return cal.join(series.select(*keys, "month", *measures), keys + ["month"], "left").select(
        *keys, "month", "t", *measures)


def seasonal_decompose(series: DataFrame, value: str = "orders", keys: Sequence[str] = (),
                       period: int = 12) -> DataFrame:
    """additive decomposition ``(keys..., month, t, observed, trend, seasonal, resid)``.

    trend: centred moving average (2 x period for even periods), NULL where the
    window is incomplete; seasonal: mean detrended value per phase ``t % period``,
    re-centred to sum to zero; resid = observed - trend - seasonal. The calendar is
    completed first: a missing month has no observed value and leaves the trend around
    it incomplete."""
    keys = list(keys)
    series = complete_calendar(series, keys, [value])
    w = _w(keys).orderBy("t")
    y = F.col(value).cast("double")
    half = period // 2
    if period % 2 == 0:
        inner = w.rowsBetween(-(half - 1), half - 1)
        full = w.rowsBetween(-half, half)
        ma = (F.lit(0.5) * F.lag(y, half).over(w) + F.sum(y).over(inner)
              + F.lit(0.5) * F.lead(y, half).over(w)) / F.lit(float(period))
        complete = F.count(y).over(full) == F.lit(period + 1)
    else:
        full = w.rowsBetween(-half, half)
        ma = F.sum(y).over(full) / F.lit(float(period))
        complete = F.count(y).over(full) == F.lit(period)
    d = series.select(*keys, "month", "t", y.alias("observed"),
                      F.when(complete, ma).alias("trend"))
    d = d.withColumn("phase", F.col("t") % period)
    phase_means = (d.groupBy(*keys, "phase")
                   .agg(F.avg(F.col("observed") - F.col("trend")).alias("pm")))
    phase_means = phase_means.withColumn(
        "seasonal", F.col("pm") - F.avg("pm").over(_w(keys)))
    return (d.join(phase_means.select(*keys, "phase", "seasonal"), keys + ["phase"], "left")
            .withColumn("resid", F.col("observed") - F.col("trend") - F.col("seasonal"))
            .select(*keys, "month", "t", "observed", "trend", "seasonal", "resid")
            .orderBy(*keys, "t"))


def _horizon(horizon: int) -> Column:
    return F.explode(F.sequence(F.lit(1), F.lit(horizon)))


def _regressions(series: DataFrame, keys: Sequence[str], seasonal: str | None, linear: Sequence[str],
                 period: int) -> DataFrame:
    """One row per series, in two aggregates of one scan: last month, the line of each
    ``linear`` measure, and for ``seasonal`` the common slope with each phase's means.

    The slope pools the phases' centred sums; a phase's level is ``avg(y) - b avg(t)``."""
    keys = list(keys)
    t = F.col("t").cast("double")

    # sums that combine over phases: (n, sum t, sum y, sum tt, sum ty) of each linear measure
    def sums(c: str) -> Column:
        y = F.col(c).cast("double")
        has = y.isNotNull()
        return F.struct(F.count(y).cast("double").alias("n"), F.sum(F.when(has, t)).alias("t"), F.sum(y).alias("y"),
                        F.sum(F.when(has, t * t)).alias("tt"), F.sum(t * y).alias("ty")).alias(f"s_{c}")

    aggs = [F.max("t").alias("t_last"), F.max("month").alias("m_last"), *[sums(c) for c in linear]]
    if seasonal:
        y = F.col(seasonal).cast("double")
        ts = F.when(y.isNotNull(), t)
        aggs += [F.avg(y).alias("my"), F.avg(ts).alias("mt"), F.count(y).alias("ny"),
                 (F.covar_pop(y, ts) * F.count(y)).alias("cty"), (F.var_pop(ts) * F.count(y)).alias("ctt")]
    by_phase = series.groupBy(*keys, (F.col("t") % period if seasonal else F.lit(0)).alias("phase")).agg(*aggs)

    def line(c: str) -> list[Column]:
        n, st, sy, stt, sty = (F.sum(F.col(f"s_{c}.{k}")) for k in ("n", "t", "y", "tt", "ty"))
        slope = F.try_divide(n * sty - st * sy, n * stt - st * st)
        return [slope.alias(f"b_{c}"), F.try_divide(sy - slope * st, n).alias(f"a_{c}")]

    outs = [F.max("t_last").alias("t_last"), F.max("m_last").alias("m_last"), *[x for c in linear for x in line(c)]]
    if seasonal:
        level = F.struct("my", "mt")
        outs += [F.try_divide(F.sum("cty"), F.sum("ctt")).alias("b"),
                 F.map_from_entries(F.collect_list(F.when(F.col("ny") > 0, F.struct("phase", level)))).alias("levels")]
    return by_phase.groupBy(*keys).agg(*outs)


def _line_at(c: str, t: Column) -> Column:
    return F.col(f"a_{c}") + F.col(f"b_{c}") * t.cast("double")


def _season_at(t: Column, period: int) -> Column:
    at = F.col("levels")[t % period]
    return at["my"] + F.col("b") * (t.cast("double") - at["mt"])


def holt_linear(series: DataFrame, value: str, keys: Sequence[str] = (), horizon: int = 3) -> DataFrame:
    """F4 (``mode="ols"``): a least-squares line, the alpha = 0 limit of Holt's linear
    trend, ``intercept + slope * (n - 1 + h)``. ``(keys..., h, t, month, forecast)``;
    NULL where a series has fewer than two months."""
    keys = list(keys)
    fit = _regressions(series.filter(F.col(value).isNotNull()), keys, None, [value], 1).withColumn("h", _horizon(horizon))
    t = F.col("t_last") + F.col("h")
    return fit.select(*keys, "h", t.alias("t"), F.add_months("m_last", F.col("h")).alias("month"),
                      _line_at(value, t).alias("forecast"))


def holt_winters(series: DataFrame, value: str, keys: Sequence[str] = (), period: int = 12,
                 horizon: int = 3) -> DataFrame:
    """F3 (``mode="ols"``): the alpha = 0 limit of additive Holt-Winters: common slope
    ``b`` fitted on values centred within each phase, one level per phase
    ``a_k = avg(y - b t)``; forecast ``a_k + b (n - 1 + h)``, NULL for a phase that was
    never seen and for a series in which no phase was seen twice."""
    keys = list(keys)
    fit = _regressions(series.filter(F.col(value).isNotNull()), keys, value, [], period).withColumn("h", _horizon(horizon))
    t = F.col("t_last") + F.col("h")
    return fit.select(*keys, "h", t.alias("t"), F.add_months("m_last", F.col("h")).alias("month"),
                      _season_at(t, period).alias("forecast"))


# --- mode="optimize": least-squares Holt(-Winters) -----------------------------------------------
def _hw_design(y: np.ndarray, alpha: float, beta: float, gamma: float, period: int):
    """One-step predictions as affine functions of the initial states
    z = (l0, b0, s_{-m}..s_{-1}): returns (A, c, final-state maps)."""
    m = period
    dim = 2 + m
    lvl = np.zeros(dim + 1); lvl[0] = 1.0          # [coefficients..., constant]
    trd = np.zeros(dim + 1); trd[1] = 1.0
    seas = [np.eye(dim + 1)[2 + i] for i in range(m)] if m else []
    rows = []
    for t, yt in enumerate(y):
        s_prev = seas[t % m] if m else np.zeros(dim + 1)
        pred = lvl + trd + s_prev
        rows.append(pred)
        if np.isnan(yt):  # a missing month: the states move on by themselves
            lvl = lvl + trd
            continue
        yv = np.zeros(dim + 1); yv[-1] = yt
        new_l = alpha * (yv - s_prev) + (1 - alpha) * (lvl + trd)
        new_b = beta * (new_l - lvl) + (1 - beta) * trd
        if m:
            seas[t % m] = gamma * (yv - lvl - trd) + (1 - gamma) * s_prev
        lvl, trd = new_l, new_b
    P = np.array(rows)
    return P[:, :-1], P[:, -1], lvl, trd, seas


def _grid(grid: int, seasonal: bool) -> list[tuple[float, float, float]]:
    """(alpha, beta, gamma) with beta <= alpha and gamma <= 1 - alpha."""
    steps = [i / (grid - 1) for i in range(grid)]
    return [(a, b, g) for a in steps for b in steps if b <= a + 1e-12
            for g in (steps if seasonal else [0.0]) if g <= 1 - a + 1e-12]


def _fit_one(y: np.ndarray, a: float, b: float, g: float, period: int, horizon: int) -> tuple[float, list[float]]:
    """(sum of squared one-step errors, forecasts) with least-squares initial states."""
    A, c, lvl, trd, seas = _hw_design(y, a, b, g, period)
    known = ~np.isnan(y)
    z, *_ = np.linalg.lstsq(A[known], y[known] - c[known], rcond=None)
    sse = float(np.sum((y[known] - c[known] - A[known] @ z) ** 2))
    z = np.append(z, 1.0)
    n = len(y)
    return sse, [float((lvl + h * trd + (seas[(n + h - 1) % period] if period else 0.0)) @ z) for h in range(1, horizon + 1)]


def fit_smoothing(series: DataFrame, value: str, keys: Sequence[str] = (), period: int = 0, horizon: int = 3,
                  grid: int = 21) -> DataFrame:
    """F3/F4 (``mode="optimize"``): ``(keys..., h, t, month, forecast, alpha, beta,
    gamma, sse)``. A series travels as one array of its months (bounded by the
    calendar) to each point of the grid; missing months are stepped over. Errors that
    agree to nine digits count as ties, and the smallest parameters win."""
    keys = list(keys)
    whole = complete_calendar(series.filter(F.col(value).isNotNull()), keys, [value])
    packed = whole.groupBy(*keys).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("t", F.coalesce(F.col(value).cast("double"), F.lit(float("nan"))).alias("y")))),
                    lambda x: x["y"]).alias("y"),
        F.max("t").alias("t_last"), F.max("month").alias("m_last"))
    points = F.array(*[F.struct(F.lit(a).alias("alpha"), F.lit(b).alias("beta"), F.lit(g).alias("gamma"))
                       for a, b, g in _grid(grid, period > 0)])
    spread = packed.select(*keys, "y", "t_last", "m_last", F.inline(points))
    spread = spread.repartition(*keys, "alpha", "beta", "gamma")  # a single series fills all tasks
    schema = T.StructType([*spread.drop("y").schema.fields, T.StructField("sse", T.DoubleType()),
                           T.StructField("ahead", T.ArrayType(T.DoubleType()))])

    def fit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            got = [_fit_one(np.asarray(y, float), a, b, g, period, horizon)
                   for y, a, b, g in zip(pdf["y"], pdf["alpha"], pdf["beta"], pdf["gamma"], strict=True)]
            yield pdf.drop(columns="y").assign(sse=[x[0] for x in got], ahead=[x[1] for x in got])

    fitted = spread.mapInPandas(fit, schema)
    digits = F.floor(F.log10(F.greatest("sse", F.lit(1e-12))))  # nine significant digits
    rounded = F.round(F.col("sse") / F.pow(F.lit(10.0), digits - 8)) * F.pow(F.lit(10.0), digits - 8)
    best = fitted.groupBy(*keys).agg(F.min_by(
        F.struct("t_last", "m_last", "ahead", "alpha", "beta", "gamma", "sse"),
        F.struct(rounded, "alpha", "beta", "gamma")).alias("w"))
    out = best.select(*keys, "w.*").withColumn("h", _horizon(horizon))
    return out.select(*keys, "h", (F.col("t_last") + F.col("h")).alias("t"), F.add_months("m_last", F.col("h")).alias("month"),
                      F.get("ahead", F.col("h") - 1).alias("forecast"), "alpha", "beta", "gamma", "sse")


def fit_forecast(series: DataFrame, value: str, keys: Sequence[str] = (), period: int = 0,
                 horizon: int = 3, mode: str = "ols", grid: int = 21) -> DataFrame:
    """F3/F4 dispatcher. ``period=0`` is Holt linear, ``period>0`` Holt-Winters."""
    if mode == "ols":
        return (holt_winters(series, value, keys, period, horizon) if period
                else holt_linear(series, value, keys, horizon))
    if mode == "refine":
        from .smoothing import holt_winters_refined
        return holt_winters_refined(series, value, keys, period, horizon)
    return fit_smoothing(series, value, keys, period, horizon, grid)


def _three_forecasts(series: DataFrame, keys: Sequence[str], horizon: int, period: int, mode: str,
                     grid: int) -> DataFrame:
    """``(keys..., month, fo, ff, fr)``: every (series, h), whatever could be fitted."""
    keys = list(keys)
    if mode == "ols":  # all three measures from one pass over the series
        fit = _regressions(series, keys, "orders", ["fraud_rate", "return_rate"], period).withColumn("h", _horizon(horizon))
        t = F.col("t_last") + F.col("h")
        return fit.select(*keys, F.add_months("m_last", F.col("h")).alias("month"), _season_at(t, period).alias("fo"),
                          _line_at("fraud_rate", t).alias("ff"), _line_at("return_rate", t).alias("fr"))
    series = materialize(series)
    every = series.groupBy(*keys).agg(F.max("month").alias("m_last")).withColumn("h", _horizon(horizon)).select(
        *keys, F.add_months("m_last", F.col("h")).alias("month"))
    for value, name, season in (("orders", "fo", period), ("fraud_rate", "ff", 0), ("return_rate", "fr", 0)):
        one = fit_forecast(series, value, keys, season, horizon, mode, grid).select(*keys, "month", F.col("forecast").alias(name))
        every = every.join(one, [*keys, "month"], "left")
    return every


def forecast_table(series: DataFrame, keys: Sequence[str] = (), horizon: int = 3, period: int = 12,
                   mode: str = "ols", grid: int = 21) -> DataFrame:
    """``(keys..., forecast_month, forecasted_orders, forecasted_fraud_rate_pct,
    forecasted_return_rate_pct, status)``: orders by Holt-Winters (0 dp), rates by
    Holt linear (percent, 2 dp), aligned on the forecast month (J2). Every series has
    all its ``horizon`` rows; what is too short to be fitted is NULL, and ``status``
    says so."""
    keys = list(keys)
    f = _three_forecasts(series, keys, horizon, period, mode, grid)
    fitted = F.col("fo").isNotNull() & F.col("ff").isNotNull() & F.col("fr").isNotNull()
    return (f.select(*keys, F.date_format("month", "yyyy-MM").alias("forecast_month"),
                     np_round("fo", 0).alias("forecasted_orders"),
                     np_round(F.col("ff") * F.lit(100.0), 2).alias("forecasted_fraud_rate_pct"),
                     np_round(F.col("fr") * F.lit(100.0), 2).alias("forecasted_return_rate_pct"),
                     F.when(fitted, "fitted").otherwise("too short").alias("status"))
            .orderBy(*keys, "forecast_month"))


def actual_vs_forecast(series: DataFrame, keys: Sequence[str] = (), horizon: int = 3,
                       period: int = 12, mode: str = "ols", grid: int = 21) -> DataFrame:
    """the data behind the actual-vs-forecast chart:
    ``(keys..., kind, month, orders, fraud_rate_pct, return_rate_pct)``."""
    keys = list(keys)
    series = materialize(series)  # one row per series and month: read for both kinds
    actual = series.select(*keys, F.lit("actual").alias("kind"), "month", F.col("orders").cast("double").alias("orders"),
                           (F.col("fraud_rate") * 100.0).alias("fraud_rate_pct"),
                           (F.col("return_rate") * 100.0).alias("return_rate_pct"))
    f = _three_forecasts(series, keys, horizon, period, mode, grid)
    fc = f.select(*keys, F.lit("forecast").alias("kind"), "month", F.col("fo").alias("orders"),
                  (F.col("ff") * 100.0).alias("fraud_rate_pct"), (F.col("fr") * 100.0).alias("return_rate_pct"))
    return actual.unionByName(fc).orderBy(*keys, "month", "kind")
