"""Registered queries: name -> (Spark builder, DuckDB oracle SQL or None).

Every query reads the driver tables under ``sf_dir`` (through the
``order_risk`` mapping), so its work grows with the data. Keys start with the
SURVEY §2 operator ID they exercise.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators import scorecard as sc
from ..oracle import ORDER_RISK_SELECT, with_order_risk
from ..sources import order_risk as _raw_order_risk
from ..sources import prepared_order_risk as order_risk

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLE: dict[str, str] = {}

DIMS = sc.RISK_DIMENSIONS


def register(name: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = with_order_risk(sql)
        return fn
    return deco


def _union_scorecards_sql() -> str:
    parts = []
    for d in DIMS:
        parts.append(
            f"SELECT '{d}' AS dimension, CAST({d} AS VARCHAR) AS segment, count(order_id) AS orders, "
            f"round_even(avg(is_fraud) * 100.0, 2) AS fraud_rate_pct, "
            f"round_even(avg(is_returned) * 100.0, 2) AS return_rate_pct, "
            f"CAST(sum(CAST(order_value_eur AS DECIMAL(38,9))) AS DOUBLE) / count(order_value_eur) AS avg_order_value, "
            f"CAST(sum(CAST(review_score AS DECIMAL(38,9))) AS DOUBLE) / count(review_score) AS avg_review_score "
            f"FROM order_risk WHERE {d} IS NOT NULL GROUP BY {d}")
    return "\nUNION ALL\n".join(parts)


# --- S1/S2: the source table itself -------------------------------------------------------------
@register("S1_order_risk", ORDER_RISK_SELECT)
def q_order_risk(spark, sf_dir):
    return _raw_order_risk(spark, sf_dir)


@register("V7_mapping_losses", """
SELECT f.name AS "check", CAST(count(l.fate) AS BIGINT) AS orders
FROM (VALUES ('without_lines'), ('without_customer'), ('without_nation'), ('without_part'), ('without_supplier'),
             ('kept')) AS f(name)
LEFT JOIN (
  SELECT CASE WHEN a.l_orderkey IS NULL THEN 'without_lines' WHEN c.c_custkey IS NULL THEN 'without_customer'
              WHEN n.n_nationkey IS NULL THEN 'without_nation' WHEN p.p_partkey IS NULL THEN 'without_part'
              WHEN s.s_suppkey IS NULL THEN 'without_supplier' ELSE 'kept' END AS fate
  FROM orders o LEFT JOIN line_agg a ON a.l_orderkey = o.o_orderkey LEFT JOIN customer c ON c.c_custkey = o.o_custkey
  LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey LEFT JOIN part p ON p.p_partkey = a.partkey
  LEFT JOIN supplier s ON s.s_suppkey = a.suppkey) l ON l.fate = f.name
GROUP BY f.name""")
def q_mapping_losses(spark, sf_dir):
    t = [read_table(spark, sf_dir, name) for name in ("orders", "lineitem", "customer", "nation", "part", "supplier")]
    return mapping_losses(*t)


# --- A1 ------------------------------------------------------------------------------------------
@register("A1_enterprise_rates", """
SELECT round_even(avg(is_fraud) * 100.0, 2) AS fraud_rate_pct,
       round_even(avg(is_returned) * 100.0, 2) AS return_rate_pct,
       round_even(avg(CASE WHEN risk_label IS DISTINCT FROM 'Normal' THEN 1 ELSE 0 END) * 100.0, 2)
         AS combined_high_risk_rate_pct
FROM order_risk""")
def q_enterprise_rates(spark, sf_dir):
    return sc.enterprise_rates(order_risk(spark, sf_dir))


# --- A2 ------------------------------------------------------------------------------------------
@register("A2_risk_scorecards", _union_scorecards_sql())
def q_risk_scorecards(spark, sf_dir):
    return sc.risk_scorecards(order_risk(spark, sf_dir))


@register("A2_scorecard_payment_method", """
SELECT payment_method AS segment, count(order_id) AS orders,
       round_even(avg(is_fraud) * 100.0, 2) AS fraud_rate_pct,
       round_even(avg(is_returned) * 100.0, 2) AS return_rate_pct,
       CAST(sum(CAST(order_value_eur AS DECIMAL(38,9))) AS DOUBLE) / count(order_value_eur) AS avg_order_value,
       CAST(sum(CAST(review_score AS DECIMAL(38,9))) AS DOUBLE) / count(review_score) AS avg_review_score
FROM order_risk WHERE payment_method IS NOT NULL GROUP BY payment_method""")
def q_scorecard_payment(spark, sf_dir):
    return sc.risk_scorecard(order_risk(spark, sf_dir), "payment_method")


# --- B1/B2 ---------------------------------------------------------------------------------------
_BREACH_SQL = """
WITH cards AS ({cards})
SELECT dimension, segment, fraud_rate_pct, orders FROM cards
WHERE fraud_rate_pct > (SELECT avg(is_fraud) * 100.0 * {mult} FROM order_risk)"""


@register("B1_breach_log", _BREACH_SQL.format(cards=_union_scorecards_sql(), mult="2.0"))
def q_breach_log(spark, sf_dir):
    df = order_risk(spark, sf_dir)
    return sc.breach_log(sc.risk_scorecards(df), df, multiplier=2.0)


@register("B1_breach_log_x1_2", _BREACH_SQL.format(cards=_union_scorecards_sql(), mult="1.2"))
def q_breach_log_12(spark, sf_dir):
    df = order_risk(spark, sf_dir)
    return sc.breach_log(sc.risk_scorecards(df), df, multiplier=1.2)


# --- A3 ------------------------------------------------------------------------------------------
@register("A3_monthly_trend", """
SELECT strftime(order_date, '%Y-%m') AS month, count(order_id) AS orders,
       round_even(avg(is_fraud) * 100.0, 2) AS fraud_rate_pct,
       round_even(avg(is_returned) * 100.0, 2) AS return_rate_pct
FROM order_risk WHERE order_date IS NOT NULL GROUP BY 1""")
def q_monthly_trend(spark, sf_dir):
    return sc.monthly_trend(order_risk(spark, sf_dir))


# --- A5 ------------------------------------------------------------------------------------------
@register("A5_device_rates", """
SELECT device_type, avg(is_fraud) * 100.0 AS is_fraud, avg(is_returned) * 100.0 AS is_returned
FROM order_risk WHERE device_type IS NOT NULL GROUP BY device_type""")
def q_device_rates(spark, sf_dir):
    return sc.segment_rates(order_risk(spark, sf_dir), "device_type")


# --- A6 ------------------------------------------------------------------------------------------
_VC_COLS = ("risk_label", "country", "device_type", "traffic_source", "payment_method")


@register("A6_value_counts", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value, count(*) AS count "
    f"FROM order_risk WHERE {c} IS NOT NULL GROUP BY {c}" for c in _VC_COLS))
def q_value_counts(spark, sf_dir):
    return sc.value_counts(order_risk(spark, sf_dir), _VC_COLS)


# --- V1-V7 validation ----------------------------------------------------------------------------
from ..oracle import long_cte, quantile_ctes  # noqa: E402
from ..operators import profile as pf  # noqa: E402
from ..operators import validate as vd  # noqa: E402
from ..sources import mapping_losses, read_table  # noqa: E402


@register("V7_validation_log", """
SELECT * FROM (VALUES
  ('total_records', (SELECT CAST(count(*) AS VARCHAR) FROM order_risk)),
  ('duplicate_order_ids', (SELECT CAST(count(*) - count(DISTINCT order_id)
                                  - max(CASE WHEN order_id IS NULL THEN 1 ELSE 0 END) AS VARCHAR) FROM order_risk)),
  ('missing_values', (SELECT CAST(""" + " + ".join(
    f"count(*) FILTER (WHERE {c} IS NULL{' OR isnan(' + c + ')' if c in ('avg_order_value_eur', 'order_value_eur', 'discount_rate', 'shipping_distance_km', 'review_score') else ''})"
    for c in ("order_id", "order_date", "country", "payment_method", "product_category", "device_type",
              "traffic_source", "customer_age_days", "previous_orders", "avg_order_value_eur",
              "order_value_eur", "quantity", "discount_rate", "shipping_distance_km",
              "delivery_days_estimated", "late_delivery_risk", "address_mismatch", "high_risk_ip",
              "customer_support_contacts", "review_score", "is_returned", "is_fraud", "risk_label")) + """ AS VARCHAR) FROM order_risk)),
  ('negative_order_values', (SELECT CAST(count(*) FILTER (WHERE order_value_eur < 0) AS VARCHAR) FROM order_risk)),
  ('review_score_out_of_range', (SELECT CAST(count(*) FILTER (WHERE NOT isnan(review_score)
                                   AND (review_score < 0 OR review_score > 5)) AS VARCHAR) FROM order_risk)),
  ('date_range', (SELECT CAST(min(order_date) AS VARCHAR) || ' to ' || CAST(max(order_date) AS VARCHAR) FROM order_risk))
) AS t("check", value)""")
def q_validation_log(spark, sf_dir):
    return vd.validation_log(order_risk(spark, sf_dir))


# lineitem keys (l_orderkey, l_linenumber) repeat in the driver data: exercises V2 for real.
_LI_VALIDATION = """
SELECT * FROM (VALUES
  ('total_records', (SELECT CAST(count(*) AS VARCHAR) FROM lineitem)),
  ('duplicate_line_keys', (SELECT CAST((SELECT count(*) FROM lineitem)
                               - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS VARCHAR))),
  ('missing_values', (SELECT CAST(""" + " + ".join(
    f"count(*) FILTER (WHERE {c} IS NULL{' OR isnan(' + c + ')' if c in ('l_quantity', 'l_extendedprice', 'l_discount', 'l_tax') else ''})"
    for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
              "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")) + """ AS VARCHAR) FROM lineitem)),
  ('negative_prices', (SELECT CAST(count(*) FILTER (WHERE l_extendedprice < 0) AS VARCHAR) FROM lineitem)),
  ('discount_out_of_range', (SELECT CAST(count(*) FILTER (WHERE NOT isnan(l_discount)
                               AND (l_discount < 0 OR l_discount > 0.05)) AS VARCHAR) FROM lineitem)),
  ('date_range', (SELECT CAST(min(CAST(l_shipdate AS DATE)) AS VARCHAR) || ' to '
                         || CAST(max(CAST(l_shipdate AS DATE)) AS VARCHAR) FROM lineitem))
) AS t("check", value)"""
QUERIES["V7_lineitem_validation"] = lambda spark, sf_dir: vd.validation_log(
    read_table(spark, sf_dir, "lineitem"), key=["l_orderkey", "l_linenumber"], amount="l_extendedprice",
    score="l_discount", lo=0.0, hi=0.05, date="l_shipdate", key_name="duplicate_line_keys",
    amount_name="negative_prices", score_name="discount_out_of_range")
ORACLE["V7_lineitem_validation"] = _LI_VALIDATION


@register("V2_duplicate_line_keys")
def q_duplicate_line_keys(spark, sf_dir):
    return vd.duplicate_keys(read_table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


ORACLE["V2_duplicate_line_keys"] = """
SELECT l_orderkey, l_linenumber, count(*) AS copies, count(*) - 1 AS extra_copies
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"""


@register("V3_missing_by_column", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS missing FROM order_risk"
    for c in ("order_id", "order_date", "country", "payment_method", "product_category", "device_type",
              "traffic_source", "customer_age_days", "previous_orders", "avg_order_value_eur",
              "order_value_eur", "quantity", "discount_rate", "shipping_distance_km",
              "delivery_days_estimated", "late_delivery_risk", "address_mismatch", "high_risk_ip",
              "customer_support_contacts", "review_score", "is_returned", "is_fraud", "risk_label")))
def q_missing_by_column(spark, sf_dir):
    return vd.missing_by_column(order_risk(spark, sf_dir))


# --- A7-A13 profiling ----------------------------------------------------------------------------
def _q_pick(p: float) -> str:
    return f"(SELECT qv FROM qv WHERE qv.col = s.col AND qv.prob = CAST({p!r} AS DOUBLE))"


@register("A7_numeric_summary", f"""
WITH long AS ({long_cte(pf.NUMERIC_SUMMARY_COLS)}),
{quantile_ctes([0.25, 0.5, 0.75])}
SELECT s.col AS "column", s.n AS count, round_even(s.mean, 6) AS mean, round_even(s.std, 6) AS std,
       s.mn AS min, {_q_pick(0.25)} AS p25, {_q_pick(0.5)} AS p50, {_q_pick(0.75)} AS p75, s.mx AS max
FROM stats s""")
def q_numeric_summary(spark, sf_dir):
    return pf.numeric_summary(order_risk(spark, sf_dir))


@register("A8_iqr_outliers", f"""
WITH long AS ({long_cte(pf.OUTLIER_COLS)}),
{quantile_ctes([0.25, 0.75])},
b AS (SELECT s.col, {_q_pick(0.25)} AS q1, {_q_pick(0.75)} AS q3 FROM stats s),
f AS (SELECT col, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM b),
c AS (SELECT f.col, count(*) FILTER (WHERE l.value < f.lower OR l.value > f.upper) AS n_outliers
      FROM f JOIN long l ON l.col = f.col GROUP BY f.col)
SELECT f.col AS "column", round_even(f.lower, 2) AS lower_bound, round_even(f.upper, 2) AS upper_bound,
       c.n_outliers, round_even(c.n_outliers / (SELECT count(*) FROM order_risk) * 100.0, 2) AS pct_outliers
FROM f JOIN c USING (col)""")
def q_iqr_outliers(spark, sf_dir):
    return pf.iqr_outliers(order_risk(spark, sf_dir))


def _corr_sql(cols) -> str:
    parts = []
    for i, a in enumerate(cols):
        for b in cols[i:]:
            xa = f"CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN CAST({a} AS DOUBLE) END"
            xb = f"CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN CAST({b} AS DOUBLE) END"
            expr = f"round_even(covar_pop({xa}, {xb}) / nullif(stddev_pop({xa}) * stddev_pop({xb}), 0.0), 6)"
            parts.append(f"SELECT '{a}' AS a, '{b}' AS b, {expr} AS corr FROM order_risk")
            if a != b:
                parts.append(f"SELECT '{b}' AS a, '{a}' AS b, {expr} AS corr FROM order_risk")
    return "\nUNION ALL\n".join(parts)


@register("A10_correlation_matrix", _corr_sql(list(pf.CORR_COLS)))
def q_correlation(spark, sf_dir):
    return pf.correlation_matrix(order_risk(spark, sf_dir))


@register("A11_histogram", f"""
WITH long AS ({long_cte(pf.DIST_COLS)}),
r AS (SELECT col, min(value) AS mn, max(value) AS mx FROM long GROUP BY col),
b AS (SELECT l.col,
             CASE WHEN r.mx - r.mn = 0 THEN 0
                  ELSE least(CAST(floor((l.value - r.mn) / (r.mx - r.mn) * CAST(20.0 AS DOUBLE)) AS INTEGER), 19) END AS bin
      FROM long l JOIN r USING (col)),
c AS (SELECT col, bin, count(*) AS cnt FROM b GROUP BY col, bin),
e AS (SELECT unnest([{", ".join(f"'{c}'" for c in pf.DIST_COLS)}]) AS col),
g AS (SELECT e.col, r.mn, r.mx, CAST(unnest(range(0, 20)) AS INTEGER) AS bin FROM e LEFT JOIN r ON r.col = e.col)
SELECT g.col AS "column", g.bin, mn + g.bin * ((mx - mn) / CAST(20.0 AS DOUBLE)) AS bin_lo,
       mn + (g.bin + 1) * ((mx - mn) / CAST(20.0 AS DOUBLE)) AS bin_hi, coalesce(c.cnt, 0) AS count
FROM g LEFT JOIN c ON c.col = g.col AND c.bin = g.bin""")
def q_histogram(spark, sf_dir):
    return pf.histogram(order_risk(spark, sf_dir), bins=20)


@register("A12_density")
def q_density(spark, sf_dir):
    from pyspark.sql import functions as F
    from ..functions import np_round
    d = pf.density(order_risk(spark, sf_dir), points=64)
    return d.select("column", "point", np_round("x", 9).alias("x"), np_round(F.col("density") * 1e6, 4).alias("density_x1e6"))


# the whole kernel sum over the values' bins of an eighth of the bandwidth
ORACLE["A12_density"] = with_order_risk(f"""
WITH long AS ({long_cte(pf.DIST_COLS)}),
r AS (SELECT col, min(value) AS mn, max(value) AS mx, count(value) AS n,
             stddev_samp(value) * pow(CAST(count(value) AS DOUBLE), CAST(-0.2 AS DOUBLE)) AS h
      FROM long GROUP BY col),
cnt AS (SELECT l.col, floor((l.value - r.mn) / (r.h / CAST(8.0 AS DOUBLE))) AS bin, count(*) AS cnt
        FROM long l JOIN r USING (col) WHERE r.h > 0 GROUP BY 1, 2),
g AS (SELECT col, mn, mx, n, h, unnest(range(0, 64)) AS point FROM r WHERE h > 0),
z AS (SELECT g.col, g.point, g.mn, g.mx, g.n, g.h, c.cnt,
             (g.point * ((g.mx - g.mn) / CAST(63.0 AS DOUBLE)) - (c.bin + 0.5) * (g.h / CAST(8.0 AS DOUBLE))) / g.h AS z
      FROM g JOIN cnt c USING (col)),
s AS (SELECT col, point, mn, mx, n, h, sum(CASE WHEN abs(z) <= 6.0 THEN cnt * exp(-0.5 * z * z) ELSE 0 END) AS s
      FROM z GROUP BY col, point, mn, mx, n, h)
SELECT col AS "column", CAST(point AS INTEGER) AS point,
       round_even(mn + point * ((mx - mn) / CAST(63.0 AS DOUBLE)), 9) AS x,
       round_even(s * (CAST(0.3989422804014327 AS DOUBLE) / (n * h)) * 1e6, 4) AS density_x1e6
FROM s""")


@register("A13_box_stats", f"""
WITH long AS ({long_cte(("order_value_eur", "review_score"), group="risk_label")}),
{quantile_ctes([0.25, 0.5, 0.75], group=True)},
q AS (SELECT s.grp, s.col, s.n,
             (SELECT qv FROM qv WHERE qv.grp = s.grp AND qv.col = s.col AND qv.prob = 0.25) AS q1,
             (SELECT qv FROM qv WHERE qv.grp = s.grp AND qv.col = s.col AND qv.prob = 0.5) AS median,
             (SELECT qv FROM qv WHERE qv.grp = s.grp AND qv.col = s.col AND qv.prob = 0.75) AS q3
      FROM stats s),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo_f, q3 + 1.5 * (q3 - q1) AS hi_f FROM q)
SELECT f.grp AS "group", f.col AS "column", f.n, f.q1, f.median, f.q3,
       min(l.value) FILTER (WHERE l.value >= f.lo_f AND l.value <= f.hi_f) AS whisker_low,
       max(l.value) FILTER (WHERE l.value >= f.lo_f AND l.value <= f.hi_f) AS whisker_high,
       count(*) FILTER (WHERE NOT (l.value >= f.lo_f AND l.value <= f.hi_f)) AS n_fliers
FROM f JOIN long l ON l.grp = f.grp AND l.col = f.col
GROUP BY f.grp, f.col, f.n, f.q1, f.median, f.q3""")
def q_box_stats(spark, sf_dir):
    return pf.box_stats(order_risk(spark, sf_dir), "risk_label", ("order_value_eur", "review_score"))


# --- A4, F1-F6 forecasting -----------------------------------------------------------------------
from ..functions import np_round as _npr  # noqa: E402
from ..operators import forecast as fc  # noqa: E402
from pyspark.sql import functions as _F  # noqa: E402

_SERIES_SQL = """
monthly AS (
  SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, count(order_id) AS orders,
         avg(is_fraud) AS fraud_rate, avg(is_returned) AS return_rate
  FROM order_risk WHERE order_date IS NOT NULL GROUP BY 1),
series AS (
  SELECT *, CAST(date_diff('month', min(month) OVER (), month) AS INTEGER) AS t FROM monthly)"""


def _series(spark, sf_dir):
    return fc.monthly_series(order_risk(spark, sf_dir))


@register("A4_monthly_series", f"WITH {_SERIES_SQL}\nSELECT month, t, orders, fraud_rate, return_rate FROM series")
def q_monthly_series(spark, sf_dir):
    return _series(spark, sf_dir).select("month", "t", "orders", "fraud_rate", "return_rate")


@register("F1_complete_calendar", f"""WITH {_SERIES_SQL},
cal AS (SELECT CAST(unnest(generate_series((SELECT min(month) FROM series), (SELECT max(month) FROM series),
                                           INTERVAL 1 MONTH)) AS DATE) AS month)
SELECT cal.month, CAST(date_diff('month', (SELECT min(month) FROM series), cal.month) AS INTEGER) AS t,
       s.orders, s.fraud_rate, s.return_rate
FROM cal LEFT JOIN series s ON s.month = cal.month""")
def q_complete_calendar(spark, sf_dir):
    return fc.complete_calendar(_series(spark, sf_dir))


@register("F2_seasonal_decompose", f"""WITH {_SERIES_SQL},
d AS (
  SELECT month, t, CAST(orders AS DOUBLE) AS observed,
         CASE WHEN count(orders) OVER (ORDER BY t ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING) = 13
              THEN (CAST(0.5 AS DOUBLE) * lag(CAST(orders AS DOUBLE), 6) OVER (ORDER BY t)
                    + sum(CAST(orders AS DOUBLE)) OVER (ORDER BY t ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING)
                    + CAST(0.5 AS DOUBLE) * lead(CAST(orders AS DOUBLE), 6) OVER (ORDER BY t)) / CAST(12.0 AS DOUBLE)
         END AS trend,
         t % 12 AS phase
  FROM series),
pm AS (SELECT phase, avg(observed - trend) AS pm FROM d GROUP BY phase),
ps AS (SELECT phase, pm - avg(pm) OVER () AS seasonal FROM pm)
SELECT d.month, d.t, d.observed, round_even(d.trend, 6) AS trend, round_even(ps.seasonal, 6) AS seasonal,
       round_even(d.observed - d.trend - ps.seasonal, 6) AS resid
FROM d LEFT JOIN ps USING (phase)""")
def q_seasonal_decompose(spark, sf_dir):
    d = fc.seasonal_decompose(_series(spark, sf_dir), "orders")
    return d.select("month", "t", "observed", _npr("trend", 6).alias("trend"),
                    _npr("seasonal", 6).alias("seasonal"), _npr("resid", 6).alias("resid"))


_HW_SQL = f"""WITH {_SERIES_SQL},
s AS (SELECT month, t, CAST(orders AS DOUBLE) AS y, t % 12 AS k FROM series),
c AS (SELECT *, y - avg(y) OVER (PARTITION BY k) AS yc,
             CAST(t AS DOUBLE) - avg(CAST(t AS DOUBLE)) OVER (PARTITION BY k) AS tc FROM s),
sl AS (SELECT sum(yc * tc) / nullif(sum(tc * tc), 0.0) AS b, max(t) AS t_last, max(month) AS m_last FROM c),
lv AS (SELECT k, avg(y - (SELECT b FROM sl) * CAST(t AS DOUBLE)) AS a FROM s GROUP BY k),
h AS (SELECT unnest([1, 2, 3]) AS h)
SELECT CAST(h.h AS INTEGER) AS h, CAST(sl.t_last + h.h AS INTEGER) AS t,
       CAST(sl.m_last + to_months(CAST(h.h AS INTEGER)) AS DATE) AS month,
       round_even(lv.a + sl.b * CAST(sl.t_last + h.h AS DOUBLE), 6) AS forecast
FROM sl, h JOIN lv ON lv.k = (sl.t_last + h.h) % 12"""


@register("F3_holt_winters_orders", _HW_SQL)
def q_holt_winters(spark, sf_dir):
    f = fc.fit_forecast(_series(spark, sf_dir), "orders", period=12, horizon=3, mode="ols")
    return f.select("h", "t", "month", _npr("forecast", 6).alias("forecast"))


@register("F4_holt_linear_fraud", f"""WITH {_SERIES_SQL},
fit AS (SELECT regr_intercept(fraud_rate, CAST(t AS DOUBLE)) AS a, regr_slope(fraud_rate, CAST(t AS DOUBLE)) AS b,
               max(t) AS t_last, max(month) AS m_last FROM series WHERE fraud_rate IS NOT NULL),
h AS (SELECT unnest([1, 2, 3]) AS h)
SELECT CAST(h.h AS INTEGER) AS h, CAST(t_last + h.h AS INTEGER) AS t,
       CAST(m_last + to_months(CAST(h.h AS INTEGER)) AS DATE) AS month,
       round_even(a + b * CAST(t_last + h.h AS DOUBLE), 6) AS forecast
FROM fit, h""")
def q_holt_linear(spark, sf_dir):
    f = fc.fit_forecast(_series(spark, sf_dir), "fraud_rate", period=0, horizon=3, mode="ols")
    return f.select("h", "t", "month", _npr("forecast", 6).alias("forecast"))


def _forecast_table_sql() -> str:
    lin = lambda col: f"""(SELECT regr_intercept({col}, CAST(t AS DOUBLE)) + regr_slope({col}, CAST(t AS DOUBLE))
                              * CAST((SELECT max(t) FROM series) + h.h AS DOUBLE) FROM series)"""
    return _HW_SQL.replace("SELECT CAST(h.h AS INTEGER) AS h, CAST(sl.t_last + h.h AS INTEGER) AS t,", "SELECT") \
        .replace("""       CAST(sl.m_last + to_months(CAST(h.h AS INTEGER)) AS DATE) AS month,
       round_even(lv.a + sl.b * CAST(sl.t_last + h.h AS DOUBLE), 6) AS forecast""",
                 f"""       strftime(CAST(sl.m_last + to_months(CAST(h.h AS INTEGER)) AS DATE), '%Y-%m') AS forecast_month,
       round_even(lv.a + sl.b * CAST(sl.t_last + h.h AS DOUBLE), 0) AS forecasted_orders,
       round_even({lin('fraud_rate')} * 100.0, 2) AS forecasted_fraud_rate_pct,
       round_even({lin('return_rate')} * 100.0, 2) AS forecasted_return_rate_pct,
       'fitted' AS status""")


@register("F5_forecast_table", _forecast_table_sql())
def q_forecast_table(spark, sf_dir):
    return fc.forecast_table(_series(spark, sf_dir), horizon=3, mode="ols")


@register("F5_forecast_by_country")
def q_forecast_by_country(spark, sf_dir):
    s = fc.monthly_series(order_risk(spark, sf_dir), keys=["country"])
    return fc.forecast_table(s, keys=["country"], horizon=3, mode="ols")


@register("F3_holt_winters_fit_by_country")
def q_holt_winters_fit_by_country(spark, sf_dir):
    s = fc.monthly_series(order_risk(spark, sf_dir), keys=["country"])
    return fc.fit_smoothing(s, "orders", ["country"], period=12, horizon=3, grid=6)


@register("F3_holt_winters_optimize")
def q_holt_winters_optimize(spark, sf_dir):
    return fc.fit_forecast(_series(spark, sf_dir), "orders", period=12, horizon=3, mode="optimize", grid=11)


@register("F6_actual_vs_forecast")
def q_actual_vs_forecast(spark, sf_dir):
    a = fc.actual_vs_forecast(_series(spark, sf_dir), horizon=3, mode="ols")
    return a.select("kind", "month", _npr("orders", 6).alias("orders"),
                    _npr("fraud_rate_pct", 6).alias("fraud_rate_pct"),
                    _npr("return_rate_pct", 6).alias("return_rate_pct"))


# --- M1-M7 association rules ---------------------------------------------------------------------
from ..operators import basket as mb  # noqa: E402

_ITEMS_SQL = """
items AS (
  SELECT order_id, list_sort(list_filter([""" + ", ".join(
    [f"'{c}_' || coalesce(CAST({c} AS VARCHAR), 'nan')" for c in mb.BASKET_CATS]
    + [f"CASE WHEN {f} = 1 THEN '{f}' END" for f in mb.BASKET_FLAGS]) + """], lambda x: x IS NOT NULL)) AS items
  FROM order_risk),
ntx AS (SELECT count(*) AS n FROM items),
ex AS (SELECT order_id, unnest(items) AS item FROM items),
f1 AS (SELECT item FROM ex GROUP BY item HAVING count(*) / (SELECT n FROM ntx) >= CAST(0.004 AS DOUBLE)),
fx AS (SELECT e.order_id, e.item FROM ex e JOIN f1 USING (item)),
sets AS (
  SELECT [a.item] AS itemset FROM fx a
  UNION ALL
  SELECT [a.item, b.item] FROM fx a JOIN fx b ON a.order_id = b.order_id AND a.item < b.item
  UNION ALL
  SELECT [a.item, b.item, c.item] FROM fx a
    JOIN fx b ON a.order_id = b.order_id AND a.item < b.item
    JOIN fx c ON c.order_id = a.order_id AND b.item < c.item),
itemsets AS (
  SELECT itemset, len(itemset) AS size, count(*) AS cnt, count(*) / (SELECT n FROM ntx) AS support
  FROM sets GROUP BY itemset HAVING count(*) / (SELECT n FROM ntx) >= CAST(0.004 AS DOUBLE)),
splits AS (
  SELECT itemset, support, mask,
         list_filter(itemset, lambda x, i: (mask >> (i - 1)) % 2 = 1) AS ante,
         list_filter(itemset, lambda x, i: (mask >> (i - 1)) % 2 = 0) AS cons
  FROM (SELECT itemset, support, unnest(generate_series(1, (1 << size) - 2)) AS mask
        FROM itemsets WHERE size >= 2)),
rules AS (
  SELECT s.ante, s.cons, a.support AS antecedent_support, c.support AS consequent_support, s.support,
         s.support / a.support AS confidence, s.support / a.support / c.support AS lift
  FROM splits s JOIN itemsets a ON a.itemset = s.ante JOIN itemsets c ON c.itemset = s.cons
  WHERE s.support / a.support / c.support >= CAST(1.0 AS DOUBLE))"""


def _baskets(spark, sf_dir):
    return mb.order_items(order_risk(spark, sf_dir))


@register("M1_order_items", f"WITH {_ITEMS_SQL}\nSELECT order_id, array_to_string(items, '|') AS items FROM items")
def q_order_items(spark, sf_dir):
    return _baskets(spark, sf_dir).select("order_id", _F.array_join("items", "|").alias("items"))


@register("M3_frequent_itemsets", f"""WITH {_ITEMS_SQL}
SELECT array_to_string(itemset, ', ') AS itemset, CAST(size AS INTEGER) AS size, cnt AS count, support FROM itemsets""")
def q_frequent_itemsets(spark, sf_dir):
    fs = mb.frequent_itemsets(_baskets(spark, sf_dir), 0.004, 3)
    return fs.select(_F.array_join("itemset", ", ").alias("itemset"), "size", "count", "support")


@register("M3_frequent_itemsets_fpgrowth", f"""WITH {_ITEMS_SQL}
SELECT array_to_string(itemset, ', ') AS itemset, CAST(size AS INTEGER) AS size, cnt AS count, support FROM itemsets""")
def q_frequent_itemsets_fp(spark, sf_dir):
    fs = mb.frequent_itemsets(_baskets(spark, sf_dir), 0.004, 3, method="fpgrowth")
    return fs.select(_F.array_join("itemset", ", ").alias("itemset"), "size", "count", "support")


@register("M4_association_rules", f"""WITH {_ITEMS_SQL}
SELECT array_to_string(ante, ', ') AS antecedents, array_to_string(cons, ', ') AS consequents,
       antecedent_support, consequent_support, support, confidence, lift FROM rules""")
def q_association_rules(spark, sf_dir):
    r = mb.association_rules(mb.frequent_itemsets(_baskets(spark, sf_dir), 0.004, 3), 1.0)
    return r.select(_F.array_join("antecedents", ", ").alias("antecedents"),
                    _F.array_join("consequents", ", ").alias("consequents"),
                    "antecedent_support", "consequent_support", "support", "confidence", "lift")


for _outcome in ("is_fraud", "is_returned"):
    def _mk(outcome):
        def q(spark, sf_dir):
            r = mb.association_rules(mb.frequent_itemsets(_baskets(spark, sf_dir), 0.004, 3), 1.0)
            return mb.outcome_rules(r, outcome)
        return q
    _name = "M5_fraud_rules" if _outcome == "is_fraud" else "M5_return_rules"
    register(_name, f"""WITH {_ITEMS_SQL}
SELECT array_to_string(ante, ', ') AS antecedents, array_to_string(cons, ', ') AS consequents,
       support, confidence, lift FROM rules WHERE list_contains(cons, '{_outcome}')""")(_mk(_outcome))


@register("M7_top_fraud_rules", f"""WITH {_ITEMS_SQL}
SELECT array_to_string(ante, ', ') AS antecedents, array_to_string(cons, ', ') AS consequents,
       support, confidence, lift FROM rules WHERE list_contains(cons, 'is_fraud')
ORDER BY lift DESC, antecedents, consequents LIMIT 10""")
def q_top_fraud_rules(spark, sf_dir):
    r = mb.association_rules(mb.frequent_itemsets(_baskets(spark, sf_dir), 0.004, 3), 1.0)
    return mb.top_rules(mb.outcome_rules(r, "is_fraud"), 10)


@register("M7_top_return_rules", f"""WITH {_ITEMS_SQL}
SELECT array_to_string(ante, ', ') AS antecedents, array_to_string(cons, ', ') AS consequents,
       support, confidence, lift FROM rules WHERE list_contains(cons, 'is_returned')
ORDER BY lift DESC, antecedents, consequents LIMIT 10""")
def q_top_return_rules(spark, sf_dir):
    r = mb.association_rules(mb.frequent_itemsets(_baskets(spark, sf_dir), 0.004, 3), 1.0)
    return mb.top_rules(mb.outcome_rules(r, "is_returned"), 10)


@register("M2_one_hot_counts", f"""WITH {_ITEMS_SQL},
v AS (SELECT item, count(*) AS present FROM ex GROUP BY item)
SELECT item, present, (SELECT n FROM ntx) AS n FROM v""")
def q_one_hot_counts(spark, sf_dir):
    """Each column of the one-hot matrix, summed: how many orders have the item."""
    wide = mb.one_hot(order_risk(spark, sf_dir))
    names = [c for c in wide.columns if c != "order_id"]
    sums = wide.agg(*[_F.count_if(_F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(names)],
                    _F.count(_F.lit(1)).alias("n"))
    rows = _F.array(*[_F.struct(_F.lit(c).alias("item"), _F.col(f"c{i}").alias("present")) for i, c in enumerate(names)])
    return sums.select(_F.inline(rows), "n").filter("present > 0")


# --- A14, L1-L13 evaluation and models -----------------------------------------------------------
from ..operators import evaluate as ev  # noqa: E402
from ..operators import model as ml  # noqa: E402

_ARITH_KEY_SQL = "(order_id * 7919) % 10007"
_CLASSES = ["Fraud Risk", "Normal", "Return Risk"]
# deterministic rule scorer (stands in for model output in exact, oracle-checked evaluation)
def _rule_pred():
    return (_F.when((_F.col("high_risk_ip") == 1) & (_F.col("address_mismatch") == 1), "Fraud Risk")
            .when(_F.col("high_risk_ip") == 1, "Fraud Risk").when(_F.col("late_delivery_risk") == 1, "Return Risk")
            .otherwise("Normal"))
_RULE_PRED_SQL = ("CASE WHEN high_risk_ip = 1 AND address_mismatch = 1 THEN 'Fraud Risk' "
                  "WHEN high_risk_ip = 1 THEN 'Fraud Risk' WHEN late_delivery_risk = 1 THEN 'Return Risk' "
                  "ELSE 'Normal' END")
def _flag_score():
    return (_F.col("high_risk_ip") * 0.5 + _F.col("address_mismatch") * 0.3
            + _F.col("late_delivery_risk") * 0.2)
_FLAG_SCORE_SQL = ("(high_risk_ip * CAST(0.5 AS DOUBLE) + address_mismatch * CAST(0.3 AS DOUBLE) "
                   "+ late_delivery_risk * CAST(0.2 AS DOUBLE))")


def _split_sql(label: str) -> str:
    return f"""
d AS (SELECT order_id, {label} AS lbl, {_ARITH_KEY_SQL} AS h FROM order_risk),
d2 AS (SELECT *, ((h % 64) + 64) % 64 AS b FROM d),
cnt AS (SELECT lbl, b, count(*) AS nb FROM d2 GROUP BY lbl, b),
offs AS (SELECT lbl, b, sum(nb) OVER (PARTITION BY lbl ORDER BY b) - nb AS off FROM cnt),
cls AS (SELECT lbl, sum(nb) AS nc FROM cnt GROUP BY lbl),
tot AS (SELECT count(*) AS n, CAST(ceil(CAST(0.25 AS DOUBLE) * count(*)) AS BIGINT) AS nt FROM d),
q0 AS (SELECT lbl, CAST(nc * nt AS DOUBLE) / n AS ex, nt FROM cls, tot),
q1 AS (SELECT lbl, nt, floor(ex) AS base, ex - floor(ex) AS rem FROM q0),
q2 AS (SELECT lbl, base + CASE WHEN row_number() OVER (ORDER BY rem DESC, lbl)
                                    <= nt - sum(base) OVER () THEN 1 ELSE 0 END AS quota FROM q1),
r AS (SELECT order_id, lbl, b, row_number() OVER (PARTITION BY lbl, b ORDER BY h, order_id) - 1 AS rk FROM d2),
sp AS (SELECT r.order_id, r.lbl, CASE WHEN offs.off + r.rk < q2.quota THEN 'test' ELSE 'train' END AS split
       FROM r JOIN offs USING (lbl, b) JOIN q2 USING (lbl))"""


def _arith_split(spark, sf_dir, label):
    return ev.stratified_split(order_risk(spark, sf_dir), label, 0.25, 42,
                               order_key=(_F.col("order_id") * 7919) % 10007)


@register("L3_stratified_split", f"WITH {_split_sql('risk_label')}\n"
          "SELECT lbl AS risk_label, split, count(*) AS n FROM sp GROUP BY lbl, split")
def q_stratified_split(spark, sf_dir):
    return _arith_split(spark, sf_dir, "risk_label").groupBy("risk_label", "split").agg(
        _F.count(_F.lit(1)).alias("n"))


@register("L3_stratified_split_fraud", f"WITH {_split_sql('is_fraud')}\n"
          "SELECT lbl AS is_fraud, split, count(*) AS n, CAST(sum(order_id) AS BIGINT) AS id_sum FROM sp GROUP BY lbl, split")
def q_stratified_split_fraud(spark, sf_dir):
    return _arith_split(spark, sf_dir, "is_fraud").groupBy("is_fraud", "split").agg(
        _F.count(_F.lit(1)).alias("n"), _F.sum("order_id").alias("id_sum"))


@register("L4_class_weights", """
SELECT risk_label, CAST(sum(count(*)) OVER () AS DOUBLE) / (count(*) OVER () * count(*)) AS weight
FROM order_risk GROUP BY risk_label""")
def q_class_weights(spark, sf_dir):
    return ev.class_weights(order_risk(spark, sf_dir), "risk_label")


@register("A14_confusion_matrix", f"""
SELECT c.actual, """ + ", ".join(
    f"CAST(coalesce(sum(CASE WHEN p.pred = '{k}' THEN 1 END), 0) AS BIGINT) AS \"{k}\"" for k in _CLASSES) + f"""
FROM (SELECT unnest(['Fraud Risk', 'Normal', 'Return Risk']) AS actual) c
LEFT JOIN (SELECT risk_label, {_RULE_PRED_SQL} AS pred FROM order_risk) p ON p.risk_label = c.actual
GROUP BY c.actual""")
def q_confusion_matrix(spark, sf_dir):
    pred = order_risk(spark, sf_dir).withColumn("pred", _rule_pred())
    return ev.confusion_matrix(pred, _CLASSES, "risk_label", "pred")


@register("L9_classification_report", f"""
WITH p AS (SELECT risk_label AS actual, {_RULE_PRED_SQL} AS pred FROM order_risk),
cl AS (SELECT actual AS class FROM p UNION SELECT pred FROM p),
per AS (
  SELECT cl.class,
         (SELECT count(*) FROM p WHERE actual = cl.class) AS support,
         (SELECT count(*) FROM p WHERE pred = cl.class) AS n_pred,
         (SELECT count(*) FROM p WHERE pred = cl.class AND actual = cl.class) AS tp
  FROM cl),
m AS (SELECT class, support, tp,
             coalesce(CAST(tp AS DOUBLE) / nullif(n_pred, 0), 0.0) AS precision,
             coalesce(CAST(tp AS DOUBLE) / nullif(support, 0), 0.0) AS recall FROM per),
f AS (SELECT *, coalesce(2.0 * precision * recall / nullif(precision + recall, 0.0), 0.0) AS f1_score FROM m)
SELECT class, round_even(precision, 6) AS precision, round_even(recall, 6) AS recall,
       round_even(f1_score, 6) AS f1_score, support FROM f
UNION ALL SELECT 'accuracy', NULL, NULL, round_even(sum(tp) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM f
UNION ALL SELECT 'macro avg', round_even(avg(precision), 6), round_even(avg(recall), 6), round_even(avg(f1_score), 6),
                 CAST(sum(support) AS BIGINT) FROM f
UNION ALL SELECT 'weighted avg', round_even(sum(precision * support) / sum(support), 6),
                 round_even(sum(recall * support) / sum(support), 6),
                 round_even(sum(f1_score * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM f""")
def q_classification_report(spark, sf_dir):
    pred = order_risk(spark, sf_dir).withColumn("pred", _rule_pred())
    r = ev.classification_report(pred, "risk_label", "pred")
    return r.select("class", _npr("precision", 6).alias("precision"), _npr("recall", 6).alias("recall"),
                    _npr("f1_score", 6).alias("f1_score"), "support")


def _auc_sql(score_sql: str) -> str:
    return f"""
WITH s AS (SELECT CAST({score_sql} AS DOUBLE) AS s, count(*) FILTER (WHERE is_fraud = 1) AS pos,
                  count(*) FILTER (WHERE is_fraud = 0) AS neg FROM order_risk GROUP BY 1),
c AS (SELECT *, sum(neg) OVER (ORDER BY s) - neg AS neg_below FROM s)
SELECT sum(pos * (neg_below + neg * 0.5)) / (sum(pos) * sum(neg)) AS auc FROM c"""


@register("L11_roc_auc_flags", _auc_sql(_FLAG_SCORE_SQL))
def q_auc_flags(spark, sf_dir):
    return ev.roc_auc(order_risk(spark, sf_dir).withColumn("score", _flag_score()), "is_fraud", "score")


@register("L11_roc_auc_order_value", _auc_sql("order_value_eur"))
def q_auc_value(spark, sf_dir):
    return ev.roc_auc(order_risk(spark, sf_dir), "is_fraud", "order_value_eur")


@register("L1_label_encode", """
SELECT order_id, """ + ", ".join(
    f"CAST(dense_rank() OVER (ORDER BY {c}) - 1 AS INTEGER) AS {c}_enc" for c in ml.CAT_COLS) + """
FROM order_risk""")
def q_label_encode(spark, sf_dir):
    enc = ml.label_encode(order_risk(spark, sf_dir))
    return enc.select("order_id", *[f"{c}_enc" for c in ml.CAT_COLS])


@register("L2_feature_vector", "SELECT order_id, " + ", ".join(
    [f"CAST(dense_rank() OVER (ORDER BY {c}) - 1 AS DOUBLE) AS {c}_enc" for c in ml.CAT_COLS]
    + [f"CAST({c} AS DOUBLE) AS {c}" for c in ml.NUM_COLS]) + " FROM order_risk")
def q_feature_vector(spark, sf_dir):
    from pyspark.ml.functions import vector_to_array
    v = ml.assembler().transform(ml.label_encode(order_risk(spark, sf_dir)))
    a = v.select("order_id", vector_to_array("features").alias("a"))
    return a.select("order_id", *[_F.get("a", _F.lit(i)).alias(c) for i, c in enumerate(ml.FEATURE_COLS)])


# Forests: rows-only checks (another library's tree RNG cannot be reproduced).
_MODELS: dict = {}


def _risk_model(spark, sf_dir):
    from ..sources.order_risk import session_key
    key = ("risk", session_key(spark), sf_dir)
    if key not in _MODELS:
        # codes for the whole table first, then the split (the reference's order)
        split = ev.stratified_split(ml.label_encode(order_risk(spark, sf_dir)), "risk_label", 0.25, 42)
        train = split.filter(_F.col("split") == "train")
        test = split.filter(_F.col("split") == "test")
        _MODELS[key] = (ml.fit_risk_model(train), test)
    return _MODELS[key]


@register("L6_risk_model_report")
def q_risk_model_report(spark, sf_dir):
    model, test = _risk_model(spark, sf_dir)
    return ev.classification_report(ml.predict(model, test), "risk_label", "predicted")


@register("L10_risk_model_confusion")
def q_risk_model_confusion(spark, sf_dir):
    model, test = _risk_model(spark, sf_dir)
    return ev.confusion_matrix(ml.predict(model, test), _CLASSES, "risk_label", "predicted")


@register("L12_feature_importance")
def q_feature_importance(spark, sf_dir):
    model, _ = _risk_model(spark, sf_dir)
    return ml.feature_importance(model)


@register("L13_top_drivers")
def q_top_drivers(spark, sf_dir):
    model, _ = _risk_model(spark, sf_dir)
    return ml.top_drivers(ml.feature_importance(model), 10)


@register("L8_fraud_model_auc")
def q_fraud_model_auc(spark, sf_dir):
    split = ev.stratified_split(ml.label_encode(order_risk(spark, sf_dir)), "is_fraud", 0.25, 42)
    model = ml.fit_fraud_model(split.filter(_F.col("split") == "train"))
    scored = ml.fraud_probability(model, split.filter(_F.col("split") == "test"))
    return ev.roc_auc(scored, "is_fraud", "score")


# oracles for the keyed forecast and the chart data (added after the queries were registered)
_KEYED_SERIES_SQL = """
monthly AS (
  SELECT country, CAST(date_trunc('month', order_date) AS DATE) AS month, count(order_id) AS orders,
         avg(is_fraud) AS fraud_rate, avg(is_returned) AS return_rate
  FROM order_risk WHERE order_date IS NOT NULL AND country IS NOT NULL GROUP BY 1, 2),
series AS (
  SELECT *, CAST(date_diff('month', min(month) OVER (PARTITION BY country), month) AS INTEGER) AS t FROM monthly)"""

ORACLE["F5_forecast_by_country"] = with_order_risk(f"""WITH {_KEYED_SERIES_SQL},
s AS (SELECT country, month, t, CAST(orders AS DOUBLE) AS y, t % 12 AS k FROM series),
c AS (SELECT *, y - avg(y) OVER (PARTITION BY country, k) AS yc,
             CAST(t AS DOUBLE) - avg(CAST(t AS DOUBLE)) OVER (PARTITION BY country, k) AS tc FROM s),
sl AS (SELECT country, sum(yc * tc) / nullif(sum(tc * tc), 0.0) AS b, max(t) AS t_last, max(month) AS m_last
       FROM c GROUP BY country),
lv AS (SELECT s.country, s.k, avg(s.y - sl.b * CAST(s.t AS DOUBLE)) AS a FROM s JOIN sl USING (country)
       GROUP BY s.country, s.k),
lin AS (SELECT country, regr_intercept(fraud_rate, CAST(t AS DOUBLE)) AS fa, regr_slope(fraud_rate, CAST(t AS DOUBLE)) AS fb,
               regr_intercept(return_rate, CAST(t AS DOUBLE)) AS ra, regr_slope(return_rate, CAST(t AS DOUBLE)) AS rb
        FROM series GROUP BY country),
h AS (SELECT unnest([1, 2, 3]) AS h),
f AS (SELECT sl.country, strftime(CAST(sl.m_last + to_months(CAST(h.h AS INTEGER)) AS DATE), '%Y-%m') AS forecast_month,
       round_even(lv.a + sl.b * CAST(sl.t_last + h.h AS DOUBLE), 0) AS forecasted_orders,
       round_even((lin.fa + lin.fb * CAST(sl.t_last + h.h AS DOUBLE)) * 100.0, 2) AS forecasted_fraud_rate_pct,
       round_even((lin.ra + lin.rb * CAST(sl.t_last + h.h AS DOUBLE)) * 100.0, 2) AS forecasted_return_rate_pct
FROM sl CROSS JOIN h LEFT JOIN lv ON lv.country = sl.country AND lv.k = (sl.t_last + h.h) % 12
LEFT JOIN lin ON lin.country = sl.country)
SELECT *, CASE WHEN forecasted_orders IS NOT NULL AND forecasted_fraud_rate_pct IS NOT NULL
                    AND forecasted_return_rate_pct IS NOT NULL THEN 'fitted' ELSE 'too short' END AS status FROM f""")

ORACLE["F6_actual_vs_forecast"] = with_order_risk(f"""WITH {_SERIES_SQL},
s AS (SELECT month, t, CAST(orders AS DOUBLE) AS y, t % 12 AS k FROM series),
c AS (SELECT *, y - avg(y) OVER (PARTITION BY k) AS yc,
             CAST(t AS DOUBLE) - avg(CAST(t AS DOUBLE)) OVER (PARTITION BY k) AS tc FROM s),
sl AS (SELECT sum(yc * tc) / nullif(sum(tc * tc), 0.0) AS b, max(t) AS t_last, max(month) AS m_last FROM c),
lv AS (SELECT k, avg(y - (SELECT b FROM sl) * CAST(t AS DOUBLE)) AS a FROM s GROUP BY k),
lin AS (SELECT regr_intercept(fraud_rate, CAST(t AS DOUBLE)) AS fa, regr_slope(fraud_rate, CAST(t AS DOUBLE)) AS fb,
               regr_intercept(return_rate, CAST(t AS DOUBLE)) AS ra, regr_slope(return_rate, CAST(t AS DOUBLE)) AS rb
        FROM series),
h AS (SELECT unnest([1, 2, 3]) AS h)
SELECT 'actual' AS kind, month, round_even(CAST(orders AS DOUBLE), 6) AS orders,
       round_even(fraud_rate * 100.0, 6) AS fraud_rate_pct, round_even(return_rate * 100.0, 6) AS return_rate_pct
FROM series
UNION ALL
SELECT 'forecast', CAST(sl.m_last + to_months(CAST(h.h AS INTEGER)) AS DATE),
       round_even(lv.a + sl.b * CAST(sl.t_last + h.h AS DOUBLE), 6),
       round_even((lin.fa + lin.fb * CAST(sl.t_last + h.h AS DOUBLE)) * 100.0, 6),
       round_even((lin.ra + lin.rb * CAST(sl.t_last + h.h AS DOUBLE)) * 100.0, 6)
FROM sl CROSS JOIN h CROSS JOIN lin JOIN lv ON lv.k = (sl.t_last + h.h) % 12""")


@register("M2_one_hot")
def q_one_hot(spark, sf_dir):
    # column set depends on the data's vocabulary: row-count checked
    return mb.one_hot(order_risk(spark, sf_dir))


# --- S3-S5: written to the shared folder, read back, compared with what was computed ------------------
def _scratch(spark, name: str) -> str:
    import uuid

    from ..session import ensure_checkpoint_dir
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _round_trip(spark, df, fmt: str, name: str):
    from ..sources.files import write_report
    path = _scratch(spark, name)
    write_report(df, path, fmt)
    return spark.read.schema(df.schema).option("header", True).format(fmt).load(path)


@register("S3_monthly_trend_csv")
def q_report_csv(spark, sf_dir):
    return _round_trip(spark, QUERIES["A3_monthly_trend"](spark, sf_dir), "csv", "trend")


@register("S5_classification_report_csv")
def q_classification_csv(spark, sf_dir):
    return _round_trip(spark, QUERIES["L9_classification_report"](spark, sf_dir), "csv", "report")


ORACLE["S3_monthly_trend_csv"] = ORACLE["A3_monthly_trend"]
ORACLE["S5_classification_report_csv"] = ORACLE["L9_classification_report"]


@register("S4_report_pack_manifest", """
SELECT 'By country' AS sheet, count(DISTINCT country) AS rows FROM order_risk
UNION ALL SELECT 'By payment_method', count(DISTINCT payment_method) FROM order_risk
UNION ALL SELECT 'Risk labels of all orders in th', count(DISTINCT risk_label) FROM order_risk""")
def q_report_pack(spark, sf_dir):
    from ..sources.files import write_report_pack
    df = order_risk(spark, sf_dir)
    pack = {"By country": sc.value_counts(df, ["country"]), "By payment_method": sc.value_counts(df, ["payment_method"]),
            "Risk labels of all orders in the report": sc.value_counts(df, ["risk_label"])}
    return write_report_pack(pack, _scratch(spark, "pack")).select("sheet", "rows")


@register("L6_risk_model_supports", f"WITH {_split_sql('risk_label')}\n"
          "SELECT lbl AS class, count(*) AS support FROM sp WHERE split = 'test' GROUP BY lbl")
def q_risk_model_supports(spark, sf_dir):
    """What the data fix in a forest's report, whatever its trees: supports by class."""
    encoded = ml.label_encode(order_risk(spark, sf_dir))
    split = ev.stratified_split(encoded, "risk_label", 0.25, 42, order_key=(_F.col("order_id") * 7919) % 10007)
    model = ml.fit_risk_model(split.filter(_F.col("split") == "train"))
    report = ev.classification_report(ml.predict(model, split.filter(_F.col("split") == "test")), "risk_label", "predicted")
    return report.filter(_F.col("class").isin(*_CLASSES)).select("class", "support")


@register("L12_importance_features", "SELECT unnest([" + ", ".join(f"'{c}'" for c in ml.FEATURE_COLS) + "]) AS feature, "
          "CAST(1.0 AS DOUBLE) AS total")
def q_importance_features(spark, sf_dir):
    """Every feature has an importance, and they sum to one."""
    model, _ = _risk_model(spark, sf_dir)
    imp = ml.feature_importance(model)
    total = imp.agg(_F.round(_F.sum("importance"), 6)).scalar()
    return imp.select("feature", total.alias("total"))


# --- F3/F4 with given and with fitted smoothing parameters -------------------------------------------
from ..operators import smoothing as sm  # noqa: E402

_KEYED_CALENDAR_SQL = f"""{_KEYED_SERIES_SQL},
cal AS (SELECT country, CAST(unnest(generate_series(m0, m1, INTERVAL 1 MONTH)) AS DATE) AS month, m1
        FROM (SELECT country, min(month) AS m0, max(month) AS m1 FROM series GROUP BY country))"""


def _smoothing_sql(value: str, alpha: float, beta: float, gamma: float, period: int) -> str:
    """Months folded by a recursive query, a row for each country and month."""
    a, b, g = (f"CAST({x} AS DOUBLE)" for x in (alpha, beta, gamma))
    if period:
        start = f"""
i1 AS (SELECT *, list_avg(ys[1:{period}]) AS first, list_avg(ys[{period + 1}:{2 * period}]) AS second FROM packed
       WHERE len(ys) >= {2 * period}),
i2 AS (SELECT *, (second - first) / CAST({period} AS DOUBLE) AS trend FROM i1),
i3 AS (SELECT *, first - trend * CAST({(period + 1) / 2} AS DOUBLE) AS level FROM i2),
init AS (SELECT *, list_transform(ys[1:{period}], lambda x, i: coalesce(x - (level + trend * i), 0)) AS seasons FROM i3)"""
    else:
        start = """
i1 AS (SELECT *, list_filter(list_transform(ys, lambda x, i: {'y': x, 'i': i}), lambda p: p.y IS NOT NULL) AS known FROM packed),
i2 AS (SELECT *, (known[2].y - known[1].y) / CAST(known[2].i - known[1].i AS DOUBLE) AS trend FROM i1 WHERE len(known) >= 2),
init AS (SELECT *, known[1].y - trend AS level, [CAST(0 AS DOUBLE)] AS seasons FROM i2)"""
    turn = "list_append(seasons[2:], CASE WHEN y IS NULL THEN season ELSE {g} * (y - line) + (1 - {g}) * season END)".format(g=g) if period else "seasons"
    season_ahead = f"seasons[(h - 1) % {period} + 1]" if period else "0"
    return f"""WITH RECURSIVE {_KEYED_CALENDAR_SQL},
packed AS (SELECT cal.country, list(CAST(s.{value} AS DOUBLE) ORDER BY cal.month) AS ys, max(cal.month) AS m_last
           FROM cal LEFT JOIN series s ON s.country = cal.country AND s.month = cal.month GROUP BY cal.country),{start},
st AS (SELECT country, 0 AS i, level, trend, seasons, CAST(0 AS DOUBLE) AS sse FROM init
       UNION ALL
       SELECT country, i + 1, new, CASE WHEN y IS NULL THEN trend ELSE {b} * (new - level) + (1 - {b}) * trend END,
              {turn}, sse + CASE WHEN y IS NULL THEN 0 ELSE (y - (line + season)) * (y - (line + season)) END
       FROM (SELECT *, CASE WHEN y IS NULL THEN line ELSE {a} * (y - season) + (1 - {a}) * line END AS new
             FROM (SELECT st.*, p.ys[st.i + 1] AS y, st.level + st.trend AS line, st.seasons[1] AS season
                   FROM st JOIN packed p USING (country) WHERE st.i < len(p.ys))))
SELECT st.country, CAST(h AS INTEGER) AS h, CAST(len(p.ys) - 1 + h AS INTEGER) AS t,
       CAST(p.m_last + to_months(CAST(h AS INTEGER)) AS DATE) AS month,
       round_even(level + h * trend + {season_ahead}, 6) AS forecast, round_even(sse, 6) AS sse
FROM st JOIN packed p ON p.country = st.country AND st.i = len(p.ys), (SELECT unnest([1, 2, 3]) AS h)"""


def _country_series(spark, sf_dir):
    return fc.monthly_series(order_risk(spark, sf_dir), keys=["country"])


@register("F3_holt_winters_fixed", _smoothing_sql("orders", 0.3, 0.1, 0.2, 12))
def q_holt_winters_fixed(spark, sf_dir):
    f = sm.holt_winters_fixed(_country_series(spark, sf_dir), "orders", ["country"], 0.3, 0.1, 0.2, period=12)
    return f.select("country", "h", "t", "month", _npr("forecast", 6).alias("forecast"), _npr("sse", 6).alias("sse"))


@register("F4_holt_linear_fixed", _smoothing_sql("fraud_rate", 0.4, 0.2, 0.0, 0))
def q_holt_linear_fixed(spark, sf_dir):
    f = sm.holt_winters_fixed(_country_series(spark, sf_dir), "fraud_rate", ["country"], 0.4, 0.2)
    return f.select("country", "h", "t", "month", _npr("forecast", 6).alias("forecast"), _npr("sse", 6).alias("sse"))


# the error without smoothing is a regression on the month's number and the calendar month
@register("F3_holt_winters_refined", f"""WITH {_KEYED_SERIES_SQL},
s AS (SELECT country, t, CAST(orders AS DOUBLE) AS y, t % 12 AS k FROM series),
c AS (SELECT *, y - avg(y) OVER (PARTITION BY country, k) AS yc,
             CAST(t AS DOUBLE) - avg(CAST(t AS DOUBLE)) OVER (PARTITION BY country, k) AS tc FROM s),
b AS (SELECT country, coalesce(sum(yc * tc) / nullif(sum(tc * tc), 0.0), 0.0) AS b, count(*) AS n FROM c GROUP BY country)
SELECT c.country, round_even(sum((yc - b * tc) * (yc - b * tc)), 4) AS line_sse, true AS not_above_line,
       true AS not_above_grid, true AS replayed
FROM c JOIN b USING (country) WHERE n >= 14 GROUP BY c.country""")
def q_holt_winters_refined(spark, sf_dir):
    """Fitted parameters by country: no worse than no smoothing and than every grid point, and
    the native smoother gets the same error from them."""
    fit = sm.refine(_country_series(spark, sf_dir), "orders", ["country"], period=12)
    done = sm.smooth(fit, _F.col("alpha"), _F.col("beta"), _F.col("gamma"), 12).filter("fit_sse IS NOT NULL")
    slack = _F.lit(1e-6) * (_F.lit(1.0) + _F.col("line_sse"))
    return done.select("country", _npr("line_sse", 4).alias("line_sse"),
                       (_F.col("sse") <= _F.col("line_sse") + slack).alias("not_above_line"),
                       (_F.col("sse") <= _F.col("grid_sse") + slack).alias("not_above_grid"),
                       (_F.abs(_F.col("sse") - _F.col("fit_sse")) <= slack).alias("replayed"))


# --- L6/L8/L12: forests as tables ------------------------------------------------------------------------
from ..operators import forest as ft  # noqa: E402

# A small forest over the report's features: (feature, threshold, left, right), or the class weights of a leaf.
_FIXED_FOREST = (
    ("high_risk_ip", 0.5, ("late_delivery_risk", 0.5, (1.0, 8.0, 1.0), (1.0, 5.0, 4.0)),
     ("address_mismatch", 0.5, (6.0, 3.0, 1.0), (8.0, 1.0, 1.0))),
    ("order_value_eur", 150_000.0, ("review_score", 2.5, (1.0, 4.0, 5.0), (1.0, 9.0, 0.0)),
     ("discount_rate", 0.05, (3.0, 5.0, 2.0), ("quantity", 100.0, (2.0, 2.0, 6.0), (1.0, 1.0, 2.0)))),
    ("review_score", 3.5, ("high_risk_ip", 0.5, (0.0, 3.0, 7.0), (5.0, 2.0, 3.0)), (1.0, 9.0, 1.0)),
)


def _forest_rows():
    rows = []

    def add(tree, spec, depth):
        at = sum(r[0] == tree for r in rows)
        if not isinstance(spec[0], str):
            rows.append([tree, at, -1, None, None, -1, -1, None, list(spec), depth])
            return at
        rows.append(row := [tree, at, ml.FEATURE_COLS.index(spec[0]), spec[1], None, None, None, 0.0, [0.0] * 3, depth])
        row[5] = add(tree, spec[2], depth + 1)
        row[6] = add(tree, spec[3], depth + 1)
        return at

    for t, spec in enumerate(_FIXED_FOREST):
        add(t, spec, 0)
    return rows


def _fixed_forest(spark):
    return spark.createDataFrame(_forest_rows(), "tree int, node int, feature int, threshold double, categories array<double>, "
                                                 "left int, right int, gain double, stats array<double>, depth int")


def _feature_arrays(spark, sf_dir):
    """order_id, risk_label and the model's features as an array."""
    from pyspark.ml.functions import vector_to_array
    v = ml.assembler().transform(ml.label_encode(order_risk(spark, sf_dir)))
    return v.select("order_id", "risk_label", vector_to_array("features").alias("x"))


def _tree_sql(spec, k: int) -> str:
    if not isinstance(spec[0], str):
        return f"CAST({spec[k] / sum(spec)!r} AS DOUBLE)"
    return f"CASE WHEN {spec[0]} <= CAST({spec[1]} AS DOUBLE) THEN {_tree_sql(spec[2], k)} ELSE {_tree_sql(spec[3], k)} END"


def _splits(spec, where="true"):
    """(feature, condition of the node, of its left, of its right) of each split of a tree."""
    if not isinstance(spec[0], str):
        return []
    left = f"({where}) AND {spec[0]} <= CAST({spec[1]} AS DOUBLE)"
    right = f"({where}) AND ({spec[0]} <= CAST({spec[1]} AS DOUBLE)) IS NOT TRUE"
    return [(spec[0], where, left, right), *_splits(spec[2], left), *_splits(spec[3], right)]


def _impurity_sql(where: str) -> str:
    c = [f"CAST(count(*) FILTER (WHERE {where} AND risk_label = '{k}') AS DOUBLE)" for k in _CLASSES]
    return f"({' + '.join(c)} - coalesce(({' + '.join(f'{x} * {x}' for x in c)}) / nullif({' + '.join(c)}, 0), 0))"


@register("L6_forest_table_scores", "WITH p AS (SELECT order_id, " + ", ".join(
    f"({' + '.join(_tree_sql(t, k) for t in _FIXED_FOREST)}) / CAST({len(_FIXED_FOREST)} AS DOUBLE) AS p{k}" for k in range(3)) + """
FROM order_risk)
SELECT order_id, round_even(p0, 9) AS p_fraud, round_even(p1, 9) AS p_normal, round_even(p2, 9) AS p_return FROM p""")
def q_forest_table_scores(spark, sf_dir):
    p = ft.score(_feature_arrays(spark, sf_dir), _fixed_forest(spark), "x", 3)
    return p.select("order_id", *[_npr(_F.get("probability", _F.lit(k)), 9).alias(c)
                                  for k, c in enumerate(("p_fraud", "p_normal", "p_return"))])


_SPLIT_GAINS = "\nUNION ALL\n".join(
    f"SELECT {t} AS tree, '{f}' AS feature, {_impurity_sql(at)} - {_impurity_sql(left)} - {_impurity_sql(right)} AS g FROM order_risk"
    for t, spec in enumerate(_FIXED_FOREST) for f, at, left, right in _splits(spec))


@register("L12_forest_table_importance", f"""WITH s AS ({_SPLIT_GAINS}),
t AS (SELECT tree, sum(g) AS whole FROM s GROUP BY tree HAVING sum(g) > 0),
f AS (SELECT feature, sum(g / whole) AS v FROM s JOIN t USING (tree) GROUP BY feature)
SELECT n.feature, round_even(coalesce(f.v / (SELECT sum(v) FROM f), 0), 9) AS importance
FROM (SELECT unnest([{", ".join(f"'{c}'" for c in ml.FEATURE_COLS)}]) AS feature) n LEFT JOIN f ON f.feature = n.feature""")
def q_forest_table_importance(spark, sf_dir):
    """The fixed splits with the orders' own class counts, and the importances that follow."""
    df = _feature_arrays(spark, sf_dir)
    label = _F.array_position(_F.array(*[_F.lit(c) for c in _CLASSES]), _F.col("risk_label")) - 1
    fresh = ft.refresh(_fixed_forest(spark), df.withColumn("y", label), "x", "y", 3)
    return ft.importance(fresh, ml.FEATURE_COLS).select("feature", _npr("importance", 9).alias("importance"))


@register("L6_stored_forest_agrees", """
SELECT CAST(ceil(CAST(0.25 AS DOUBLE) * count(*)) AS BIGINT) AS test_rows, CAST(0 AS BIGINT) AS other_class,
       true AS same_probabilities, true AS same_importances FROM order_risk""")
def q_stored_forest_agrees(spark, sf_dir):
    """The production forest, stored as a table, read back and scored without Spark ML: its test rows,
    how many get another class than from Spark ML, and whether probabilities and importances are the same."""
    from pyspark.ml.functions import vector_to_array
    model, test = _risk_model(spark, sf_dir)
    nodes = ft.export_forest(model, _scratch(spark, "forest"))
    theirs = ml.predict(model, test, spark_ml=True).select("order_id", _F.col("prediction").alias("y"), vector_to_array("probability").alias("p"),
                                            vector_to_array("features").alias("x"))
    both = ft.score(theirs, nodes, "x", len(_CLASSES))
    gap = _F.aggregate(_F.zip_with("p", "probability", lambda a, b: _F.abs(a - b)), _F.lit(0.0), lambda s, v: _F.greatest(s, v))
    imp = ft.importance(nodes, ml.FEATURE_COLS).withColumnRenamed("importance", "ours")
    apart = imp.join(ml.feature_importance(model), "feature").agg(
        (_F.max(_F.abs(_F.col("ours") - _F.col("importance"))) < 1e-9) & (_F.count(_F.lit(1)) == len(ml.FEATURE_COLS))).scalar()
    return both.agg(_F.count(_F.lit(1)).alias("test_rows"), _F.count_if(_F.col("y") != _F.col("prediction")).alias("other_class"),
                    (_F.max(gap) < 1e-9).alias("same_probabilities")).withColumn("same_importances", apart)


# --- M3/M4 beyond three items ----------------------------------------------------------------------------
_ITEMS4_SQL = _ITEMS_SQL.replace("""    JOIN fx c ON c.order_id = a.order_id AND b.item < c.item),""", """    JOIN fx c ON c.order_id = a.order_id AND b.item < c.item
  UNION ALL
  SELECT [a.item, b.item, c.item, d.item] FROM fx a
    JOIN fx b ON a.order_id = b.order_id AND a.item < b.item
    JOIN fx c ON c.order_id = a.order_id AND b.item < c.item
    JOIN fx d ON d.order_id = a.order_id AND c.item < d.item),""")


@register("M3_frequent_itemsets_len4", f"""WITH {_ITEMS4_SQL}
SELECT array_to_string(itemset, ', ') AS itemset, CAST(size AS INTEGER) AS size, cnt AS count, support FROM itemsets""")
def q_frequent_itemsets_len4(spark, sf_dir):
    fs = mb.frequent_itemsets(_baskets(spark, sf_dir), 0.004, 4)
    return fs.select(_F.array_join("itemset", ", ").alias("itemset"), "size", "count", "support")


@register("M4_association_rules_len4", f"""WITH {_ITEMS4_SQL}
SELECT array_to_string(ante, ', ') AS antecedents, array_to_string(cons, ', ') AS consequents,
       antecedent_support, consequent_support, support, confidence, lift FROM rules""")
def q_association_rules_len4(spark, sf_dir):
    r = mb.association_rules(mb.frequent_itemsets(_baskets(spark, sf_dir), 0.004, 4), 1.0)
    return r.select(_F.array_join("antecedents", ", ").alias("antecedents"),
                    _F.array_join("consequents", ", ").alias("consequents"),
                    "antecedent_support", "consequent_support", "support", "confidence", "lift")


# --- S1-S4: text without a schema, rejected cells, committed packs ---------------------------------------
_S1_LONGS = ("order_id", "customer_age_days", "previous_orders", "quantity", "delivery_days_estimated", "late_delivery_risk",
             "address_mismatch", "high_risk_ip", "customer_support_contacts", "is_returned", "is_fraud")


@register("S1_order_risk_inferred", "SELECT * REPLACE (" + ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in _S1_LONGS)
          + f") FROM ({ORDER_RISK_SELECT})")
def q_order_risk_inferred(spark, sf_dir):
    """The orders written as text, and read back without a schema."""
    from ..sources.checked import read_inferred
    from ..sources.files import write_report
    path = _scratch(spark, "orders-text")
    write_report(order_risk(spark, sf_dir), path)
    return read_inferred(spark, path)


# the stand-in for a faulty file: some cells are overwritten, whatever they held
_BAD_CELLS = (("quantity", 97, "x12", "not of type int"), ("order_date", 89, "2024-13-45", "not of type date"),
              ("order_value_eur", 83, "12,50", "not of type double"))


def _faulty_orders(spark, sf_dir):
    from ..sources.checked import read_checked
    from ..sources.files import ORDER_SCHEMA, write_report
    text = order_risk(spark, sf_dir)
    for c, every, cell, _ in _BAD_CELLS:
        text = text.withColumn(c, _F.when(_F.col("order_id") % every == 0, cell).otherwise(_F.col(c).cast("string")))
    path = _scratch(spark, "orders-faulty")
    write_report(text, path)
    return read_checked(spark, path, ORDER_SCHEMA, "order_id")


@register("S2_rejected_cells", "\nUNION ALL\n".join(
    f"SELECT CAST(order_id AS VARCHAR) AS order_id, '{c}' AS \"column\", '{cell}' AS cell, '{reason}' AS reason "
    f"FROM order_risk WHERE order_id % {every} = 0" for c, every, cell, reason in _BAD_CELLS))
def q_rejected_cells(spark, sf_dir):
    return _faulty_orders(spark, sf_dir).rejected.select(_F.col("key").alias("order_id"), "column", "cell", "reason")


@register("S2_accepted_rows", "SELECT CAST(order_id AS VARCHAR) AS order_id, order_date, quantity, order_value_eur, risk_label "
          "FROM order_risk WHERE " + " AND ".join(f"order_id % {every} <> 0" for _, every, _, _ in _BAD_CELLS))
def q_accepted_rows(spark, sf_dir):
    return _faulty_orders(spark, sf_dir).rows.select("order_id", "order_date", "quantity", "order_value_eur", "risk_label")


_ANY_BAD = " OR ".join(f"order_id % {every} = 0" for _, every, _, _ in _BAD_CELLS)


@register("V7_rejections", f"""
SELECT 'total_records' AS "check", CAST(count(*) AS VARCHAR) AS value FROM order_risk
UNION ALL SELECT 'rejected_records', CAST(count(*) FILTER (WHERE {_ANY_BAD}) AS VARCHAR) FROM order_risk
UNION ALL SELECT 'rejected_cells', CAST({" + ".join(f"count(*) FILTER (WHERE order_id % {e} = 0)" for _, e, _, _ in _BAD_CELLS)} AS VARCHAR) FROM order_risk
""" + "".join(f"UNION ALL SELECT 'rejected_cells: {c}', CAST(count(*) AS VARCHAR) FROM order_risk WHERE order_id % {e} = 0 HAVING count(*) > 0\n"
              for c, e, _, _ in _BAD_CELLS))
def q_rejections(spark, sf_dir):
    return _faulty_orders(spark, sf_dir).log()


@register("S4_report_pack_contents", "\nUNION ALL\n".join(
    f"SELECT CAST(2 AS BIGINT) AS version, 'By {c}' AS sheet, CAST({c} AS VARCHAR) AS value, count(*) AS count "
    f"FROM order_risk WHERE {c} IS NOT NULL GROUP BY {c}" for c in ("country", "payment_method", "risk_label")))
def q_report_pack_contents(spark, sf_dir):
    """A pack written twice, then once more with a table that fails: the tables of what is left."""
    from functools import reduce

    from ..sources.pack import ReportPack
    df = order_risk(spark, sf_dir)
    pack = ReportPack(spark, _scratch(spark, "pack"))
    names = ("country", "payment_method", "risk_label")
    whole = {f"By {c}": sc.value_counts(df, [c]) for c in names}
    pack.write({"By country": whole["By country"].limit(0)})
    version = pack.write(whole)
    broken = sc.value_counts(df, ["country"]).withColumn("count", _F.when(_F.col("count") >= 0, _F.raise_error(_F.lit("no table"))))
    try:
        pack.write(whole | {"By country": broken})
    except Exception as e:
        if "no table" not in str(e):
            raise
    version = pack.manifest().select("version").first()[0]
    parts = [pack.read(f"By {c}").select(_F.lit(version).cast("long").alias("version"), _F.lit(f"By {c}").alias("sheet"), "value", "count")
             for c in names]
    return reduce(type(df).unionByName, parts)


# --- A8 by sketches, A11 with automatic bins, L1 with a large vocabulary ---------------------------------
from ..operators import sketches as sk  # noqa: E402

_RANK_SLACK = sk.rank_error(sk.K)
_A8_LONG = "\nUNION ALL\n".join(
    f"SELECT strftime(order_date, '%Y') AS period, '{c}' AS col, CAST({c} AS DOUBLE) AS value FROM order_risk "
    f"WHERE {c} IS NOT NULL AND NOT isnan(CAST({c} AS DOUBLE))" for c in pf.OUTLIER_COLS)


@register("A8_iqr_outliers_approx", f"""WITH long AS ({_A8_LONG})
SELECT period, col AS "column", count(*) AS n, true AS q1_in_bound, true AS q3_in_bound, true AS counted
FROM long GROUP BY period, col""")
def q_iqr_outliers_approx(spark, sf_dir):
    """Yearly fences merged from monthly sketches: the exact ranks of both quartiles lie inside the
    sketch's bound, and the outliers of the direct form are the rows beyond its fences."""
    df = order_risk(spark, sf_dir)
    monthly = sk.quantile_sketches(df, pf.OUTLIER_COLS, _F.date_format("order_date", "yyyy-MM"))
    monthly.write.parquet(path := _scratch(spark, "sketches"))  # kept, and merged without the rows
    stored = spark.read.parquet(path).withColumn("year", _F.substring("period", 1, 4))
    merged = sk.iqr_fences(sk.merge_sketches(stored, ("year", "column"))).drop("sketch")
    year = _F.date_format("order_date", "yyyy")
    direct = sk.iqr_outliers_approx(df, pf.OUTLIER_COLS, year).select(_F.col("period").alias("year"), "column", _F.col("q1").alias("d1"),
                                                                    _F.col("q3").alias("d3"), "n_outliers")
    from ..functions.quantile import to_long
    long = to_long(df.withColumn("year", year), pf.OUTLIER_COLS, ["year"])
    sides = _F.broadcast(merged.join(direct, ["year", "column"]))  # a row for each year and column
    v = _F.col("value")
    width = _F.lit(1.5) * (_F.col("d3") - _F.col("d1"))
    ranks = long.join(sides, ["year", "column"]).groupBy("year", "column").agg(
        _F.max("n").alias("n"), *[_F.count_if(v < _F.col(q)).alias(f"below_{q}") for q in ("q1", "q3")],
        *[_F.count_if(v <= _F.col(q)).alias(f"upto_{q}") for q in ("q1", "q3")],
        _F.count_if((v < _F.col("d1") - width) | (v > _F.col("d3") + width)).alias("beyond"), _F.max("n_outliers").alias("counted"))
    slack = _F.lit(_RANK_SLACK) * _F.col("n") + _F.lit(1.0)

    def inside(q, p):
        return (_F.col(f"below_{q}") <= _F.col("n") * p + slack) & (_F.col(f"upto_{q}") >= _F.col("n") * p - slack)

    return ranks.select(_F.col("year").alias("period"), "column", "n", inside("q1", 0.25).alias("q1_in_bound"),
                        inside("q3", 0.75).alias("q3_in_bound"), (_F.col("beyond") == _F.col("counted")).alias("counted"))


@register("A11_histogram_auto", f"""
WITH long AS ({long_cte(pf.DIST_COLS)}),
{quantile_ctes([0.25, 0.75])},
w AS (SELECT s.col, s.mn, s.mx, (s.mx - s.mn) / (log2(CAST(s.n AS DOUBLE)) + 1) AS sturges,
             CAST(2 AS DOUBLE) * ({_q_pick(0.75)} - {_q_pick(0.25)}) / pow(CAST(s.n AS DOUBLE), CAST(1 AS DOUBLE) / 3) AS fd FROM stats s),
r AS (SELECT col, mn, mx, CASE WHEN mx = mn THEN 1 ELSE CAST(least(ceil((mx - mn) / CASE WHEN fd > 0 THEN least(fd, sturges)
             ELSE sturges END), {pf.MAX_BINS}) AS INTEGER) END AS bins FROM w),
b AS (SELECT l.col, CASE WHEN r.mx = r.mn THEN 0
                         ELSE least(CAST(floor((l.value - r.mn) / (r.mx - r.mn) * CAST(r.bins AS DOUBLE)) AS INTEGER), r.bins - 1) END AS bin
      FROM long l JOIN r USING (col)),
c AS (SELECT col, bin, count(*) AS cnt FROM b GROUP BY col, bin),
g AS (SELECT col, mn, mx, CAST(bins AS DOUBLE) AS bins, CAST(unnest(range(0, bins)) AS INTEGER) AS bin FROM r)
SELECT g.col AS "column", g.bin, mn + g.bin * ((mx - mn) / bins) AS bin_lo, mn + (g.bin + 1) * ((mx - mn) / bins) AS bin_hi,
       coalesce(c.cnt, 0) AS count
FROM g LEFT JOIN c ON c.col = g.col AND c.bin = g.bin""")
def q_histogram_auto(spark, sf_dir):
    return pf.histogram_auto(order_risk(spark, sf_dir))


@register("L1_label_encode_large")
def q_label_encode_large(spark, sf_dir):
    """The codes as for vocabularies too large for constants: numbered in range partitions."""
    enc = ml.label_encode(order_risk(spark, sf_dir), max_vocabulary=1)
    return enc.select("order_id", *[f"{c}_enc" for c in ml.CAT_COLS])


ORACLE["L1_label_encode_large"] = ORACLE["L1_label_encode"]


# --- O4, A10 as a matrix ---------------------------------------------------------------------------------
@register("O4_top_fraud_rules_plot", f"""WITH {_ITEMS_SQL},
top AS (SELECT array_to_string(ante, ', ') AS antecedents, array_to_string(cons, ', ') AS consequents, lift
        FROM rules WHERE list_contains(cons, 'is_fraud') ORDER BY lift DESC, antecedents, consequents LIMIT 10)
SELECT CAST(row_number() OVER (ORDER BY lift, antecedents DESC, consequents DESC) AS INTEGER) AS position,
       antecedents, consequents, lift FROM top""")
def q_top_fraud_rules_plot(spark, sf_dir):
    r = mb.association_rules(mb.frequent_itemsets(_baskets(spark, sf_dir), 0.004, 3), 1.0)
    return mb.plot_order(mb.outcome_rules(r, "is_fraud"), 10).select("position", "antecedents", "consequents", "lift")


@register("A10_correlation_wide", f"WITH c AS ({_corr_sql(list(pf.CORR_COLS))})\nSELECT a, " + ", ".join(
    f"max(CASE WHEN b = '{c}' THEN corr END) AS {c}" for c in pf.CORR_COLS) + " FROM c GROUP BY a")
def q_correlation_wide(spark, sf_dir):
    return pf.correlation_wide(order_risk(spark, sf_dir))


# the matrix itself, for a vocabulary that is given: payment methods and device types of the schema
_ONE_HOT_ITEMS = tuple(f"payment_method_{v}" for v in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")) + tuple(
    f"device_type_{v}" for v in ("F", "O", "P"))


@register("M2_one_hot_fixed", f"WITH {_ITEMS_SQL}\nSELECT order_id, " + ", ".join(
    f"""list_contains(items, '{n}') AS "{n}" """ for n in (*_ONE_HOT_ITEMS, *mb.BASKET_FLAGS)) + " FROM items")
def q_one_hot_fixed(spark, sf_dir):
    return mb.one_hot(order_risk(spark, sf_dir), vocabulary=_ONE_HOT_ITEMS)
