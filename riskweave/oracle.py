"""Independent DuckDB SQL for the correctness gate.

Each string runs in DuckDB against the pre-registered driver views and must
return the same columns and values as the matching Spark query. The
``order_risk`` mapping is written here independently as straightforward SQL
(windows over whole customers are fine in a single-process check engine).
Rounding counterparts: ``np_round`` <-> ``round_even``.
"""

from __future__ import annotations

ORDER_RISK_SQL = """
line_agg AS (
  SELECT l_orderkey,
         count(*) AS n_lines,
         count(*) FILTER (WHERE l_returnflag = 'R') AS n_ret,
         min(l_partkey) AS partkey,
         min(l_suppkey) AS suppkey,
         sum(CAST(l_quantity AS BIGINT)) AS qty,
         sum(CAST(round(l_discount * 100) AS BIGINT)) AS disc_pts
  FROM lineitem GROUP BY l_orderkey
),
err AS (
  SELECT user_id, count(*) AS n_err FROM events WHERE event_type = 'error' GROUP BY user_id
),
o AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority,
         CAST(o_orderdate AS DATE) AS order_date,
         min(CAST(o_orderdate AS DATE)) OVER (PARTITION BY o_custkey) AS first_order_date,
         row_number() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE), o_orderkey) - 1 AS prev_n,
         sum(CAST(round(o_totalprice * 100) AS BIGINT)) OVER (PARTITION BY o_custkey) AS cust_cents,
         count(*) OVER (PARTITION BY o_custkey) AS cust_n
  FROM orders
),
base AS (
  SELECT o.o_orderkey AS order_id,
         o.order_date,
         n.n_name AS country,
         o.o_orderpriority AS payment_method,
         p.p_type AS product_category,
         o.o_orderstatus AS device_type,
         c.c_mktsegment AS traffic_source,
         CAST(date_diff('day', o.first_order_date, o.order_date) AS INTEGER) AS customer_age_days,
         CAST(o.prev_n AS INTEGER) AS previous_orders,
         CAST(o.cust_cents AS DOUBLE) / CAST(o.cust_n AS DOUBLE) / 100.0 AS avg_order_value_eur,
         o.o_totalprice AS order_value_eur,
         CAST(l.qty AS INTEGER) AS quantity,
         CAST(l.disc_pts AS DOUBLE) / CAST(l.n_lines AS DOUBLE) / 100.0 AS discount_rate,
         CAST(5 + 120 * abs(c.c_nationkey - s.s_nationkey) + o.o_orderkey % 100 AS DOUBLE) AS shipping_distance_km,
         CAST(1 + (o.o_orderkey * 7) % 9 AS INTEGER) AS delivery_days_estimated,
         CAST(l.n_lines >= 7 AS INTEGER) AS late_delivery_risk,
         CAST(abs(c.c_nationkey - s.s_nationkey) >= 18 AS INTEGER) AS address_mismatch,
         CAST(c.c_acctbal < 0 AS INTEGER) AS high_risk_ip,
         CAST(coalesce(e.n_err, 0) AS INTEGER) AS customer_support_contacts,
         CAST(l.n_ret * 3 >= l.n_lines * 2 AND l.n_lines >= 2 AS INTEGER) AS is_returned,
         CAST((c.c_acctbal < 0 AND o.o_orderstatus = 'P') OR o.o_orderkey % 50 = 0 AS INTEGER) AS is_fraud
  FROM o
  JOIN line_agg l ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON c.c_custkey = o.o_custkey
  JOIN nation n ON n.n_nationkey = c.c_nationkey
  JOIN part p ON p.p_partkey = l.partkey
  JOIN supplier s ON s.s_suppkey = l.suppkey
  LEFT JOIN err e ON e.user_id = o.o_custkey
),
order_risk AS (
  SELECT *,
         CAST(50 - order_id % 8 - 12 * is_returned AS DOUBLE) / 10.0 AS review_score,
         CASE WHEN is_fraud = 1 THEN 'Fraud Risk' WHEN is_returned = 1 THEN 'Return Risk'
              ELSE 'Normal' END AS risk_label
  FROM base
)"""


def with_order_risk(body: str) -> str:
    """Prefix a query over ``order_risk`` with the mapping CTEs."""
    body = body.strip()
    if body.upper().startswith("WITH RECURSIVE "):
        return "WITH RECURSIVE " + ORDER_RISK_SQL.strip() + ",\n" + body[15:]
    if body.upper().startswith("WITH "):
        return "WITH " + ORDER_RISK_SQL.strip() + ",\n" + body[5:]
    return "WITH " + ORDER_RISK_SQL.strip() + "\n" + body


ORDER_RISK_SELECT = """SELECT order_id, order_date, country, payment_method, product_category, device_type,
  traffic_source, customer_age_days, previous_orders, avg_order_value_eur, order_value_eur, quantity,
  discount_rate, shipping_distance_km, delivery_days_estimated, late_delivery_risk, address_mismatch,
  high_risk_ip, customer_support_contacts, review_score, is_returned, is_fraud, risk_label
FROM order_risk"""


# --- profiling helpers ---------------------------------------------------------------------------
def long_cte(cols, group: str | None = None, source: str = "order_risk") -> str:
    """``(grp?, column, value DOUBLE)`` rows for the numeric ``cols``; NULL/NaN dropped."""
    g = f"{group} AS grp, " if group else ""
    gf = f" AND {group} IS NOT NULL" if group else ""
    return "\nUNION ALL\n".join(
        f"SELECT {g}'{c}' AS col, CAST({c} AS DOUBLE) AS value FROM {source} "
        f"WHERE {c} IS NOT NULL AND NOT isnan(CAST({c} AS DOUBLE)){gf}" for c in cols)


def quantile_ctes(probs, group: bool = False) -> str:
    """CTEs ``stats`` (n, mean, std, mn, mx) and ``qv`` (prob, qv) over CTE ``long``,
    exact order statistics + NumPy's linear interpolation."""
    k = "grp, col" if group else "col"
    on = "r.grp = t.grp AND r.col = t.col" if group else "r.col = t.col"
    plist = ", ".join(f"CAST({p!r} AS DOUBLE)" for p in probs)
    return f"""
ranked AS (SELECT {k}, value, row_number() OVER (PARTITION BY {k} ORDER BY value) - 1 AS rk FROM long),
stats AS (SELECT {k}, count(value) AS n, avg(value) AS mean, stddev_samp(value) AS std,
                 min(value) AS mn, max(value) AS mx FROM long GROUP BY {k}),
targets AS (
  SELECT {k}, n, prob, n * prob + (CAST(1.0 AS DOUBLE) - prob) - CAST(1.0 AS DOUBLE) AS vidx
  FROM stats, (SELECT unnest([{plist}]) AS prob) p),
t2 AS (
  SELECT {k}, prob, CAST(floor(vidx) AS BIGINT) AS k_lo,
         least(CAST(floor(vidx) AS BIGINT) + 1, n - 1) AS k_hi, vidx - floor(vidx) AS t FROM targets),
qv AS (
  SELECT {', '.join('t.' + x.strip() for x in k.split(','))}, t.prob,
         CASE WHEN t.t >= 0.5 THEN b.value - (b.value - a.value) * (CAST(1.0 AS DOUBLE) - t.t)
              ELSE a.value + (b.value - a.value) * t.t END AS qv
  FROM t2 t
  JOIN ranked a ON {on.replace('r.', 'a.')} AND a.rk = t.k_lo
  JOIN ranked b ON {on.replace('r.', 'b.')} AND b.rk = t.k_hi)"""
