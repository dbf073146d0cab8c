"""Hot-customer fixture: the (customer, day) decomposition of customer history
must equal a plain per-customer ranking."""

import datetime as dt

import numpy as np
import pandas as pd

from riskweave.sources.order_risk import build_order_risk


def test_hot_customer_history_matches_bruteforce(spark):
    rng = np.random.default_rng(4)
    n = 600
    cust = np.where(rng.random(n) < 0.6, 1, rng.integers(2, 6, n))        # customer 1 holds ~60 %
    day = rng.integers(0, 20, n)                                          # several orders per day
    orders = pd.DataFrame({
        "o_orderkey": rng.permutation(np.arange(1, n + 1) * 7),
        "o_custkey": cust, "o_orderstatus": "O",
        "o_totalprice": rng.integers(100, 99999, n) / 100.0,
        "o_orderdate": [dt.datetime(2024, 1, 1) + dt.timedelta(days=int(d)) for d in day],
        "o_orderpriority": "1-URGENT"})
    lineitem = pd.DataFrame({"l_orderkey": orders.o_orderkey, "l_partkey": 1, "l_suppkey": 1,
                             "l_linenumber": 1, "l_quantity": 1.0, "l_extendedprice": 1.0,
                             "l_discount": 0.05, "l_tax": 0.0, "l_returnflag": "N", "l_linestatus": "O",
                             "l_shipdate": orders.o_orderdate})
    customer = pd.DataFrame({"c_custkey": range(1, 6), "c_name": "c", "c_nationkey": 0,
                             "c_acctbal": 10.0, "c_mktsegment": "BUILDING"})
    nation = pd.DataFrame({"n_nationkey": [0], "n_name": ["N0"], "n_regionkey": [0]})
    part = pd.DataFrame({"p_partkey": [1], "p_name": ["p"], "p_brand": ["b"], "p_type": ["T"],
                         "p_size": [1], "p_retailprice": [1.0]})
    supplier = pd.DataFrame({"s_suppkey": [1], "s_name": ["s"], "s_nationkey": [0], "s_acctbal": [0.0]})
    events = pd.DataFrame({"event_id": [1], "ts": [dt.datetime(2024, 1, 1)], "user_id": [1],
                           "event_type": ["error"], "value": [0.0], "props": ["{}"]})
    d = {k: spark.createDataFrame(v) for k, v in dict(
        orders=orders, lineitem=lineitem, customer=customer, nation=nation, part=part,
        supplier=supplier, events=events).items()}
    got = build_order_risk(d["orders"], d["lineitem"], d["customer"], d["nation"], d["part"],
                           d["supplier"], d["events"]).toPandas().set_index("order_id").sort_index()

    o = orders.copy()
    o["order_date"] = o.o_orderdate.dt.date
    o = o.sort_values(["o_custkey", "order_date", "o_orderkey"])
    o["previous_orders"] = o.groupby("o_custkey").cumcount()
    first = o.groupby("o_custkey")["order_date"].transform("min")
    o["customer_age_days"] = [(a - b).days for a, b in zip(o.order_date, first)]
    cents = (o.o_totalprice * 100).round().astype("int64")
    o["avg_order_value_eur"] = cents.groupby(o.o_custkey).transform("sum") / o.groupby(
        "o_custkey").o_orderkey.transform("count") / 100.0
    want = o.set_index("o_orderkey").sort_index()
    assert len(got) == n
    assert (got["previous_orders"] == want["previous_orders"]).all()
    assert (got["customer_age_days"] == want["customer_age_days"]).all()
    assert (got["avg_order_value_eur"] == want["avg_order_value_eur"]).all()
    assert (got.loc[want.index[want.o_custkey == 1], "customer_support_contacts"] == 1).all()
