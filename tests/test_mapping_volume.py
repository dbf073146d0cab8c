"""What the mapping exchanges: each order once for its history and once for its lines."""

import contextlib
import io
import re
from importlib import import_module

from pyspark.sql import functions as F

from riskweave.sources import order_risk as mapped
from riskweave.sources import prepare_order_risk

from conftest import SF_SMALL

src = import_module("riskweave.sources.order_risk")


def _exchanges(spark, df) -> list[str]:
    known = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables too large to broadcast
    try:
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("simple")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", known)
    return [",".join(re.findall(r"([a-z_]+)#\d+L?", m)) for m in re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", buf.getvalue())]


def test_orders_are_exchanged_once_for_history_and_once_for_lines(spark):
    by = sorted(_exchanges(spark, mapped(spark, SF_SMALL)))
    # orders, their counts and their history meet by slice; days and customers need one exchange by customer
    assert by.count("o_custkey,order_date,slice") == 3 and "o_custkey,order_date" not in by
    assert by.count("o_custkey") == 1 and by.count("o_orderkey") == 1
    # line aggregates go to parts and suppliers, not the orders
    assert by.count("l_orderkey") == 2 and by.count("partkey") == by.count("suppkey") == 1


def test_the_prepared_table_is_not_exchanged_again_before_it_is_written(spark, tmp_path, monkeypatch):
    hints = []
    frame = type(spark.range(0))
    known = frame.hint
    monkeypatch.setattr(frame, "hint", lambda self, name, *a: hints.append(name) or known(self, name, *a))
    prepare_order_risk(spark.range(10).toDF("order_id"), str(tmp_path / "t"))
    assert hints == []


def test_previous_orders_follow_day_and_key_whatever_the_slices(spark, monkeypatch):
    # one customer has all orders, on three days
    t = {name: src.read_table(spark, SF_SMALL, name) for name in src.DRIVER_TABLES}
    day = F.timestamp_add("DAY", F.col("o_orderkey") % 3, F.lit("2024-01-01").cast("timestamp"))
    t["orders"] = t["orders"].withColumn("o_custkey", F.lit(1).cast("long")).withColumn("o_orderdate", day)
    everyone = sorted((r[0] % 3, r[0]) for r in t["orders"].select("o_orderkey").collect())
    place = {key: i for i, (_, key) in enumerate(everyone)}
    for bits in (2, 24):
        monkeypatch.setattr(src, "SLICE_BITS", bits)
        out = src.build_order_risk(*[t[n] for n in ("orders", "lineitem", "customer", "nation", "part", "supplier", "events")])
        got = {r[0]: r[1] for r in out.select("order_id", "previous_orders").collect()}
        assert got and got == {k: place[k] for k in got}
