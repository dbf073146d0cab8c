"""Dense ranks, hot customer-days, automatic bins and kept sketches."""

import datetime as dt
import importlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskweave.functions.dense import numbered
from riskweave.operators import model as ml
from riskweave.operators import profile as pf
from riskweave.operators import sketches as sk

src = importlib.import_module("riskweave.sources.order_risk")  # the package exports a function of that name


def test_numbers_follow_the_order_over_many_partitions(spark):
    rows = spark.range(5_000).select(F.concat(F.lit("w"), F.xxhash64("id").cast("string")).alias("w")).repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = [(r["n"], r["w"]) for r in numbered(rows, "w", "n").collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert [n for n, _ in sorted(got)] == list(range(5_000))
    assert [w for _, w in sorted(got)] == sorted(w for _, w in got)
    assert numbered(rows.limit(0), "w", "n").count() == 0


def test_large_vocabularies_get_the_same_codes(spark):
    rng = np.random.default_rng(1)
    words = [None if x < 3 else f"v{x:03}" for x in rng.integers(0, 200, 900)]
    df = spark.createDataFrame([(i, w, "ab"[i % 2]) for i, w in enumerate(words)], "id int, w string, b string")
    code = {w: i for i, w in enumerate(sorted({w for w in words if w}))}
    for most in (10_000, 50, 1):
        got = {r["id"]: r for r in ml.label_encode(df, ["w", "b"], max_vocabulary=most).collect()}
        assert all(got[i]["w_enc"] == (code[w] if w else None) and got[i]["b_enc"] == i % 2 for i, w in enumerate(words))


def test_large_vocabularies_meet_in_no_single_task(spark):
    df = spark.range(2_000).select("id", F.concat(F.lit("x"), "id").alias("w")).repartition(5)
    plan = ml.label_encode(df, ["w"], max_vocabulary=10)._jdf.queryExecution().executedPlan().toString()
    # the one window without a key numbers partitions, and no plan ranks the values
    assert "dense_rank" not in plan and plan.count("windowspecdefinition") >= 1
    for line in plan.splitlines():
        if "windowspecdefinition" in line:
            assert "__n" in line and "__part" in line


def orders_of(spark, rows):
    return spark.createDataFrame(pd.DataFrame(rows, columns=["o_orderkey", "o_custkey", "o_orderdate"]).assign(
        o_orderstatus="O", o_totalprice=1.5, o_orderpriority="1"))


def test_a_hot_customer_day_is_ranked_in_slices(spark, monkeypatch):
    """60 % of the orders are of one customer and day."""
    monkeypatch.setattr(src, "SLICE_BITS", 6)
    rng = np.random.default_rng(2)
    keys = rng.permutation(4_000)[:1_500] - 300  # negative keys too
    rows = [(int(k), 1 if i < 900 else int(rng.integers(2, 9)), dt.datetime(2024, 1, 1 + (0 if i < 900 else int(rng.integers(0, 5)))))
            for i, k in enumerate(keys)]
    ranked, history = src.customer_history(orders_of(spark, rows))
    largest = ranked.groupBy("o_custkey", "order_date", "slice").count().agg(F.max("count")).first()[0]
    assert largest <= 64
    both = ranked.join(history, ["o_custkey", "order_date"])
    lower = F.aggregate(F.filter("slices", lambda x: x["slice"] < F.col("slice")), F.lit(0).cast("long"), lambda n, x: n + x["n"])
    got = {r[0]: r[1] for r in both.select("o_orderkey", F.col("orders_before_day") + lower + F.col("rank_in_slice")).collect()}
    want = {}
    for c in {r[1] for r in rows}:
        for n, (k, _, _) in enumerate(sorted((r for r in rows if r[1] == c), key=lambda r: (r[2], r[0]))):
            want[k] = n
    assert got == want


@pytest.mark.parametrize("seed", range(3))
def test_automatic_bins_are_numpys(spark, seed):
    rng = np.random.default_rng(seed)
    data = {"a": rng.normal(size=700), "b": rng.exponential(3, 700), "c": np.repeat(rng.normal(size=7), 100), "d": np.full(700, 2.5)}
    df = spark.createDataFrame(pd.DataFrame(data))
    got = pf.histogram_auto(df, list(data)).toPandas()
    for c, values in data.items():
        own = got[got.column == c].sort_values("bin")
        count, edges = np.histogram(values, bins="auto")
        if c == "d":
            assert own["count"].tolist() == [700]
            continue
        assert len(own) == len(count)
        assert np.allclose(own.bin_lo, edges[:-1]) and np.allclose(own.bin_hi, edges[1:])
        assert np.abs(own["count"].to_numpy() - count).sum() <= 2  # a value on an edge may differ by rounding
        assert own["count"].sum() == 700


def test_far_outliers_do_not_make_endless_bins(spark):
    df = spark.createDataFrame(pd.DataFrame({"a": np.append(np.random.default_rng(0).normal(size=999), 1e9)}))
    got = pf.histogram_auto(df, ["a"], max_bins=50)
    assert got.count() == 50 and got.agg(F.sum("count")).first()[0] == 1_000
    assert pf.histogram_auto(df.limit(0), ["a"]).count() == 0


def test_sketches_merge_within_their_bound(spark):
    rng = np.random.default_rng(4)
    n = 60_000
    df = spark.createDataFrame(pd.DataFrame({"m": rng.integers(0, 12, n).astype(str), "v": rng.lognormal(size=n), "w": np.nan}))
    by_month = sk.quantile_sketches(df, ["v", "w"], "m", k=400)
    assert {r["column"] for r in by_month.collect()} == {"v"}  # no value, no sketch
    merged = sk.merge_sketches(by_month, k=400)
    row = sk.quantiles(merged, (0.1, 0.25, 0.5, 0.75, 0.9)).first()
    values = np.sort(df.toPandas().v.to_numpy())
    assert row["n"] == n
    for p, q in zip((0.1, 0.25, 0.5, 0.75, 0.9), row["q"], strict=True):
        assert abs(np.searchsorted(values, q) / n - p) <= 2 * sk.rank_error(400)
        assert q in values
    size = by_month.select(F.max(F.length("sketch"))).first()[0]
    assert size < 40_000


def test_small_sketches_are_exact_and_outliers_counted(spark):
    df = spark.createDataFrame([("x", float(v)) for v in [*range(1, 101), 1_000]] + [(None, 5.0), ("x", None), ("y", 1.0)], "p string, v double")
    got = {r["period"]: r for r in sk.iqr_outliers_approx(df, ["v"], "p").collect()}
    assert (got["x"]["q1"], got["x"]["q3"], got["x"]["n"], got["x"]["n_outliers"]) == (26.0, 76.0, 101, 1)
    assert got[None]["n"] == 1 and got["y"]["n_outliers"] == 0
    whole = sk.iqr_outliers_approx(df, ["v"]).first()
    assert whole["period"] is None and whole["n"] == 103
