import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from riskweave.functions import np_round
from riskweave.functions.quantile import exact_quantiles, with_bucket


def test_np_round_half_cases(spark):
    # half_cases fixture: values whose decimal text ends in 5
    vals = [-47.385, 149.95499999999998, 3.7249999999999996, 262706.915, 0.125, -0.005, 2.5]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r[0] for r in df.select(np_round("x", 2)).collect()]
    assert got == [float(np.round(v, 2)) for v in vals]
    got0 = [r[0] for r in df.select(np_round("x", 0)).collect()]
    assert got0 == [float(np.round(v, 0)) + 0.0 for v in vals]


def test_bucket_search_matches_searchsorted(spark):
    rng = np.random.default_rng(7)
    bounds = np.sort(rng.normal(size=1023)).tolist()
    bounds[100:140] = [bounds[100]] * 40  # repeated bounds (hot values)
    bounds = sorted(bounds)
    values = rng.normal(size=500).tolist() + bounds[:50] + [-1e9, 1e9]
    df = spark.createDataFrame([(float(v),) for v in values], "value double").withColumn(
        "b", F.array(*[F.lit(float(x)) for x in bounds]))
    got = [r["bucket"] for r in with_bucket(df, "b", "value", 1024).select("bucket").collect()]
    want = np.searchsorted(np.array(bounds), np.array(values), side="right").tolist()
    assert got == want


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(1)
    a = np.concatenate([rng.exponential(50, 3000), np.full(1500, 7.0)])  # one hot value
    b = rng.integers(0, 9, 4500).astype(float)
    pdf = pd.DataFrame({"a": a, "b": b, "g": rng.integers(0, 3, 4500)})
    df = spark.createDataFrame(pdf)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    q = exact_quantiles(df, ["a", "b"], probs).toPandas()
    for col in ["a", "b"]:
        for p in probs:
            got = q[(q["column"] == col) & (q["prob"] == p)]["quantile"].iloc[0]
            assert got == np.quantile(pdf[col].to_numpy(), p), (col, p)
    qg = exact_quantiles(df, ["a"], [0.25, 0.75], by=["g"]).toPandas()
    for g, sub in pdf.groupby("g"):
        for p in [0.25, 0.75]:
            got = qg[(qg["g"] == g) & (qg["prob"] == p)]["quantile"].iloc[0]
            assert got == np.quantile(sub["a"].to_numpy(), p)
