import numpy as np
import pandas as pd

from riskweave.operators import profile as pf


def test_numeric_summary_matches_pandas(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"x": rng.gamma(2.0, 30.0, 2000).round(2), "y": rng.integers(1, 10, 2000).astype(float)})
    got = pf.numeric_summary(spark.createDataFrame(pdf), ["x", "y"]).toPandas().set_index("column")
    want = pdf.describe().T
    for c in ["x", "y"]:
        assert got.loc[c, "count"] == want.loc[c, "count"]
        assert got.loc[c, "p25"] == want.loc[c, "25%"]
        assert got.loc[c, "p50"] == want.loc[c, "50%"]
        assert got.loc[c, "p75"] == want.loc[c, "75%"]
        assert abs(got.loc[c, "std"] - want.loc[c, "std"]) < 1e-6
        assert got.loc[c, "min"] == want.loc[c, "min"] and got.loc[c, "max"] == want.loc[c, "max"]


def test_iqr_outliers_match_pandas(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"v": np.concatenate([rng.normal(50, 10, 990), [500, 600, -300]]).round(2)})
    got = pf.iqr_outliers(spark.createDataFrame(pdf), ["v"]).first()
    q1, q3 = pdf["v"].quantile([0.25, 0.75])
    lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    n = int(((pdf["v"] < lo) | (pdf["v"] > hi)).sum())
    assert got.n_outliers == n
    assert got.lower_bound == round(lo, 2) and got.upper_bound == round(hi, 2)
    assert got.pct_outliers == round(n / len(pdf) * 100, 2)


def test_constant_column_correlation_is_null(spark):
    # constant_col fixture
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.1, 5.0), (3.0, 6.0, 5.0), (4.0, 8.2, 5.0),
                                (5.0, None, 5.0)], "a double, b double, c double")
    m = {(r.a, r.b): r.corr for r in pf.correlation_matrix(df, ["a", "b", "c"]).collect()}
    assert m[("a", "c")] is None and m[("c", "c")] is None
    pdf = df.toPandas()
    assert abs(m[("a", "b")] - pdf["a"].corr(pdf["b"])) < 1e-6  # pairwise-complete
    assert m[("a", "a")] == 1.0


def test_histogram_counts_all_rows(spark):
    pdf = pd.DataFrame({"v": np.arange(100, dtype=float)})
    h = pf.histogram(spark.createDataFrame(pdf), ["v"], bins=10).toPandas()
    assert h["count"].sum() == 100 and len(h) == 10 and (h["count"] == 10).all()


def test_density_integrates_to_one(spark):
    rng = np.random.default_rng(9)
    pdf = pd.DataFrame({"v": rng.normal(0, 1, 5000)})
    d = pf.density(spark.createDataFrame(pdf), ["v"], points=256).toPandas()
    area = np.trapezoid(d["density"], d["x"])
    assert 0.95 < area < 1.001


def test_box_stats(spark):
    pdf = pd.DataFrame({"g": ["a"] * 9 + ["b"] * 4, "v": [1, 2, 3, 4, 5, 6, 7, 8, 100, 1, 1, 2, 2]})
    b = {r.group: r for r in pf.box_stats(spark.createDataFrame(pdf), "g", ["v"]).collect()}
    a = pdf[pdf.g == "a"]["v"]
    q1, q3 = a.quantile([0.25, 0.75])
    assert b["a"].q1 == q1 and b["a"].q3 == q3 and b["a"].median == a.median()
    assert b["a"].n_fliers == 1 and b["a"].whisker_high == 8 and b["a"].whisker_low == 1
