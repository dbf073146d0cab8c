"""Enterprise rates, segment scorecards, appetite breaches, trends, counts.

All operators are lazy ``DataFrame -> DataFrame`` functions. Scorecards over
several dimensions are computed in ONE scan with GROUPING SETS: the Expand
that multiplies rows by the number of dimensions feeds the partial hash
aggregate inside the same code-generated stage, so only a handful of rows per
segment and map task reach the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exact_mean, high_risk_flag, rate_pct

RISK_DIMENSIONS = ("country", "payment_method", "product_category", "device_type", "traffic_source")


def enterprise_rates(df: DataFrame, fraud: str = "is_fraud", returned: str = "is_returned",
                     label: str = "risk_label") -> DataFrame:
    """A1: one row with fraud, return and combined high-risk rates (percent, 2 dp)."""
    return df.agg(
        rate_pct(fraud).alias("fraud_rate_pct"),
        rate_pct(returned).alias("return_rate_pct"),
        rate_pct(high_risk_flag(label)).alias("combined_high_risk_rate_pct"),
    )


def _scorecard_aggs(key: str, fraud: str, returned: str, value: str, score: str) -> list[Column]:
    return [
        F.count(F.col(key)).alias("orders"),                       # A15: non-null count
        rate_pct(fraud).alias("fraud_rate_pct"),
        rate_pct(returned).alias("return_rate_pct"),
        # exact means: the same double whatever the summation order or engine
        exact_mean(value).alias("avg_order_value"),
        exact_mean(score).alias("avg_review_score"),
    ]


def risk_scorecard(df: DataFrame, dim: str, key: str = "order_id", fraud: str = "is_fraud",
                   returned: str = "is_returned", value: str = "order_value_eur",
                   score: str = "review_score") -> DataFrame:
    """A2 (one dimension): per-segment orders and rates, fraud rate descending.
    Null segments are dropped, as a pandas groupby does."""
    return (df.filter(F.col(dim).isNotNull())
            .groupBy(F.col(dim).alias("segment"))
            .agg(*_scorecard_aggs(key, fraud, returned, value, score))
            .orderBy(F.desc("fraud_rate_pct"), F.col("segment")))


def risk_scorecards(df: DataFrame, dims: Sequence[str] = RISK_DIMENSIONS, key: str = "order_id",
                    fraud: str = "is_fraud", returned: str = "is_returned",
                    value: str = "order_value_eur", score: str = "review_score") -> DataFrame:
    """A2 (all dimensions in one scan): long table
    ``(dimension, segment, orders, fraud_rate_pct, return_rate_pct, avg_order_value, avg_review_score)``."""
    dims = list(dims)
    cols = [F.col(d) for d in dims]
    grouped = df.groupingSets([[c] for c in cols], *cols).agg(
        *_scorecard_aggs(key, fraud, returned, value, score),
        *[F.grouping(d).alias(f"__g_{i}") for i, d in enumerate(dims)],
    )
    dimension = F.lit(None).cast("string")
    segment = F.lit(None).cast("string")
    for i, d in reversed(list(enumerate(dims))):
        active = F.col(f"__g_{i}") == 0
        dimension = F.when(active, F.lit(d)).otherwise(dimension)
        segment = F.when(active, F.col(d).cast("string")).otherwise(segment)
    return (grouped
            .select(dimension.alias("dimension"), segment.alias("segment"), "orders",
                    "fraud_rate_pct", "return_rate_pct", "avg_order_value", "avg_review_score")
            # a null segment inside an active grouping set is a real null key: drop it
            .filter(F.col("segment").isNotNull())
            .orderBy("dimension", F.desc("fraud_rate_pct"), "segment"))


def breach_log(scorecards: DataFrame, df: DataFrame, multiplier: float = 2.0,
               fraud: str = "is_fraud") -> DataFrame:
    """B1/B2: segments whose rounded fraud rate is strictly above ``multiplier``
    times the UNROUNDED enterprise fraud rate.

    The threshold is a scalar subquery (``DataFrame.scalar``): Spark runs the
    one-row aggregate once and inlines the value into the filter, so there is
    no join at all, and an empty breach set is just an empty frame."""
    threshold = df.select(F.avg(F.col(fraud)) * F.lit(100.0) * F.lit(float(multiplier))).scalar()
    return (scorecards
            .filter(F.col("fraud_rate_pct") > threshold)
            .select("dimension", "segment", "fraud_rate_pct", "orders")
            .orderBy(F.desc("fraud_rate_pct"), "dimension", "segment"))


def monthly_trend(df: DataFrame, date_col: str = "order_date", key: str = "order_id",
                  fraud: str = "is_fraud", returned: str = "is_returned") -> DataFrame:
    """A3: orders and rates per ``yyyy-MM`` month, month ascending."""
    month = F.date_format(F.col(date_col), "yyyy-MM")
    return (df.filter(F.col(date_col).isNotNull())
            .groupBy(month.alias("month"))
            .agg(F.count(F.col(key)).alias("orders"),
                 rate_pct(fraud).alias("fraud_rate_pct"),
                 rate_pct(returned).alias("return_rate_pct"))
            .orderBy("month"))


def segment_rates(df: DataFrame, dim: str = "device_type",
                  flags: Sequence[str] = ("is_fraud", "is_returned")) -> DataFrame:
    """A5: unrounded outcome rates (x100) per segment; columns keep the flag names."""
    return (df.filter(F.col(dim).isNotNull())
            .groupBy(dim)
            .agg(*[(F.avg(F.col(f)) * F.lit(100.0)).alias(f) for f in flags])
            .orderBy(dim))


def value_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column, value, count)`` for each column, nulls dropped, count descending."""
    cols = list(cols)
    long = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot(
        [], cols, "column", "value")
    return (long.filter(F.col("value").isNotNull())
            .groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))
            .orderBy("column", F.desc("count"), "value"))


def scorecard_sheet(scorecards: DataFrame, dim: str) -> DataFrame:
    """One dimension's slice of the long scorecard, in report order."""
    return (scorecards.filter(F.col("dimension") == F.lit(dim)).drop("dimension")
            .orderBy(F.desc("fraud_rate_pct"), "segment"))
