"""Approximate quantiles that are kept and merged.

``quantile_sketches`` stores one KLL sketch (Karnin, Lang and Liberty 2016; Spark's own
functions) for each key, period and column: a few kilobytes whatever the rows. Any periods
merge without reading the rows again, so a month that arrives late costs its own scan
only. The rank of a returned quantile is off by at most ``rank_error(k)`` of the rows, with
a probability of 99 %; up to ``k`` values a sketch is exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import np_round
from ..functions.quantile import small, to_long
from ..session import materialize
from .profile import OUTLIER_COLS

K = 2_000


def rank_error(k: int = K) -> float:
    """The normalised rank error of a KLL sketch of size ``k`` (99 % confidence, the fit that
    the sketch's library publishes for one quantile)."""
    return 2.296 / k**0.9021


def quantile_sketches(df: DataFrame, cols: Sequence[str], period: Column | str | None = None, keys: Sequence[str] = (),
                      k: int = K) -> DataFrame:
    """``(keys..., period, column, n, sketch)``: to be stored, and merged for any periods. NULL
    and NaN values are left out; rows without a period are in the one that is NULL."""
    at = F.lit(None).cast("string") if period is None else F.col(period) if isinstance(period, str) else period
    long = to_long(df.withColumn("__period", at), cols, [*keys, "__period"])
    return long.groupBy(*keys, F.col("__period").alias("period"), "column").agg(
        F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double("value", F.lit(k)).alias("sketch"))


def merge_sketches(sketches: DataFrame, by: Sequence[str] = ("column",), k: int = K) -> DataFrame:
    """``(by..., n, sketch)``: the sketches of all other keys and periods put together."""
    return sketches.groupBy(*by).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"))


def quantiles(sketches: DataFrame, probs: Sequence[float]) -> DataFrame:
    """Add ``q``: a value for each of ``probs``, each one of the values that went in."""
    wanted = F.array(*[F.lit(float(p)) for p in probs])
    return sketches.withColumn("q", F.kll_sketch_get_quantile_double("sketch", wanted))


def iqr_fences(sketches: DataFrame, fence: float = 1.5) -> DataFrame:
    """A8 from sketches: their columns with ``q1``, ``q3``, ``lower``, ``upper``."""
    out = quantiles(sketches, (0.25, 0.75)).withColumn("q1", F.get("q", F.lit(0))).withColumn("q3", F.get("q", F.lit(1)))
    width = F.lit(fence) * (F.col("q3") - F.col("q1"))
    return out.withColumn("lower", F.col("q1") - width).withColumn("upper", F.col("q3") + width).drop("q")


def iqr_outliers_approx(df: DataFrame, cols: Sequence[str] = OUTLIER_COLS, period: Column | str | None = None,
                        fence: float = 1.5, k: int = K) -> DataFrame:
    """A8 with approximate fences: ``(period, column, n, q1, q3, lower_bound, upper_bound,
    n_outliers)`` for each period: one scan for the sketches and one that counts against the
    unrounded fences."""
    bounds = materialize(iqr_fences(quantile_sketches(df, cols, period, k=k), fence))
    at = F.lit(None).cast("string") if period is None else F.col(period) if isinstance(period, str) else period
    long = to_long(df.withColumn("period", at), cols, ["period"])
    side = bounds.select(F.col("period").alias("__p"), F.col("column").alias("__c"), "lower", "upper")
    # a row for each period and column, broadcast after counting
    out = long.join(small(side), F.col("period").eqNullSafe(F.col("__p")) & (F.col("column") == F.col("__c")))
    counts = out.groupBy(F.col("period").alias("__p"), F.col("column").alias("__c")).agg(
        F.count_if((F.col("value") < F.col("lower")) | (F.col("value") > F.col("upper"))).alias("n_outliers"))
    return (bounds.join(counts, F.col("period").eqNullSafe(F.col("__p")) & (F.col("column") == F.col("__c")))
            .select("period", "column", "n", "q1", "q3", np_round("lower", 2).alias("lower_bound"),
                    np_round("upper", 2).alias("upper_bound"), "n_outliers"))
