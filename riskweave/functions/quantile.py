"""Exact quantiles (pandas/NumPy "linear" method) that stay distributed.

Spark's exact ``percentile`` keeps a value -> count map per group and merges
all of it in one final task: fine for low-cardinality columns, unbounded for
a column such as a per-customer mean at 100 TB. Here, in two narrow scans:

1. ``percentile_approx`` (a bounded sketch) gives, for each wanted quantile, two
   values that enclose it for certain; the same pass yields count/mean/std/min/max;
2. values below such a band are only counted, equal values inside it collapse, both
   in the map-side partial aggregate: of each key, about ``8 / accuracy`` of the
   values are shuffled and ranked. A rank outside its band raises.

Interpolation reproduces NumPy: virtual index ``n*q + (1-q) - 1`` and
``lerp(a, b, t) = a + (b-a)*t`` for t < 0.5, ``b - (b-a)*(1-t)`` otherwise.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

ACCURACY = 20_000  # of the quantile sketch: its rank error is below n / ACCURACY
BROADCAST_ROWS = 10_000  # rows of a per-key table that is broadcast after counting


def to_long(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = (),
            column_name: str = "column", value_name: str = "value") -> DataFrame:
    """Unpivot numeric ``cols`` to ``(keys..., column, value DOUBLE)``; NULL/NaN dropped."""
    cols = list(cols)
    wide = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in cols])
    long = wide.unpivot(list(keys), cols, column_name, value_name)
    v = F.col(value_name)
    return long.filter(v.isNotNull() & ~F.isnan(v))


def fractions_array(buckets: int) -> Column:
    """``array(1/buckets, ..., (buckets-1)/buckets)`` as one SQL literal
    (one JVM call instead of one per element)."""
    return F.expr("array(" + ", ".join(f"{i / buckets!r}D" for i in range(1, buckets)) + ")")


def with_bucket(df: DataFrame, bounds: str, value: str, buckets: int, out: str = "bucket") -> DataFrame:
    """Add ``out`` = number of entries of the sorted array column ``bounds``
    (length buckets-1, buckets = s*s) that are <= ``value``.

    Two-level search with fixed-size, code-generated expressions: level one
    counts the s-1 stride points <= value, level two counts the entries of
    that stride. 2(s-1) comparisons per row, no lambda (higher-order functions
    are interpreted and were measured ~10x slower) and no expression blow-up.
    ``get`` is NULL past the end of the array, which counts as "not below"."""
    s = math.isqrt(buckets)
    if s * s != buckets:
        raise ValueError("buckets must be a perfect square")
    arr, v = f"`{bounds}`", f"`{value}`"
    level1 = " + ".join(f"IF(get({arr}, {k * s - 1}) <= {v}, 1, 0)" for k in range(1, s))
    df = df.withColumn("__b1", F.expr(level1))
    level2 = " + ".join(f"IF(get({arr}, __b1 * {s} + {j}) <= {v}, 1, 0)" for j in range(0, s - 1))
    return df.withColumn(out, F.expr(f"__b1 * {s} + ({level2})")).drop("__b1")


def numpy_lerp(a: Column, b: Column, t: Column) -> Column:
    diff = b - a
    return F.when(t >= F.lit(0.5), b - diff * (F.lit(1.0) - t)).otherwise(a + diff * t)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` (materialized) with a broadcast hint if it is counted small."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def profile_long(long: DataFrame, keys: Sequence[str], probs: Sequence[float],
                 value: str = "value", accuracy: int = ACCURACY) -> DataFrame:
    """Exact quantiles plus moments of ``value`` per ``keys``.

    Returns ``(keys..., n, mean, std, min, max, q)`` where ``q`` is a
    map prob -> quantile (DOUBLE). ``mean``/``std`` are unrounded.
    """
    keys = list(keys)
    probs = [float(p) for p in probs]
    v = F.col(value)

    # pass 1: moments, and for each prob two sketch quantiles that enclose its ranks
    margin = 4.0 / accuracy
    ends = [min(1.0, max(0.0, p + side)) for p in probs for side in (-margin, margin)]
    stats = materialize(long.groupBy(*keys).agg(
        F.count(v).alias("n"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"),
        F.min(v).alias("min"), F.max(v).alias("max"),
        F.percentile_approx(v, F.array(*map(F.lit, ends)), accuracy).alias("ends")))

    # pass 2: for each prob, values below its band collapse to one row (NULL) and
    # equal values inside it to one, before anything is shuffled; those above go
    def end(at: int, limit: str, beyond: bool) -> Column:
        # under ``accuracy`` values a margin is less than a few ranks: take them all
        return F.col(limit) if beyond else F.when(F.col("n") < accuracy, F.col(limit)).otherwise(F.get("ends", F.lit(at)))

    bands = F.array(*[F.struct(F.lit(i).alias("i"), end(2 * i, "min", p <= margin).alias("lo"),
                               end(2 * i + 1, "max", p + margin >= 1).alias("hi")) for i, p in enumerate(probs)])
    side = small(stats.select(*keys, bands.alias("bands")))
    banded = (long.join(side, keys).select(*keys, value, F.explode("bands").alias("band"))
              .filter(v <= F.col("band.hi"))
              .groupBy(*keys, F.col("band.i").alias("i"), F.when(v >= F.col("band.lo"), v).alias("x"))
              .agg(F.count(F.lit(1)).alias("cnt")))

    # a band holds about 8 / accuracy of a key's values: rank those and interpolate
    order = Window.partitionBy(*keys, "i").orderBy(F.asc_nulls_first("x"))
    prob = F.get(F.array(*map(F.lit, probs)), F.col("i"))
    ranked = (banded.withColumn("r1", F.sum("cnt").over(order.rowsBetween(Window.unboundedPreceding, 0)))
              .join(small(stats.select(*keys, "n")), keys)
              .withColumn("vidx", F.col("n") * prob + (F.lit(1.0) - prob) - F.lit(1.0))
              .withColumn("k_lo", F.floor("vidx").cast("long")))
    k_hi = F.least(F.col("k_lo") + 1, F.col("n") - 1)

    def at(k: Column) -> Column:
        return F.max(F.when((F.col("r1") - F.col("cnt") <= k) & (k < F.col("r1")), F.col("x")))

    picked = ranked.groupBy(*keys, "i").agg(at(F.col("k_lo")).alias("a"), at(k_hi).alias("b"),
                                            F.max(F.col("vidx") - F.col("k_lo")).alias("t"))
    found = F.when(F.col("a").isNotNull() & F.col("b").isNotNull(), numpy_lerp(F.col("a"), F.col("b"), F.col("t"))
                   ).otherwise(F.raise_error(F.lit("a rank lies outside its band")).cast("double"))
    q = (picked.select(*keys, prob.alias("prob"), found.alias("qv")).groupBy(*keys)
         .agg(F.map_from_entries(F.collect_list(F.struct("prob", "qv"))).alias("q")))
    return stats.drop("ends").join(q, keys, "left")


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                    by: Sequence[str] = ()) -> DataFrame:
    """Long ``(by..., column, prob, quantile)`` for each numeric column."""
    long = to_long(df, cols, by)
    keys = list(by) + ["column"]
    prof = profile_long(long, keys, probs)
    return prof.select(*keys, F.explode("q").alias("prob", "quantile"))
