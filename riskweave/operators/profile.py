"""Numeric profiling (A7-A13): summary, IQR outliers, correlation,
histograms, density curves, box statistics.

Every operator works on the long form ``(column, value)`` so that one scan
serves all requested columns, and every per-column side table (bounds,
ranges) has one row per requested column -- a size fixed by the call, not by
the data -- so broadcasting it is safe.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import np_round, round6
from ..functions.quantile import profile_long, small, to_long
from ..session import materialize

# The report's columns in its order.
NUMERIC_SUMMARY_COLS = ("order_value_eur", "avg_order_value_eur", "discount_rate",
                        "shipping_distance_km", "delivery_days_estimated", "customer_age_days",
                        "previous_orders", "review_score", "customer_support_contacts")
OUTLIER_COLS = ("order_value_eur", "shipping_distance_km", "delivery_days_estimated")
DIST_COLS = ("order_value_eur", "discount_rate", "delivery_days_estimated", "customer_age_days",
             "review_score", "shipping_distance_km")
CORR_COLS = ("customer_age_days", "previous_orders", "avg_order_value_eur", "order_value_eur",
             "discount_rate", "shipping_distance_km", "delivery_days_estimated",
             "late_delivery_risk", "address_mismatch", "high_risk_ip",
             "customer_support_contacts", "review_score", "is_returned", "is_fraud")


MAX_BINS = 10_000  # of an automatic histogram: a column with far outliers would have any number


def _position(col: str, names: Sequence[str]) -> Column:
    return F.array_position(F.array(*[F.lit(n) for n in names]), F.col(col))


def _requested(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row for each requested column, so that none is missing in a report."""
    return F.broadcast(df.sparkSession.createDataFrame([(c,) for c in cols], "column string"))


def numeric_summary(df: DataFrame, cols: Sequence[str] = NUMERIC_SUMMARY_COLS) -> DataFrame:
    """``(column, count, mean, std, min, p25, p50, p75, max)`` per column.
    Quantiles are exact (NumPy linear); mean/std rounded to 6 decimals
    because float sums depend on summation order. A column without a value has
    count 0."""
    prof = profile_long(to_long(df, cols), ["column"], [0.25, 0.5, 0.75])
    return (_requested(df, cols).join(prof, "column", "left").select(
        "column", F.coalesce("n", F.lit(0)).cast("long").alias("count"), round6("mean").alias("mean"), round6("std").alias("std"),
        F.col("min"), F.col("q")[0.25].alias("p25"), F.col("q")[0.5].alias("p50"),
        F.col("q")[0.75].alias("p75"), F.col("max"))
        .orderBy(_position("column", list(cols))))


def iqr_bounds(df: DataFrame, cols: Sequence[str], k: float = 1.5) -> DataFrame:
    """``(column, q1, q3, lower, upper)`` with unrounded fences."""
    prof = profile_long(to_long(df, cols), ["column"], [0.25, 0.75])
    q1, q3 = F.col("q")[0.25], F.col("q")[0.75]
    iqr = q3 - q1
    return prof.select("column", q1.alias("q1"), q3.alias("q3"),
                       (q1 - F.lit(k) * iqr).alias("lower"), (q3 + F.lit(k) * iqr).alias("upper"))


def iqr_outliers(df: DataFrame, cols: Sequence[str] = OUTLIER_COLS, k: float = 1.5) -> DataFrame:
    """``(column, lower_bound, upper_bound, n_outliers, pct_outliers)``.
    Counting uses the unrounded fences; reported fences are rounded half-even
    to 2 dp; the percentage is of ALL rows (nulls included). A column without a
    value has no fences and no outliers."""
    bounds = materialize(iqr_bounds(df, cols, k))
    long = to_long(df, cols)
    counts = (long.join(F.broadcast(bounds.select("column", "lower", "upper")), "column")
              .groupBy("column")
              .agg(F.count_if((F.col("value") < F.col("lower")) | (F.col("value") > F.col("upper")))
                   .alias("n_outliers")))
    total = df.select(F.count(F.lit(1))).scalar()
    out = (_requested(df, cols).join(bounds, "column", "left").join(counts, "column", "left")
           .fillna(0, ["n_outliers"]))
    return (out.select(
        "column", np_round("lower", 2).alias("lower_bound"), np_round("upper", 2).alias("upper_bound"),
        F.col("n_outliers"),
        np_round(F.try_divide(F.col("n_outliers"), total) * F.lit(100.0), 2).alias("pct_outliers"))
        .orderBy(_position("column", list(cols))))


def correlation_matrix(df: DataFrame, cols: Sequence[str] = CORR_COLS) -> DataFrame:
    """A10: Pearson correlation for every ordered pair ``(a, b, corr)``,
    pairwise-complete, NULL for a constant column (pandas gives NaN).
    Rounded to 6 decimals.

    Two aggregate passes, both a single row: (1) per column null count and
    mean; (2) sums of mean-centred values -- shared per column when a column
    has no nulls, masked per pair otherwise -- so the common case is
    ~k(k+3)/2 plain sums instead of a moment aggregate per pair (measured
    5-10x slower). Centring keeps the one-pass sum formula stable. The
    expressions are handed to Spark as SQL text: building thousands of
    Column objects one py4j call at a time cost more than the scan."""
    cols = list(cols)
    # NaN is missing, as NULL is
    q = {c: f"nullif(CAST(`{c}` AS DOUBLE), DOUBLE('NaN'))" for c in cols}
    first = df.agg(*[F.expr(f"count_if({q[c]} IS NULL)").alias(f"z{i}") for i, c in enumerate(cols)],
                   *[F.expr(f"avg({q[c]})").alias(f"m{i}") for i, c in enumerate(cols)]).first()
    # 2k numbers, bounded by the number of requested columns
    nulls = [int(first[f"z{i}"]) for i in range(len(cols))]
    means = [float(first[f"m{i}"]) if first[f"m{i}"] is not None else 0.0 for i in range(len(cols))]
    # masked and centred once for each row, below the aggregate; NULL where a value is missing
    centred = df.selectExpr(*[f"{q[c]} - CAST({means[i]!r} AS DOUBLE) AS x{i}" for i, c in enumerate(cols)])
    cx = {c: f"x{i}" for i, c in enumerate(cols)}
    aggs = ["count(1) AS n"]
    for i, c in enumerate(cols):
        if nulls[i] == 0:
            aggs += [f"sum({cx[c]}) AS s{i}", f"sum({cx[c]} * {cx[c]}) AS q{i}"]
    terms: dict[tuple[int, int], tuple] = {}
    for i, a in enumerate(cols):
        for j in range(i, len(cols)):
            b = cols[j]
            if nulls[i] == 0 and nulls[j] == 0:
                aggs.append(f"sum({cx[a]} * {cx[b]}) AS p{i}_{j}")
                terms[(i, j)] = ("n", f"s{i}", f"s{j}", f"q{i}", f"q{j}", f"p{i}_{j}")
            else:
                both = f"({cx[a]} IS NOT NULL AND {cx[b]} IS NOT NULL)"
                xa, xb = f"IF({both}, {cx[a]}, NULL)", f"IF({both}, {cx[b]}, NULL)"
                aggs += [f"count_if({both}) AS n{i}_{j}", f"sum({xa}) AS sa{i}_{j}", f"sum({xb}) AS sb{i}_{j}",
                         f"sum({xa} * {xa}) AS qa{i}_{j}", f"sum({xb} * {xb}) AS qb{i}_{j}",
                         f"sum({xa} * {xb}) AS p{i}_{j}"]
                terms[(i, j)] = (f"n{i}_{j}", f"sa{i}_{j}", f"sb{i}_{j}", f"qa{i}_{j}", f"qb{i}_{j}", f"p{i}_{j}")
    sums = centred.selectExpr(*aggs)

    # one row per ordered pair with its six raw sums (both orders from the same
    # one-row aggregate), then ONE correlation expression per row
    def struct(a: str, b: str, t: tuple) -> str:
        fields = ", ".join(f"'{k}', CAST({v} AS DOUBLE)" for k, v in zip(("n", "sa", "sb", "qa", "qb", "p"), t))
        return f"named_struct('a', '{a}', 'b', '{b}', {fields})"
    structs = []
    for (i, j), t in terms.items():
        structs.append(struct(cols[i], cols[j], t))
        if i != j:
            structs.append(struct(cols[j], cols[i], (t[0], t[2], t[1], t[4], t[3], t[5])))
    per_pair = sums.selectExpr(f"inline(array({', '.join(structs)}))")
    # a constant column (zero variance) has no correlation (NaN in pandas);
    # the clamp sits inside the IF because least/greatest skip NULLs
    corr = F.expr("""IF(n * qa - sa * sa > 0 AND n * qb - sb * sb > 0,
        greatest(-1.0D, least(1.0D, (n * p - sa * sb) / sqrt((n * qa - sa * sa) * (n * qb - sb * sb)))),
        NULL)""")
    return (per_pair.select("a", "b", round6(corr).alias("corr"))
            .orderBy(_position("a", cols), _position("b", cols)))


def correlation_wide(df: DataFrame, cols: Sequence[str] = CORR_COLS) -> DataFrame:
    """A10 as a matrix: ``(a, <one column for each of cols>)``, a row for each of ``cols`` in order."""
    cols = list(cols)
    long = correlation_matrix(df, cols)
    wide = long.groupBy("a").agg(*[F.max(F.when(F.col("b") == c, F.col("corr"))).alias(c) for c in cols])
    return wide.orderBy(_position("a", cols))


def _ranges(long: DataFrame, keys: Sequence[str]) -> DataFrame:
    return long.groupBy(*keys).agg(F.min("value").alias("mn"), F.max("value").alias("mx"),
                                   F.count("value").alias("n"), F.stddev_samp("value").alias("sd"))


def _bin_index(bins: int) -> Column:
    span = F.col("mx") - F.col("mn")
    raw = F.floor((F.col("value") - F.col("mn")) / span * F.lit(float(bins)))
    return F.when(span == 0, F.lit(0)).otherwise(F.least(raw.cast("int"), F.lit(bins - 1)))


def histogram(df: DataFrame, cols: Sequence[str] = DIST_COLS, bins: int = 20) -> DataFrame:
    """Equal-width histogram over [min, max] per column:
    ``(column, bin, bin_lo, bin_hi, count)``; the last bin is closed. Empty bins
    have count 0; the bins of a column without a value have no edges."""
    long = to_long(df, cols)
    rng = materialize(_ranges(long, ["column"]))
    width = (F.col("mx") - F.col("mn")) / F.lit(float(bins))
    counted = (long.join(F.broadcast(rng), "column")
               .groupBy("column", _bin_index(bins).alias("bin")).agg(F.count(F.lit(1)).alias("count")))
    every = _requested(df, cols).join(F.broadcast(rng), "column", "left").select(
        "column", "mn", "mx", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return (every.join(counted, ["column", "bin"], "left")
            .select("column", "bin",
                    (F.col("mn") + F.col("bin") * width).alias("bin_lo"),
                    (F.col("mn") + (F.col("bin") + 1) * width).alias("bin_hi"),
                    F.coalesce("count", F.lit(0)).cast("long").alias("count"))
            .orderBy(_position("column", list(cols)), "bin"))


def auto_bins(df: DataFrame, cols: Sequence[str] = DIST_COLS, max_bins: int = MAX_BINS) -> DataFrame:
    """``(column, mn, mx, bins)``: the number of equal bins that NumPy's "auto" rule gives: the
    smaller width of Sturges (range / (log2 n + 1)) and Freedman-Diaconis (2 IQR / n^(1/3),
    unless that is 0), at most ``max_bins``; 1 for a constant column."""
    prof = profile_long(to_long(df, cols), ["column"], [0.25, 0.75])
    n = F.col("n").cast("double")
    span = F.col("max") - F.col("min")
    sturges = span / (F.log2(n) + F.lit(1.0))
    fd = F.lit(2.0) * (F.col("q")[0.75] - F.col("q")[0.25]) / F.pow(n, F.lit(1.0 / 3.0))
    width = F.when(fd > 0, F.least(fd, sturges)).otherwise(sturges)
    bins = F.when(span == 0, F.lit(1)).otherwise(F.least(F.ceil(span / width), F.lit(max_bins))).cast("int")
    return prof.select("column", F.col("min").alias("mn"), F.col("max").alias("mx"), bins.alias("bins"))


def histogram_auto(df: DataFrame, cols: Sequence[str] = DIST_COLS, max_bins: int = MAX_BINS) -> DataFrame:
    """A11 with automatic bins: ``(column, bin, bin_lo, bin_hi, count)``; the number of bins comes
    from a first stage over the rows, one row a column. The last bin is closed, empty bins have
    count 0; a column without a value has no rows."""
    long = to_long(df, cols)
    rng = F.broadcast(materialize(auto_bins(df, cols, max_bins)))
    span, bins = F.col("mx") - F.col("mn"), F.col("bins").cast("double")
    at = F.when(span == 0, F.lit(0)).otherwise(
        F.least(F.floor((F.col("value") - F.col("mn")) / span * bins).cast("int"), F.col("bins") - 1))
    counted = (long.join(rng, "column").groupBy("column", at.alias("bin")).agg(F.count(F.lit(1)).alias("count")))
    every = rng.select("*", F.explode(F.sequence(F.lit(0), F.col("bins") - 1)).alias("bin"))
    width = span / bins
    return (every.join(counted, ["column", "bin"], "left")
            .select("column", "bin", (F.col("mn") + F.col("bin") * width).alias("bin_lo"),
                    (F.col("mn") + (F.col("bin") + 1) * width).alias("bin_hi"),
                    F.coalesce("count", F.lit(0)).cast("long").alias("count"))
            .orderBy(_position("column", list(cols)), "bin"))


def density(df: DataFrame, cols: Sequence[str] = DIST_COLS, points: int = 128, per_bandwidth: int = 8,
            reach: float = 6.0) -> DataFrame:
    """Gaussian KDE curve (Scott bandwidth ``h = sd * n^(-1/5)``) on
    ``points`` grid points over [min, max], ``(column, point, x, density)``.

    Values are first counted into bins of width ``h / per_bandwidth`` (one
    distributed aggregate, empty bins take no row), so the curve is as accurate
    whatever the number of rows: bins narrow as the bandwidth does. Each bin's
    centre then reaches the grid points within ``reach`` bandwidths.
    """
    long = to_long(df, cols)
    rng = materialize(_ranges(long, ["column"])
                      .withColumn("h", F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2)))
                      .filter(F.col("h") > 0))
    width = F.col("h") / F.lit(float(per_bandwidth))
    bin_ = F.floor((F.col("value") - F.col("mn")) / width)
    fine = (long.join(F.broadcast(rng.select("column", "mn", "h")), "column")
            .groupBy("column", bin_.alias("bin")).agg(F.count(F.lit(1)).alias("cnt"))
            .join(F.broadcast(rng), "column"))
    steps = max(points - 1, 1)
    step = (F.col("mx") - F.col("mn")) / F.lit(float(steps))
    offset = (F.col("bin") + F.lit(0.5)) * width  # of the bin's centre from the minimum
    first = F.greatest(F.lit(0), F.ceil((offset - F.lit(reach) * F.col("h")) / step).cast("int"))
    last = F.least(F.lit(points - 1), F.floor((offset + F.lit(reach) * F.col("h")) / step).cast("int"))
    z = (F.col("point") * step - F.col("offset")) / F.col("h")
    curve = (fine.select("column", "cnt", "mn", "mx", "n", "h", offset.alias("offset"), first.alias("first"), last.alias("last"))
             .filter(F.col("first") <= F.col("last"))
             .withColumn("point", F.explode(F.sequence("first", "last")))
             .groupBy("column", "point").agg(F.sum(F.col("cnt") * F.exp(F.lit(-0.5) * z * z)).alias("s")))
    norm = F.lit(1.0 / math.sqrt(2.0 * math.pi)) / (F.col("n") * F.col("h"))
    every = F.broadcast(rng).select("*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"))
    return (every.join(curve, ["column", "point"], "left")
            .select("column", "point", (F.col("mn") + F.col("point") * step).alias("x"),
                    (F.coalesce("s", F.lit(0.0)) * norm).alias("density"))
            .orderBy(_position("column", list(cols)), "point"))


def box_stats(df: DataFrame, by: str = "risk_label",
              cols: Sequence[str] = ("order_value_eur", "review_score"), k: float = 1.5) -> DataFrame:
    """Per group and column, quartiles, whiskers (furthest data points
    within the 1.5 IQR fences) and the number of fliers.
    ``(group, column, n, q1, median, q3, whisker_low, whisker_high, n_fliers)``."""
    long = to_long(df.filter(F.col(by).isNotNull()), cols, [by]).withColumnRenamed(by, "group")
    keys = ["group", "column"]
    prof = profile_long(long, keys, [0.25, 0.5, 0.75])
    q1, q3 = F.col("q")[0.25], F.col("q")[0.75]
    fences = materialize(prof.select(*keys, "n", q1.alias("q1"), F.col("q")[0.5].alias("median"), q3.alias("q3"),
                         (q1 - F.lit(k) * (q3 - q1)).alias("lo_f"), (q3 + F.lit(k) * (q3 - q1)).alias("hi_f")))
    v = F.col("value")
    inside = (v >= F.col("lo_f")) & (v <= F.col("hi_f"))
    # one row per (group, column), broadcast after counting
    agg = (long.join(small(fences.select(*keys, "lo_f", "hi_f")), keys)
           .groupBy(*keys)
           .agg(F.min(F.when(inside, v)).alias("whisker_low"), F.max(F.when(inside, v)).alias("whisker_high"),
                F.count_if(~inside).alias("n_fliers")))
    return (fences.join(agg, keys)
            .select("group", "column", "n", "q1", "median", "q3", "whisker_low", "whisker_high", "n_fliers")
            .orderBy("group", _position("column", list(cols))))
