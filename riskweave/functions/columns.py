"""Column-level building blocks (derived columns, predicates, rates)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rounding import np_round


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def month_label(date_col: Column | str = "order_date") -> Column:
    """Month bucket as text ``yyyy-MM``."""
    return F.date_format(_c(date_col), "yyyy-MM")


def month_start(date_col: Column | str = "order_date") -> Column:
    """First day of the month as DATE."""
    return F.trunc(_c(date_col), "month")


def with_month(df: DataFrame, date_col: str = "order_date", name: str = "month") -> DataFrame:
    return df.withColumn(name, month_label(date_col))


def high_risk_flag(label_col: Column | str = "risk_label", normal: str = "Normal") -> Column:
    """1 unless the label equals ``normal``; a null label counts as high risk."""
    return (~_c(label_col).eqNullSafe(F.lit(normal))).cast("int")


def with_high_risk(df: DataFrame, label_col: str = "risk_label", name: str = "is_high_risk") -> DataFrame:
    return df.withColumn(name, high_risk_flag(label_col))


def rate_pct(flag_col: Column | str, decimals: int | None = 2) -> Column:
    """Mean of a 0/1 flag in percent, ``avg(x) * 100`` (that order of
    operations is what the published rates use), rounded half-even."""
    r = F.avg(_c(flag_col)) * F.lit(100.0)
    return r if decimals is None else np_round(r, decimals)


def is_true(flag_col: Column | str) -> Column:
    """P5: integer flag to boolean (``== 1``)."""
    return _c(flag_col) == F.lit(1)


def outside(col: Column | str, lower: Column | float, upper: Column | float) -> Column:
    """Strictly outside ``[lower, upper]``; null is not outside."""
    c = _c(col)
    return (c < lower) | (c > upper)


def nan_to_null(col: Column | str) -> Column:
    """Spark orders NaN above every number; pandas treats NaN as missing."""
    c = _c(col)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def safe_ratio(num: Column, den: Column) -> Column:
    """num / den, NULL when den is 0 (ANSI mode raises on division by zero)."""
    return F.try_divide(num, den)


def zero_if_null_ratio(num: Column, den: Column) -> Column:
    """num / den with 0/0 -> 0.0 (the convention of classification reports)."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def exact_mean(col: Column | str, scale: int = 9) -> Column:
    """Mean whose value does not depend on summation order: the sum is taken
    in DECIMAL(38, scale) (exact), then divided once in double precision.
    NaN counts as missing, as in pandas."""
    c = nan_to_null(col)
    return F.sum(c.cast(f"decimal(38,{scale})")).cast("double") / F.count(c)
