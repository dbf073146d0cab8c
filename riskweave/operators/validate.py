"""Data-quality validation (V1-V7): one aggregate pass, then unpivot.

Null rules follow pandas: duplicate detection treats null keys as equal,
missing cells count NULL and NaN, range checks ignore NaN/NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import nan_to_null


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def missing_cell(df: DataFrame, c: str) -> Column:
    """NULL, or NaN for floating columns."""
    dtype = df.schema[c].dataType
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.col(c).isNull() | F.isnan(F.col(c))
    return F.col(c).isNull()


def duplicate_count(key: str | Sequence[str]) -> Column:
    """V2: rows beyond the first of each key value (null == null), as an aggregate."""
    ks = _keys(key)
    # count(DISTINCT struct(..)) groups null fields as equal, as pandas duplicated() does.
    return F.count(F.lit(1)) - F.count_distinct(F.struct(*[F.col(k) for k in ks]))


def validation_log(df: DataFrame, key: str | Sequence[str] = "order_id",
                   amount: str | None = "order_value_eur", score: str | None = "review_score",
                   lo: float = 0.0, hi: float = 5.0, date: str | None = "order_date",
                   score_name: str = "review_score_out_of_range",
                   amount_name: str = "negative_order_values",
                   key_name: str = "duplicate_order_ids") -> DataFrame:
    """V1-V7: ``(check, value)`` rows in report order, computed in one scan."""
    aggs: list[tuple[str, Column]] = [
        ("total_records", F.count(F.lit(1))),
        (key_name, duplicate_count(key)),
        ("missing_values", sum((F.count_if(missing_cell(df, c)) for c in df.columns), F.lit(0))),
    ]
    if amount is not None:
        aggs.append((amount_name, F.count_if(F.col(amount) < 0)))
    if score is not None:
        s = nan_to_null(score)
        aggs.append((score_name, F.count_if((s < F.lit(lo)) | (s > F.lit(hi)))))
    if date is not None:
        d = F.col(date).cast("date")
        aggs.append(("date_range", F.concat_ws(" to ", F.min(d).cast("string"), F.max(d).cast("string"))))
    wide = df.agg(*[a.cast("string").alias(f"v{i}") for i, (_, a) in enumerate(aggs)])
    rows = F.inline(F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(name).alias("check"), F.col(f"v{i}").alias("value"))
        for i, (name, _) in enumerate(aggs)]))
    return wide.select(rows).orderBy("position").drop("position")


def missing_by_column(df: DataFrame) -> DataFrame:
    """V3 per column: ``(column, missing)`` for every column, one scan."""
    wide = df.agg(*[F.count_if(missing_cell(df, c)).alias(c) for c in df.columns])
    return wide.unpivot([], df.columns, "column", "missing")


def duplicate_keys(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """W1/V2 list form: each key value that occurs more than once, with its
    number of copies and of extra copies. A grouped count, so a key holding a
    third of all rows is pre-aggregated on the map side, never sorted in one task."""
    ks = _keys(key)
    return (df.groupBy(*ks).agg(F.count(F.lit(1)).alias("copies"))
            .filter(F.col("copies") > 1)
            .withColumn("extra_copies", F.col("copies") - 1))
