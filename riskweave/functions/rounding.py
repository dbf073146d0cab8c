"""Rounding that matches NumPy/pandas: scale, round half to even, unscale.

Spark's ``round`` is HALF_UP on the decimal expansion and ``bround`` works on
the exact binary value; neither agrees with NumPy on values such as
3.7249999999999996 or -47.385. ``rint(x * 10^d) / 10^d`` does, and DuckDB's
``round_even(x, d)`` is the oracle counterpart.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def np_round(col: Column | str, decimals: int = 2) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    scale = float(10 ** decimals)
    # "+ 0.0" turns a rint result of -0.0 into 0.0
    return F.rint(c * F.lit(scale)) / F.lit(scale) + F.lit(0.0)


def round6(col: Column | str) -> Column:
    """Stabilise float sums whose last digits depend on summation order."""
    return np_round(col, 6)
