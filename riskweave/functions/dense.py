"""Global numbers for sorted rows without a window over all of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize


def numbered(rows: DataFrame, by: str, name: str) -> DataFrame:
    """Number ``rows`` from 0 in order of ``by``: they are sorted in range partitions,
    numbered inside each and shifted by the sizes of those before. Rows with the
    same value get different numbers, so give it distinct ones for a dense rank. The sorted
    rows are written once; the only window without a key holds one row a partition."""
    at = F.monotonically_increasing_id()
    spread = materialize(rows.orderBy(by).withColumn("__part", F.shiftright(at, 33))
                         .withColumn("__nth", at.bitwiseAND(F.lit((1 << 33) - 1))))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = spread.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    starts = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    return (spread.join(F.broadcast(starts), "__part")
            .withColumn(name, (F.col("__start") + F.col("__nth")).cast("long")).drop("__part", "__nth", "__start"))
