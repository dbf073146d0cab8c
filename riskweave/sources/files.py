"""Order-file reader (S1/S2) and report writers."""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ORDER_SCHEMA = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("order_date", T.DateType()),
    T.StructField("country", T.StringType()),
    T.StructField("payment_method", T.StringType()),
    T.StructField("product_category", T.StringType()),
    T.StructField("device_type", T.StringType()),
    T.StructField("traffic_source", T.StringType()),
    T.StructField("customer_age_days", T.IntegerType()),
    T.StructField("previous_orders", T.IntegerType()),
    T.StructField("avg_order_value_eur", T.DoubleType()),
    T.StructField("order_value_eur", T.DoubleType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("discount_rate", T.DoubleType()),
    T.StructField("shipping_distance_km", T.DoubleType()),
    T.StructField("delivery_days_estimated", T.IntegerType()),
    T.StructField("late_delivery_risk", T.IntegerType()),
    T.StructField("address_mismatch", T.IntegerType()),
    T.StructField("high_risk_ip", T.IntegerType()),
    T.StructField("customer_support_contacts", T.IntegerType()),
    T.StructField("review_score", T.DoubleType()),
    T.StructField("is_returned", T.IntegerType()),
    T.StructField("is_fraud", T.IntegerType()),
    T.StructField("risk_label", T.StringType()),
])

# The text cells pandas' CSV reader treats as missing by default
# (public pandas documentation, ``na_values``), so the same file yields the
# same nulls here.
NULL_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
               "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def read_orders(spark: SparkSession, path: str, fmt: str = "csv",
                schema: T.StructType = ORDER_SCHEMA, on_error: str = "raise") -> DataFrame:
    """Read order records with an explicit schema.

    CSV columns are found by their header name, in any order; a missing one is an
    error, others are ignored. Cells are read as text and never trimmed (text
    values that differ in blanks stay apart); pandas' missing-value tokens become
    NULL, and each other column is cast to its type: ANSI ``cast`` raises on a
    malformed value (``on_error="raise"``, as a strict date parse does),
    ``try_cast`` turns it into NULL (``on_error="null"``) so it can be counted.
    Parquet/ORC are read with the schema directly (pushdown and pruning apply)."""
    if fmt != "csv":
        return spark.read.schema(schema).format(fmt).load(path)
    raw = spark.read.option("header", True).option("mode", "FAILFAST").csv(path)
    missing = [f.name for f in schema.fields if f.name not in raw.columns]
    if missing:
        raise ValueError(f"columns missing in the header: {', '.join(missing)}")
    cols = []
    for f in schema.fields:
        c = F.col(f"`{f.name}`")
        c = F.when(c.isin(*NULL_TOKENS), F.lit(None).cast("string")).otherwise(c)
        if not isinstance(f.dataType, T.StringType):
            c = F.trim(c)
            c = c.try_cast(f.dataType) if on_error == "null" else c.cast(f.dataType)
        cols.append(c.alias(f.name))
    return raw.select(*cols)


def write_report(df: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite",
                 single_file: bool = False) -> None:
    """Write a report table (header row for CSV). Report tables are
    small aggregates; ``single_file`` coalesces them to one output file."""
    out = df.coalesce(1) if single_file else df
    w = out.write.mode(mode)
    if fmt == "csv":
        w = w.option("header", True)
    w.format(fmt).save(path)


def sheet_name(name: str) -> str:
    """Workbook-style table names are cut to 31 characters."""
    return name[:31]


def write_report_pack(tables: Mapping[str, DataFrame], out_dir: str, fmt: str = "parquet") -> DataFrame:
    """One directory per named table (by its full name) plus a manifest
    ``(sheet, path, rows)`` (also written, as ``_manifest``); tables whose labels
    would be the same are an error. Returns the manifest DataFrame."""
    spark = next(iter(tables.values())).sparkSession
    labels = Counter(sheet_name(name).lower() for name in tables)
    if repeated := [name for name in tables if labels[sheet_name(name).lower()] > 1]:
        raise ValueError(f"table names with the same 31 characters: {', '.join(repeated)}")
    rows = []
    for name, df in tables.items():
        sheet = sheet_name(name)
        path = f"{out_dir.rstrip('/')}/{quote(name, safe='').replace('%20', '+')}"
        write_report(df, path, fmt)
        # count the written table, not the plan again
        n = spark.read.format(fmt).option("header", True).load(path).count()
        rows.append((sheet, path, int(n)))
    manifest = spark.createDataFrame(rows, "sheet string, path string, rows long")
    write_report(manifest, f"{out_dir.rstrip('/')}/_manifest", fmt)
    return manifest
