"""Delimited text without a written schema (S1), and with its bad cells set aside.

``infer_types`` reads every cell: each column's type is the narrowest that all of its cells
have, folded in one distributed aggregate (a handful of flags a column, whatever the
rows), so a bad cell in the last row counts as much as one in the first. The lattice:
long below double below string; boolean and date below string.

``read_checked`` casts to a given schema and keeps both sides: rows whose cells all fit, and
every cell that does not, with its row, column and reason. The file is parsed once; both
sides come from that one written table.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir
from .files import NULL_TOKENS

# Cells of each type. A cast alone would also take '1d', '2024' as a date, or ' 1'.
_LONG = r"^[+-]?[0-9]+$"
_DOUBLE = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_WORDS = {"boolean": ("True", "TRUE", "true", "False", "FALSE", "false"), "double": ("inf", "-inf", "Infinity", "-Infinity")}


def read_cells(spark: SparkSession, path: str, mode: str = "FAILFAST") -> DataFrame:
    """All columns of the files as text, with missing-value tokens as NULL; cells are not
    trimmed."""
    raw = spark.read.option("header", True).option("mode", mode).csv(path)
    return raw.select(*[_known(F.col(f"`{c}`")).alias(c) for c in raw.columns])


def _known(c: Column) -> Column:
    return F.when(c.isin(*NULL_TOKENS), F.lit(None).cast("string")).otherwise(c)


def _is(c: Column, kind: str) -> Column:
    """Is this text a cell of the type? NULL for a missing one."""
    t = F.trim(c)
    if kind == "long":
        fits = t.rlike(_LONG) & t.try_cast("long").isNotNull()
    elif kind == "double":
        fits = t.rlike(_DOUBLE) | t.isin(*_WORDS["double"])
    elif kind == "date":
        fits = t.rlike(_DATE) & t.try_cast("date").isNotNull()
    else:
        fits = t.isin(*_WORDS["boolean"])
    return F.when(c.isNotNull(), fits)


def infer_types(cells: DataFrame) -> T.StructType:
    """The narrowest type of each text column, from all rows. A column without any cell is a
    double, as a missing-value float is in pandas."""
    kinds = ("long", "double", "date", "boolean")
    flags = [F.bool_and(_is(F.col(f"`{c}`"), k)).alias(f"{i}_{k}") for i, c in enumerate(cells.columns) for k in kinds]
    row = cells.agg(*flags).first()
    of = {"long": T.LongType(), "double": T.DoubleType(), "date": T.DateType(), "boolean": T.BooleanType()}
    fields = []
    for i, c in enumerate(cells.columns):
        has = {k: row[f"{i}_{k}"] for k in kinds}
        if all(v is None for v in has.values()):
            fields.append(T.StructField(c, T.DoubleType()))
        else:
            kind = next((k for k in kinds if has[k]), None)
            fields.append(T.StructField(c, of[kind] if kind else T.StringType()))
    return T.StructType(fields)


def _typed(c: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return c
    t = F.trim(c)
    if isinstance(kind, T.DoubleType):
        t = F.when(t == "inf", "Infinity").when(t == "-inf", "-Infinity").otherwise(t)
    return t.try_cast(kind)


def read_inferred(spark: SparkSession, path: str) -> DataFrame:
    """Read delimited text with a header line; types are inferred from all cells."""
    cells = read_cells(spark, path)
    return cells.select(*[_typed(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in infer_types(cells).fields])


@dataclass(frozen=True)
class Checked:
    """``rows``: what fits the schema. ``rejected``: ``(row, key, column, cell, reason)`` of
    every cell that does not; ``row`` is the same for the cells of one record. ``total``: number
    of records read, ``bad``: of those with a rejected cell."""

    rows: DataFrame
    rejected: DataFrame
    total: int
    bad: int

    def log(self) -> DataFrame:
        """V7: ``(check, value)``: the counts, and the rejected cells of each column."""
        spark = self.rows.sparkSession
        cells = self.rejected.agg(F.count(F.lit(1)).cast("string").alias("value"))
        head = spark.createDataFrame([("total_records", str(self.total)), ("rejected_records", str(self.bad))], "check string, value string")
        by = self.rejected.groupBy("column").agg(F.count(F.lit(1)).cast("string").alias("value"))
        return (head.unionByName(cells.select(F.lit("rejected_cells").alias("check"), "value"))
                .unionByName(by.select(F.concat(F.lit("rejected_cells: "), "column").alias("check"), "value")))


def read_checked(spark: SparkSession, path: str, schema: T.StructType, key: str,
                 required: Sequence[str] = ()) -> Checked:
    """Read delimited text with ``schema`` and set bad records aside: a cell that is not of
    its column's type, a missing cell of a ``required`` column, or a record with too few or
    too many cells. ``key`` names the column that tells records apart for the reader.

    The parsed table is written once to the shared folder; ``rows`` and ``rejected`` read it."""
    header = spark.read.option("header", True).csv(path).columns
    if lacking := [f.name for f in schema.fields if f.name not in header]:
        raise ValueError(f"columns missing in the header: {', '.join(lacking)}")
    corrupt = "__record"
    text = T.StructType([*[T.StructField(c, T.StringType()) for c in header], T.StructField(corrupt, T.StringType())])
    raw = (spark.read.schema(text).option("header", True).option("enforceSchema", True).option("mode", "PERMISSIVE")
           .option("columnPruning", False)  # else cells of columns that nobody asks for aren't counted
           .option("columnNameOfCorruptRecord", corrupt).csv(path))

    def error(name: str, cell: Column, reason: str) -> Column:
        return F.struct(F.lit(name).alias("column"), cell.cast("string").alias("cell"), F.lit(reason).alias("reason"))

    errors = [F.when(F.col(corrupt).isNotNull(), error("", F.col(corrupt), "wrong number of cells"))]
    for f in schema.fields:
        cell = _known(F.col(f"`{f.name}`"))
        whole = F.col(corrupt).isNull()
        if not isinstance(f.dataType, T.StringType):
            bad = whole & cell.isNotNull() & _typed(cell, f.dataType).isNull()
            errors.append(F.when(bad, error(f.name, cell, f"not of type {f.dataType.simpleString()}")))
        if f.name in required:
            errors.append(F.when(whole & cell.isNull(), error(f.name, F.col(f"`{f.name}`"), "missing")))
    values = F.struct(*[_typed(_known(F.col(f"`{f.name}`")), f.dataType).alias(f.name) for f in schema.fields])
    folder = f"{ensure_checkpoint_dir(spark)}/checked-{uuid.uuid4().hex}"
    found = F.filter(F.array(*errors), lambda e: e.isNotNull())
    raw.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{key}`").alias("key"), values.alias("v"),
               found.alias("errors")).write.parquet(folder)
    parsed = spark.read.parquet(folder)
    n = parsed.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.size("errors") > 0).alias("bad")).first()
    rows = parsed.filter(F.size("errors") == 0).select("v.*")
    rejected = parsed.filter(F.size("errors") > 0).select("row", "key", F.inline("errors"))
    return Checked(rows, rejected, n["n"], n["bad"])
