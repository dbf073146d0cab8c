"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A word of the data contract: a maximal run without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: ASCII white space of that definition (``bytes.split()`` splits on the same six).
SPACES = " \t\n\v\f\r"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def fold(doc_id: Column) -> Column:
    """crc32(doc_id as text) mod 5; remainder 0 is held out. NULL for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


def held_out(doc_id: Column) -> Column:
    """A row without an id is not held out, and is not learned from either."""
    return F.coalesce(fold(doc_id) == 0, F.lit(False))


def learnable(doc_id: Column) -> Column:
    return F.coalesce(fold(doc_id) != 0, F.lit(False))


def n_words(text: Column) -> Column:
    """Number of contract words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which all executors share. Only a
    local session without that setting gets a scratch folder; elsewhere a missing
    setting is an error."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        shared = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
        if not shared:
            if not sc.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            shared = tempfile.mkdtemp(prefix="riskweave-llm-")
        sc.setCheckpointDir(shared)
    return sc.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut lineage in the shared folder, so that a lost executor loses nothing."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """``mapInArrow`` with one output batch for each input batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield fn(batch)

    return df.mapInArrow(run, schema)


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """A text column as Python strings; null becomes the empty string."""
    return [t or "" for t in batch.column(name).to_pylist()]


def record(**columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def longs(values) -> pa.Array:
    return pa.array(values, pa.int64())


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared file system, whatever its kind."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def _hashable(df: DataFrame, name: str) -> Column:
    """A column in a form that Spark can hash: maps are not."""
    column, kind = F.col(f"`{name}`"), df.schema[name].dataType
    if isinstance(kind, T.MapType):
        return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(column))))
    return F.to_json(F.struct(column)) if "map<" in kind.simpleString() else column


def row_hash(df: DataFrame, seed: int = 0) -> Column:
    """A 64-bit hash of all columns: rows of one hash (for two seeds) are the same row.
    Nulls are marked, since Spark's hash passes over them."""
    return F.xxhash64(F.lit(seed), *[x for c in df.columns for x in (F.isnull(F.col(f"`{c}`")), _hashable(df, c))])


def copy_numbers(rows: DataFrame, key: str, name: str) -> DataFrame:
    """Number the rows of each ``key`` (a long, not null) from 0, without a hot key ever
    meeting in one task: rows are numbered inside their partition and shifted by the
    partitions before. ``rows`` is small columns only and is checkpointed. Which of the
    rows of a key gets which number depends on how they lie; that all numbers are given
    does not."""
    at = F.monotonically_increasing_id()
    rows = checkpointed(rows.withColumn("__at", at)).withColumn("__part", F.shiftright("__at", 33))
    sizes = rows.groupBy(key, "__part").agg(F.count(F.lit(1)).alias("__n"))
    # a key has a row for each partition at most
    before = Window.partitionBy(key).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("__start", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    inside = Window.partitionBy(key, "__part").orderBy("__at")
    return (rows.join(starts, [key, "__part"])
            .withColumn(name, (F.col("__start") + F.row_number().over(inside) - 1).cast("long"))
            .drop("__at", "__part", "__start"))
