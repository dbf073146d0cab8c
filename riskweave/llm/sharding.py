"""Sharding by weighted rendezvous hashing of stable record keys.

Every (key, shard) pair gets a score ``-w / ln(u)``, ``u`` a hash of the pair in
(0, 1); a record lives in the shard with its highest score. A new shard only adds
one score to each record, so records move into the new shard or not at all, and
removing a shard moves only its own records. Everything is built-in expressions:
no Python code runs on the rows, and no text is shuffled.

Defined cases: a null key hashes like any other value (all null keys share a
shard); a null text counts no bytes and has the crc32 of the empty string;
repeated rows share their shard and take slots of their own, in any order among
themselves (a hot key is numbered in several parts); equal scores go to the smaller
shard; a very long text counts by its bytes alone; an empty table gives an empty table;
further input columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, copy_numbers

#: Rows that one (shard, part) group of the slot numbering holds on average.
ROWS_PER_PART = 50_000


def rendezvous_score(key: Column, shard: int, weight: float = 1.0) -> Column:
    """-weight / ln(u): the highest of these wins the record."""
    h = F.xxhash64(key, F.lit(shard))
    u = (F.shiftrightunsigned(h, 11).cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))
    return F.lit(-float(weight)) / F.ln(u)


def best_shard(key: Column, weights: Sequence[float]) -> Column:
    """struct(score, negated shard): the record's shard; ties to the smaller shard."""
    scores = [F.struct(rendezvous_score(key, s, w).alias("score"), F.lit(-s).alias("neg"))
              for s, w in enumerate(weights)]
    return F.greatest(*scores) if len(scores) > 1 else scores[0]


def assign(df: DataFrame, key: str, weights: Sequence[float], shard: str = "shard",
           grown: str | None = None, grown_weight: float = 1.0) -> DataFrame:
    """Add each row's shard (``weights[i]`` is the weight of shard i) and, if named,
    its shard once a shard of weight ``grown_weight`` is added."""
    n = len(weights)
    if n < 1 or min(*weights, grown_weight) <= 0:
        raise ValueError("weights must be positive")
    best = best_shard(F.col(key), weights)
    out = df.withColumn("__best", best).withColumn(shard, (-F.col("__best.neg")).cast("int"))
    if grown:
        more = rendezvous_score(F.col(key), n, grown_weight)
        out = out.withColumn(grown, F.when(more > F.col("__best.score"), F.lit(n)).otherwise(F.col(shard)).cast("int"))
    return out.drop("__best")


def number_slots(df: DataFrame, shard: str, key: str, n_shards: int, slot: str = "slot") -> DataFrame:
    """Gapless slots from 0 within each shard, without a shard ever meeting in one
    task: a shard is split into parts by a hash of the key, parts are numbered
    inside and shifted by the sizes of the parts before. ``df`` is small columns
    only and is checkpointed, because it is read for the part sizes and the rows."""
    rows = checkpointed(copy_numbers(df.withColumn("__key", F.xxhash64(key)), "__key", "__copy"))
    # as many parts as each shard needs; the rows of a hot key are spread over them
    held = {r[shard]: r["count"] for r in rows.groupBy(shard).count().collect()}  # n_shards rows
    parts = F.array(*[F.lit(max(1, -(-held.get(i, 0) // ROWS_PER_PART))) for i in range(n_shards)])
    bucket = F.floor(F.col("__copy") / ROWS_PER_PART)
    rows = rows.withColumn("__part", F.pmod(F.xxhash64(F.lit("part"), F.col("__key"), bucket), F.get(parts, F.col(shard))))
    sizes = rows.groupBy(shard, "__part").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(shard).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(F.col(shard).alias("__s"), F.col("__part").alias("__p"),
                          F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    inside = Window.partitionBy(shard, "__part").orderBy(key, "__copy")
    numbered = rows.withColumn("__i", F.row_number().over(inside) - F.lit(1))
    # one row for each ROWS_PER_PART input rows: bounded by rows / 50,000 + n_shards
    return (numbered.join(F.broadcast(starts), (F.col(shard) == F.col("__s")) & (F.col("__part") == F.col("__p")))
            .withColumn(slot, (F.col("__start") + F.col("__i")).cast("long"))
            .drop("__key", "__copy", "__part", "__i", "__s", "__p", "__start"))


def shard_documents(docs: DataFrame, weights: Sequence[float]) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard (with one more shard)."""
    rows = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + F.lit(16)).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).cast("long").alias("text_crc32"),
    )
    rows = assign(rows, "doc_id", weights, grown="grown_shard")
    out = number_slots(rows, "shard", "doc_id", len(weights))
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def write_shards(df: DataFrame, key: str, weights: Sequence[float], path: str, writers: int = 8) -> None:
    """Write ``df`` as Parquet, one folder for each shard (``shard=N``), each by
    ``writers`` tasks."""
    sharded = assign(df, key, weights)
    lane = F.pmod(F.xxhash64(F.lit("lane"), F.col(key)), F.lit(writers))
    sharded.repartition("shard", lane).write.partitionBy("shard").mode("errorifexists").parquet(path)
