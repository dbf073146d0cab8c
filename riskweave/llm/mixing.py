"""Mixing sources to target weights by pivotal dependent rounding.

A document's expected copies are its source's target size over the source's size (3
at most). Whole copies are certain; the rest is a probability. Pivotal rounding
(Deville and Tille 1998) takes two documents with open probabilities and moves mass,
in words, from one to the other, in a random direction whose odds keep every
expectation, until one of them is 0 or 1. The words taken stay the same in each
step. Documents meet inside blocks of bounded size; a block leaves one open document
at most, and these meet again in a reduction tree until each source has one, which
is rounded by its own odds. So a source's words miss the target by less than its
last open document. All draws are seeded by hashes of the rows: reruns agree.

Defined cases: a null or empty text has size 0 and takes 0; a null source is a source
of its own, ranked last; null ids are kept as they are; repeated rows are rounded each on
its own, numbered among themselves so that they spread over the blocks; a very long text
is one row of its size, and a source whose largest document stays open misses its target
by that much at most; equal sizes are rounded in order of a hash of the row; an empty table
gives an empty table; further input columns are ignored by ``copies`` but for that hash, and
kept by ``mix``: only rows equal in every column count as the same row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, copy_numbers, n_words, row_hash

WEIGHTS = (5.0, 2.0, 1.0)
MAX_REPEAT = 3
#: Rows that a block of the first level holds on average; open rows of a later block.
BLOCK_ROWS = 8_192
SEED = 7


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """source, source_size, target from rows (source, size).

    Sources are ranked by code point (null last) across range partitions: each is
    numbered inside its partition and shifted by the partitions before. Targets are
    min(max_repeat * size, rate * weight); the rate is found by sums over the
    sources until no further source stops at its limit."""
    spark = sizes.sparkSession
    by_source = checkpointed(sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
                             .orderBy(F.asc_nulls_last("source")))
    at = F.monotonically_increasing_id()
    numbered = checkpointed(by_source.withColumn("part", F.shiftright(at, 33))
                            .withColumn("nth", at.bitwiseAND(F.lit((1 << 33) - 1))))
    parts = numbered.groupBy("part").count()  # a row for each partition
    start = F.sum("count").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = F.broadcast(parts.select("part", F.coalesce(start, F.lit(0)).alias("start")))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          ((F.col("start") + F.col("nth")) % len(weights) + 1).cast("int"))
    ranked = checkpointed(numbered.join(starts, "part").select("source", "source_size", weight.alias("weight")))
    limit = F.col("source_size").cast("double") * max_repeat
    total = float(ranked.agg(F.sum("source_size")).first()[0] or 0)
    rate, stopped = 0.0, -1
    while True:
        full = limit <= F.lit(rate) * F.col("weight")
        row = ranked.agg(F.sum(F.when(full, limit).otherwise(0.0)), F.sum(F.when(~full, F.col("weight")).otherwise(0.0)),
                         F.count_if(full)).first()
        if row[2] == stopped or not row[1]:
            break
        stopped, rate = row[2], (total - row[0]) / row[1]
    target = F.least(limit, F.lit(rate) * F.col("weight"))
    return ranked.select("source", "source_size", target.alias("target"))


def pivot(size: np.ndarray, open_p: np.ndarray, random: np.random.Generator) -> tuple[np.ndarray, int]:
    """Round open probabilities in order: (probabilities, index of the one still
    open or -1). ``size * p`` summed over all rows doesn't change."""
    p = open_p.copy()
    held = -1
    for i in range(len(p)):
        if not 0 < p[i] < 1:
            continue
        if held < 0:
            held = i
            continue
        a, b = size[held] * p[held], size[i] * p[i]  # open mass of both, in words
        up = min(size[held] - a, b)  # from i to held
        down = min(a, size[i] - b)  # from held to i
        give = up if random.random() * (up + down) < down else -down
        a, b = a + give, b - give
        p[held], p[i] = _settled(a / size[held]), _settled(b / size[i])
        if not 0 < p[held] < 1:
            held = i if 0 < p[i] < 1 else -1
    return p, held


def _settled(p: float) -> float:
    return 0.0 if p < 1e-9 else 1.0 if p > 1 - 1e-9 else p


_STATE = "doc_id {id}, size long, source_size long, target double, whole int, p double, source string, lane long, second long, copy long, open boolean"


def _round_level(rows: DataFrame, level: int, schema: str, last: bool) -> DataFrame:
    names = [f.split()[0] for f in schema.split(", ")]

    def run(table: pa.Table) -> pa.Table:
        # Arrow keeps ids exact beside nulls; long documents first: the open rest ends on a short one
        table = table.select(names).sort_by([("size", "descending"), ("lane", "ascending"), ("copy", "ascending")])
        # the block's seed comes from its rows, whatever task it runs in
        lanes = table["lane"].to_numpy().astype(np.uint64).sum() & np.uint64(2**63 - 1)
        random = np.random.default_rng([SEED, level, table.num_rows, int(lanes)])
        p, held = pivot(table["size"].to_numpy().astype(np.float64), table["p"].to_numpy(), random)
        if last and held >= 0:
            p[held] = float(random.random() < p[held])
            held = -1
        still = np.zeros(len(p), bool)
        if held >= 0:
            still[held] = True
        table = table.set_column(names.index("p"), "p", pa.array(p, pa.float64()))
        return table.set_column(names.index("open"), "open", pa.array(still, pa.bool_()))

    return rows.groupBy("source", "block").applyInArrow(run, schema)


def _lane() -> Column:
    """A hash that finds a row again: of its id, source and text."""
    return F.xxhash64("doc_id", "source", "text")


def copies(docs: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """doc_id, source, size, source_size, target, taken, copies, lane, second of every row
    (two hashes, the second of all columns, to find the row again)."""
    sized = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), _lane().alias("lane"),
                        row_hash(docs).alias("second"))
    sized = checkpointed(copy_numbers(sized, "lane", "copy"))
    targets = checkpointed(source_targets(sized, weights, max_repeat))
    joined = sized.join(targets, sized["source"].eqNullSafe(targets["source"])).select(
        sized["doc_id"], sized["source"], "size", "lane", "second", "copy", "source_size", "target")
    rate = F.when(F.col("size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rate = F.when(F.abs(rate - F.round(rate)) < 1e-12, F.round(rate)).otherwise(rate)
    state = joined.withColumn("whole", F.floor(rate).cast("int")).withColumn("p", rate - F.floor(rate)).withColumn(
        "open", (F.col("p") > 0))
    schema = _STATE.format(id=dict(docs.dtypes)["doc_id"])
    state = checkpointed(state.select(*[f.split()[0] for f in schema.split(", ")]))
    done = state.filter(~F.col("open"))
    state = state.filter("open")
    level = 0
    while True:
        # blocks of a source by hash: as many as its open rows need
        per_source = state.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
        blocks = per_source.select(F.col("source").alias("s"), F.ceil(F.col("n") / BLOCK_ROWS).alias("blocks"))
        last = not per_source.filter(F.col("n") > BLOCK_ROWS).limit(1).count()
        lane = F.pmod(F.xxhash64(F.lit(level), F.col("lane"), F.col("copy")), F.col("blocks"))
        blocked = state.join(blocks, F.col("source").eqNullSafe(F.col("s"))).withColumn("block", lane).drop("s", "blocks")
        state = checkpointed(_round_level(blocked, level, schema, last))
        done = done.unionByName(state.filter(~F.col("open")))
        if last:
            break
        state = state.filter("open")
        level += 1
    n = (F.col("whole") + F.col("p").cast("int")).cast("int")
    return done.select("doc_id", "source", "size", "source_size", "target",
                       (F.col("size") * n).cast("long").alias("taken"), n.alias("copies"), "lane", "second")


def mix(docs: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """The mixed corpus: each row of ``docs`` as often as it was taken. Texts without
    a word have no size and stay out."""
    # rows that are equal in every column are one row here, taken as often as all of them
    times = (copies(docs, weights, max_repeat).groupBy(F.col("lane").alias("__taken"), F.col("second").alias("__of"))
             .agg(F.sum("copies").alias("__copies")))
    times = checkpointed(times.filter("__copies > 0"))
    rows = docs.withColumn("__lane", _lane()).withColumn("__second", row_hash(docs))
    rows = rows.dropDuplicates(["__lane", "__second"])
    rows = rows.join(times, (F.col("__lane") == F.col("__taken")) & (F.col("__second") == F.col("__of")))
    rows = rows.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies"))))
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns])
