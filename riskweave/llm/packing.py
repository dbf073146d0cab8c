"""Conflict-constrained best-fit packing of documents into bins.

Documents are laid out, longest first, in bins of fixed capacity. A bin may not hold
two members of a duplicate cluster, nor more than ``per_source`` pieces of a source.
Bins are kept in order of their residual, each with bitmaps of the clusters and
sources inside; the search starts at the smallest residual that fits and goes on to
its successors until a bin is compatible: the tightest compatible one. A document
over the capacity is cut into full bins and a rest; nothing is dropped.

Rows are dealt by hash into groups of bounded size, repeated rows each by its number
among them, so no key gathers in one task; each group is packed on its own in one pass. A
task holds no texts, only sizes.

Defined cases: a null or empty text has no words and takes no place (bin null,
offset 0); null sources are one source, null ids are kept as they are; repeated rows are
members of one cluster; a very long text is cut into as many pieces as it needs, dealt
one by one; equal lengths are laid out in order of id (null last) and piece, and equal
residuals filled in order of bins; an empty table gives an empty table; further input
columns are ignored (but for the one named as ``cluster``).
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, copy_numbers, longs, n_words

CAPACITY = 2_048  # words of a bin
PER_SOURCE = 4  # pieces of one source in a bin
GROUP_ROWS = 4_096  # rows that are packed together, on average


def best_fit(sizes: list[int], sources: list[int], clusters: list[int], capacity: int = CAPACITY,
             per_source: int = PER_SOURCE) -> list[tuple[int, int]]:
    """(bin, offset) of each piece, in the order given (longest first is best).

    ``sources`` and ``clusters`` are small numbers: each is a bit (a source has
    ``per_source`` bit planes, one for each piece that a bin may hold of it)."""
    by_residual: list[tuple[int, int]] = []  # (residual, bin), ascending
    in_clusters: list[int] = []
    in_sources: list[list[int]] = []  # a bin's bit planes
    placed = []
    for size, source, cluster in zip(sizes, sources, clusters, strict=True):
        s, c = 1 << source, 1 << cluster
        at = bisect_left(by_residual, (size, -1))
        while at < len(by_residual):
            residual, number = by_residual[at]
            if not in_clusters[number] & c and not in_sources[number][-1] & s:
                del by_residual[at]
                break
            at += 1
        else:
            residual, number = capacity, len(in_clusters)
            in_clusters.append(0)
            in_sources.append([0] * per_source)
        in_clusters[number] |= c
        planes = in_sources[number]
        planes[next(i for i, plane in enumerate(planes) if not plane & s)] |= s
        placed.append((number, capacity - residual))
        if residual > size:
            insort(by_residual, (residual - size, number))
    return placed


def pieces(docs: DataFrame, capacity: int = CAPACITY, cluster: str | None = None) -> DataFrame:
    """doc_id, source, cluster, n_words, piece, start, length: one row for each
    document, or for each bin's worth of a longer one. The cluster is the value of the
    column ``cluster``, as a near-duplicate operator gives it; where that is null or no
    column is named, it is the text without regard to case and white space."""
    plain = F.lower(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", " "))
    of_text = F.xxhash64(F.trim(plain))
    own = F.coalesce(F.when(F.col(cluster).isNotNull(), F.xxhash64(F.lit("cluster"), F.col(cluster))), of_text) if cluster else of_text
    sized = docs.select("doc_id", "source", own.alias("cluster"), n_words(F.col("text")).alias("n_words"))
    cuts = F.sequence(F.lit(0).cast("long"), F.greatest(F.lit(0).cast("long"), F.floor((F.col("n_words") - 1) / capacity)))
    return (sized.withColumn("piece", F.explode(cuts)).withColumn("start", F.col("piece") * capacity)
            .withColumn("length", F.least(F.lit(capacity).cast("long"), F.col("n_words") - F.col("start"))))


def pack(docs: DataFrame, capacity: int = CAPACITY, per_source: int = PER_SOURCE, cluster: str | None = None) -> DataFrame:
    """doc_id, source, cluster, piece, start, length, bin (``group-number``), offset of
    every piece. Words ``start`` to ``start + length`` go to ``offset`` of the bin."""
    keyed = pieces(docs, capacity, cluster).withColumn("key", F.xxhash64("doc_id", "piece", "cluster"))
    cut = checkpointed(copy_numbers(keyed, "key", "copy"))
    groups = max(1, -(-cut.count() // GROUP_ROWS))
    # the piece is part of the hash, so a very long document spreads too
    lane = F.pmod(F.xxhash64("key", "copy"), F.lit(groups))
    schema = (f"doc_id {dict(docs.dtypes)['doc_id']}, source string, cluster long, piece long, start long, "
              "length long, bin string, offset long")

    def run(key: tuple, table: pa.Table) -> pa.Table:
        # Arrow keeps ids exact beside nulls
        table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("copy", "ascending")])
        source = pc.dictionary_encode(table["source"].combine_chunks(), null_encoding="encode").indices.to_pylist()
        cluster = table["cluster"].combine_chunks().dictionary_encode().indices.to_pylist()
        lengths = table["length"].to_pylist()
        some = sum(x > 0 for x in lengths)  # the rest have no words
        at = best_fit(lengths[:some], source[:some], cluster[:some], capacity, per_source)
        bins = [f"{key[0].as_py()}-{b}" for b, _ in at] + [None] * (len(lengths) - some)
        out = table.select(["doc_id", "source", "cluster", "piece", "start", "length"])
        out = out.append_column("bin", pa.array(bins, pa.string()))
        return out.append_column("offset", longs([o for _, o in at] + [0] * (len(lengths) - some)))

    return cut.withColumn("lane", lane).groupBy("lane").applyInArrow(run, schema)
