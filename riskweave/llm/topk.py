"""Exact top-k inner product search on a bit-sliced index.

Each vector component is an integer attribute. A block of rows keeps the leading bits
of every attribute as bitmaps (slices), one bit of each row in each. A query's score
is a weighted sum of attributes: its quantised weights add the slices with bitmap
full adders, and the sums are bitmaps again. The k-th best sum is found from the most
significant slice downward, and so are all rows that quantisation may have put below
it, by an error bound that holds for every row. These boundary rows are resolved
exactly, by integer products.

Queries and rows meet in cells of a grid, never row by row: a block of queries and a stripe
of rows. The stripe's task takes its rows block by block, those with the longest vectors
first, and carries each query's k-th best score on: it is a floor for the slices of the
next block, and a block whose longest vector can't reach it (Cauchy-Schwarz) is passed
over. Stripes know each other through such floors as well: a first 256th of them is
searched, then a 16th, then the rest, each pass with the k-th best scores of those before.

Defined cases: null vectors, vectors with a null or non-finite component, and empty
ones take no part; vectors meet those of their own length; a null vec_id is no query
and sorts after the others among ties; of repeated rows each is a candidate, and a
query's own row alone is left out; no rows, no result; very long vectors are held by a
task as many at a time as a stripe has rows; further columns are ignored.
Sums must fit 64 bits, as the integer product itself must.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, longs

SCALE = 1024
ROW_BITS = 7  # leading bits of an attribute that are sliced
WEIGHT_BITS = 7  # leading bits of a query's weight
CELL_ROWS = 8_192  # rows of a block
STRIPE_BLOCKS = 16  # blocks of a stripe
CELL_QUERIES = 1_024
SHARES = (256, 16, 1)  # of the stripes, searched up to each pass
CHUNK = 64  # queries whose bitmaps are in work at a time


def _add(sums: list[list[np.ndarray]], place: int, bitmap: np.ndarray) -> None:
    """Add a bitmap of weight 2^place: three of a weight become a sum and a carry."""
    while True:
        while len(sums) <= place:
            sums.append([])
        if len(sums[place]) < 2:
            sums[place].append(bitmap)
            return
        a, b = sums[place]
        either = a ^ b
        carry = (a & b) | (either & bitmap)
        sums[place] = [either ^ bitmap]
        place, bitmap = place + 1, carry


def _finish(sums: list[list[np.ndarray]], shape: tuple[int, int]) -> list[np.ndarray]:
    """One bitmap for each bit of the sums, least significant first."""
    out, carry = [], None
    for place in range(len(sums) + 1):
        terms = (sums[place] if place < len(sums) else []) + ([carry] if carry is not None else [])
        if len(terms) == 3:
            a, b, c = terms
            either = a ^ b
            out.append(either ^ c)
            carry = (a & b) | (either & c)
        elif len(terms) == 2:
            out.append(terms[0] ^ terms[1])
            carry = terms[0] & terms[1]
        else:
            out.append(terms[0] if terms else np.zeros(shape, np.uint64))
            carry = None
    return out


def _count(bitmaps: np.ndarray) -> np.ndarray:
    return np.bitwise_count(bitmaps).sum(axis=1, dtype=np.int64)


class BitSlices:
    """Slices of a block of integer vectors (rows x dimensions)."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        self.n = len(vectors)
        self.low = vectors.min(axis=0)
        spread = int((vectors.max(axis=0) - self.low).max())
        self.shift = max(0, spread.bit_length() - ROW_BITS)
        leading = (vectors - self.low) >> self.shift
        self.top = (1 << ROW_BITS) - 1
        words = -(-self.n // 64)
        bits = np.zeros((vectors.shape[1], ROW_BITS, words * 64), np.uint8)
        for b in range(ROW_BITS):
            bits[:, b, :self.n] = (leading.T >> b) & 1
        self.slices = np.packbits(bits, axis=2, bitorder="little").view(np.uint64)
        rows = np.zeros(words * 64, np.uint8)
        rows[:self.n] = 1
        self.rows = np.packbits(rows, bitorder="little").view(np.uint64)

    def possible(self, queries: np.ndarray, k: int, floors: np.ndarray | None = None) -> np.ndarray:
        """Bitmaps (queries x words) that hold, for each query, at least its k best rows, of those
        that reach its floor if it has one."""
        every = np.broadcast_to(self.rows, (len(queries), len(self.rows)))
        if self.n <= k:
            return every.copy()
        size = np.abs(queries)
        cut = max(0, int(size.max()).bit_length() - WEIGHT_BITS)
        weight, rest = size >> cut, size & ((1 << cut) - 1)
        negative = np.where(queries < 0, ~np.uint64(0), np.uint64(0))
        sums: list[list[np.ndarray]] = []
        for j in range(queries.shape[1]):
            masks = [(i, np.where(weight[:, j] >> i & 1, ~np.uint64(0), np.uint64(0))[:, None])
                     for i in range(WEIGHT_BITS) if (weight[:, j] >> i & 1).any()]
            for b in range(ROW_BITS):
                # a negative weight adds the complement, which differs by a constant
                own = self.slices[j, b][None, :] ^ negative[:, j][:, None]
                for i, mask in masks:
                    _add(sums, b + i, own & mask)
        slices = _finish(sums, every.shape)
        # from the most significant slice downward: the k-th largest sum
        sure = np.zeros_like(every)
        equal = every.copy()
        kth = np.zeros(len(queries), np.int64)
        for place in range(len(slices) - 1, -1, -1):
            ones = equal & slices[place]
            enough = _count(sure) + _count(ones) >= k
            kth += enough.astype(np.int64) << place
            pick = enough[:, None]
            sure = np.where(pick, sure, sure | ones)
            equal = np.where(pick, ones, equal & ~slices[place])
        # a score lies within `slack` of its sum: dropped bits of weights and attributes
        dropped = (1 << self.shift) - 1
        slack = (rest.sum(axis=1) * self.top << self.shift) + size.sum(axis=1) * dropped
        least = np.maximum(0, kth - -(-slack >> (self.shift + cut)))
        if floors is not None:
            # a score is its sum, scaled, and this constant, give or take the slack
            fixed = queries @ self.low - ((weight * (queries < 0)).sum(axis=1) * self.top << (self.shift + cut))
            reach = [max(0, int(f) - int(e) - int(c)) >> (self.shift + cut) for f, e, c in zip(floors, slack, fixed, strict=True)]
            most = (1 << len(slices)) - 1
            least = np.maximum(least, np.array([min(r, most) for r in reach], np.int64))
        # rows whose sum is at least that, again slice by slice
        above = np.zeros_like(every)
        equal = every.copy()
        for place in range(len(slices) - 1, -1, -1):
            bit = (least >> place & 1).astype(bool)[:, None]
            above = np.where(bit, above, above | (equal & slices[place]))
            equal = np.where(bit, equal & slices[place], equal & ~slices[place])
        return above | equal

    def best(self, queries: np.ndarray, k: int, floors: np.ndarray | None = None):
        """For each query, (row numbers, scores) of all rows that may be among its k best."""
        for at in range(0, len(queries), CHUNK):
            chunk = queries[at:at + CHUNK]
            found = self.possible(chunk, k, None if floors is None else floors[at:at + CHUNK])
            for query, bitmap in zip(chunk, found, strict=True):
                rows = np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))
                yield rows, self.vectors[rows] @ query


def quantised(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """row, vec_id, e (array of floor(1024 * x)) of the vectors that take part."""
    e = F.col(embedding)
    fit = e.isNotNull() & (F.size(e) > 0) & F.forall(
        e, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    ints = F.transform(e, lambda x: F.floor(F.lit(SCALE) * x.cast("double")).cast("long"))
    return vectors.filter(fit).select(F.col(vec_id).cast("long").alias("vec_id"), ints.alias("e"))


def stripe_best(have: np.ndarray, order_id: np.ndarray, row: np.ndarray, ask: np.ndarray, own: np.ndarray,
                floors: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query (a row of ``ask``), (places, scores) of its k best rows of ``have`` that
    reach its floor, ties to the smaller ``order_id``, its ``own`` row left out."""
    longest = np.argsort(-np.linalg.norm(have.astype(np.float64), axis=1), kind="stable")
    length = np.linalg.norm(ask.astype(np.float64), axis=1)
    best = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(ask)
    floors = floors.copy()
    for at in range(0, len(have), CELL_ROWS):
        block = longest[at:at + CELL_ROWS]
        reach = length * np.linalg.norm(have[block[0]].astype(np.float64)) * (1 + 1e-9)
        asking = np.flatnonzero(reach >= floors)
        if not len(asking):
            break  # the blocks to come are shorter still
        # one more than k: the query's own row may be among them
        found = BitSlices(have[block]).best(ask[asking], k + 1, floors[asking])
        for i, (rows, score) in zip(asking, found, strict=True):
            place = block[rows]
            good = (row[place] != own[i]) & (score >= floors[i])
            place, score = np.append(best[i][0], place[good]), np.append(best[i][1], score[good])
            top = np.lexsort((order_id[place], -score))[:k]
            best[i] = place[top], score[top]
            if len(top) == k:
                floors[i] = max(floors[i], score[top[-1]])
    return best


def search(vectors: DataFrame, k: int = 10, every: int = 100) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows of each row whose vec_id is
    divisible by ``every``."""
    rows = checkpointed(quantised(vectors)).withColumn("row", F.monotonically_increasing_id())
    is_query = F.coalesce(F.col("vec_id") % every == 0, F.lit(False))
    n, m = rows.agg(F.count(F.lit(1)), F.count_if(is_query)).first()
    stripes, query_cells = max(1, -(-n // (CELL_ROWS * STRIPE_BLOCKS))), max(1, -(-m // CELL_QUERIES))
    dim = F.size("e").alias("dim")
    stripe = F.pmod(F.xxhash64("row"), F.lit(stripes)).cast("int")
    candidates = rows.select("row", "vec_id", "e", dim, stripe.alias("r"),
                             F.explode(F.sequence(F.lit(0), F.lit(query_cells - 1))).alias("q"))
    queries = rows.filter(is_query).select("row", "vec_id", "e", dim, F.pmod("row", F.lit(query_cells)).cast("int").alias("q"))
    none = np.iinfo(np.int64).min

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        def read(table):
            e = table.column("e").combine_chunks()
            values = e.flatten().to_numpy(zero_copy_only=False)
            return table.column("row").to_numpy(), values.reshape(table.num_rows, -1)

        out = {"query_row": [], "query_id": [], "vec_id": [], "score": []}
        if left.num_rows and right.num_rows:
            row, have = read(left)
            own, ask = read(right)
            ids = left.column("vec_id").to_pylist()
            last = np.iinfo(np.int64).max
            order_id = np.array([last if i is None else i for i in ids], np.int64)
            names = right.column("vec_id").to_pylist()
            floors = right.column("floor").fill_null(none).to_numpy()
            for i, (place, score) in enumerate(stripe_best(have, order_id, row, ask, own, floors, k)):
                out["query_row"] += [int(own[i])] * len(place)
                out["query_id"] += [names[i]] * len(place)
                out["vec_id"] += [ids[x] for x in place]
                out["score"] += score.tolist()
        return pa.table({name: longs(x) for name, x in out.items()})

    order = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    keys = ("dim", "r", "q")
    found = None
    for i, share in enumerate(SHARES):
        if i and not any(r % share == 0 and all(r % s for s in SHARES[:i]) for r in range(min(stripes, SHARES[0]))):
            continue  # too few stripes for this pass
        new = F.col("r") % share == 0
        for before in SHARES[:i]:
            new &= F.col("r") % before != 0
        asked = queries.withColumn("floor", F.lit(None).cast("long"))
        if found is not None:
            kth = found.filter(F.col("rank") == k).select(F.col("query_row").alias("row"), F.col("score").alias("floor"))
            asked = queries.join(kth, "row", "left")
            asked = asked.select(*[F.col(c).alias(c) for c in asked.columns])  # columns of its own for the cogroup
        cells = asked.withColumn("r", F.explode(F.sequence(F.lit(0), F.lit(stripes - 1)))).filter(new)
        part = candidates.filter(new).groupBy(*keys).cogroup(cells.groupBy(*keys)).applyInArrow(
            meet, "query_row long, query_id long, vec_id long, score long")
        part = part if found is None else part.unionByName(found.drop("rank"))
        found = part.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        if share > 1 and stripes > 1:
            found = checkpointed(found)
    return found.select("query_id", "rank", "vec_id", "score")
