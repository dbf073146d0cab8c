"""Centroid clustering with equal-average equal-variance nearest neighbour search.

Vectors become integers, and all that follows is exact integer arithmetic. The first
centroids are the vectors whose hashed ids sort first. Each round assigns every vector to
its nearest centroid and moves the centroids to the floored means; then all vectors are
assigned once more.

A vector's search starts in the list of centroids, sorted by their component sum, at its
own sum, and walks outward, the nearer side first. With k components, sums S and squared
deviation norms V (k V = k Q - S^2, Q the sum of squares), a distance is at least
(Sx - Sc)^2 / k + (sqrt Vx - sqrt Vc)^2. The first term alone ends the walk on a side
(mean inequality); both reject a centroid (deviation inequality); what is left is
computed exactly. All vectors of a batch walk in step.

Every round is one scan of the vectors, in which a task adds up one row for each centroid.
The driver holds the ``k`` centroids only. The vectors are read again each round instead of
being copied, so their table must give the same rows each time, as Parquet does.

Defined cases: null vectors, those of another length, and those with a null or non-finite
component take no part; a null vec_id is a row like others, but becomes a first centroid
only after all that have an id; repeated ids sort by their vectors, and repeated rows count
each; equal distances go to the smaller centroid number; fewer vectors than ``k`` give
fewer centroids; an empty table gives an empty table; further columns are ignored. Scaled
components beyond +-2^27 count as that, so that any distance fits 64 bits; an inertia
beyond 64 bits is null.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, longs, record

DIMS = 64
SCALE = 64
K = 16
ROUNDS = 3
LIMIT = 1 << 27


class Centroids:
    """Centroids in order of their component sums, for the outward search."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = np.asarray(centroids, np.int64)
        sums = self.centroids.sum(axis=1)
        self.number = np.lexsort((np.arange(len(sums)), sums))
        self.vectors = self.centroids[self.number]
        self.sums = sums[self.number]
        self.deviation = _deviation(self.vectors, self.sums)
        self.computed = 0  # distances worked out in full, for the tests

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(centroid number, squared distance) of each row of integers."""
        n, dims = x.shape
        k = len(self.sums)
        best = np.full(n, k, np.int64)
        least = np.full(n, np.iinfo(np.int64).max)
        if not n or not k:
            return best, least
        sums = x.sum(axis=1)
        deviation = _deviation(x, sums)
        up = np.searchsorted(self.sums, sums)
        down = up - 1
        rows = np.arange(n)
        while len(rows):
            # the side whose next centroid has the nearer sum
            own = sums[rows]
            gap_up = np.where(up[rows] < k, np.abs(self.sums[np.minimum(up[rows], k - 1)] - own), -1)
            gap_down = np.where(down[rows] >= 0, np.abs(self.sums[np.maximum(down[rows], 0)] - own), -1)
            rise = (gap_down < 0) | ((gap_up >= 0) & (gap_up <= gap_down))
            gap = np.where(rise, gap_up, gap_down)
            # the other side is no nearer, so this ends the whole walk: gap^2 / dims > least
            going = (gap >= 0) & ~_beyond(gap, dims, least[rows])
            rows, rise, gap = rows[going], rise[going], gap[going]
            at = np.where(rise, up[rows], down[rows])
            up[rows[rise]] += 1
            down[rows[~rise]] -= 1
            # floating point here, so a margin: what it lets through is computed exactly
            bound = gap.astype(np.float64) ** 2 / dims + (deviation[rows] - self.deviation[at]) ** 2
            some = bound <= least[rows] * (1 + 1e-9) + 1e-3
            some, at = rows[some], at[some]
            self.computed += len(some)
            far = ((x[some] - self.vectors[at]) ** 2).sum(axis=1)
            number = self.number[at]
            wins = (far < least[some]) | ((far == least[some]) & (number < best[some]))
            best[some[wins]], least[some[wins]] = number[wins], far[wins]
        return best, least


def _beyond(gap: np.ndarray, dims: int, least: np.ndarray) -> np.ndarray:
    """gap^2 > dims * least, in integers that can't overflow: gap > floor(sqrt(dims * least)),
    told from below by floating point with a margin."""
    return gap > np.sqrt(dims * least.astype(np.float64)) * (1 + 1e-9) + 1


def _deviation(x: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Norm of the differences from the vector's own mean."""
    mean = sums / x.shape[1]
    return np.sqrt(((x - mean[:, None]) ** 2).sum(axis=1))


def integers(column: pa.Array, dims: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """(row numbers, floor(scale * component)) of the vectors that take part."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    length = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(length == dims)
    if not len(rows):
        return rows, np.zeros((0, dims), np.int64)
    flat = column.take(pa.array(rows)).flatten()
    values = flat.cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, dims)  # null becomes NaN
    fit = np.isfinite(values).all(axis=1)
    with np.errstate(over="ignore"):
        scaled = np.floor(np.clip(scale * values[fit], -LIMIT, LIMIT))
    return rows[fit], scaled.astype(np.int64)


def first_centroids(vectors: DataFrame, k: int, dims: int, scale: int, vec_id: str, embedding: str,
                    salt: str) -> np.ndarray:
    """The k vectors with the smallest sha256 of salt and id, by a top-k of every task."""
    e = F.col(embedding)
    fit = (F.size(e) == dims) & F.forall(
        e, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    hashed = F.sha2(F.concat(F.lit(salt), F.col(vec_id).cast("string")).cast("binary"), 256)
    rows = (vectors.filter(fit).select(hashed.alias("h"), e.alias("e"))
            .orderBy(F.asc_nulls_last("h"), "e").limit(k).toArrow())  # k rows
    return integers(rows["e"], dims, scale)[1]


def moved(vectors: DataFrame, centroids: np.ndarray, scale: int, embedding: str) -> np.ndarray:
    """The floored means of each centroid's vectors; a centroid without vectors stays."""
    k, dims = centroids.shape
    names = [f"s{i}" for i in range(dims)]

    def add(batches):
        search = Centroids(centroids)
        n, total = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for batch in batches:
            _, x = integers(batch.column(0), dims, scale)
            number, _ = search.nearest(x)
            n += np.bincount(number, minlength=k)
            for c in np.unique(number):
                total[c] += x[number == c].sum(axis=0)
        some = np.flatnonzero(n)
        yield record(cluster=longs(some), n=longs(n[some]), **{s: longs(total[some, i]) for i, s in enumerate(names)})

    sums = (vectors.select(embedding).mapInArrow(add, ", ".join(f"{c} long" for c in ["cluster", "n", *names]))
            .groupBy("cluster").agg(F.sum("n").alias("n"), *[F.sum(s).alias(s) for s in names]))
    out = centroids.copy()
    for r in sums.collect():  # k rows at most
        out[r["cluster"]] = [r[s] // r["n"] for s in names]
    return out


def cluster(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE,
            vec_id: str = "vec_id", embedding: str = "embedding", salt: str = "1:") -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every
    vector that takes part."""
    centroids = first_centroids(vectors, k, dims, scale, vec_id, embedding, salt)
    for _ in range(rounds if len(centroids) else 0):
        centroids = moved(vectors, centroids, scale, embedding)

    def assign(batches):
        search = Centroids(centroids)
        for batch in batches:
            rows, x = integers(batch.column(1), dims, scale)
            number, far = search.nearest(x)
            yield record(vec_id=batch.column(0).take(pa.array(rows)), cluster=pa.array(number, pa.int32()), distance=longs(far))

    kind = dict(vectors.dtypes)[vec_id]
    found = checkpointed(vectors.select(F.col(vec_id).alias("vec_id"), embedding)
                         .mapInArrow(assign, f"vec_id {kind}, cluster int, distance long"))
    wide = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia")).collect()  # k rows
    whole = sum(int(r["inertia"]) for r in wide)
    rows = [(r["cluster"], _long(r["inertia"]), _long(whole), _sha256(centroids[r["cluster"]])) for r in wide]
    about = vectors.sparkSession.createDataFrame(
        rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(about), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _long(value) -> int | None:
    return int(value) if int(value) < 1 << 63 else None


def _sha256(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(int(c)) for c in centroid).encode()).hexdigest()


def oracle(k: int = K, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE) -> str:
    """The same result as SQL over ``embeddings``: the rounds written out."""
    parts = [f"""
v AS (SELECT row_number() OVER () AS r, vec_id, sha256('1:' || vec_id) AS h,
             list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS e
      FROM embeddings
      WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS (SELECT CAST(row_number() OVER (ORDER BY h NULLS LAST, e) - 1 AS INTEGER) AS cluster, e AS c
       FROM v QUALIFY cluster < {k})"""]
    for i in range(rounds + 1):
        parts.append(f"""
a{i} AS (SELECT r, vec_id, e, cluster,
                CAST(list_sum(list_transform(list_zip(e, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS distance
         FROM v CROSS JOIN c{i}
         QUALIFY row_number() OVER (PARTITION BY r ORDER BY distance, cluster) = 1)""")
        if i < rounds:
            parts.append(f"""
m{i} AS (SELECT cluster, list(CAST(f AS BIGINT) ORDER BY j) AS c FROM (
           SELECT cluster, j, CAST(sum(x) AS BIGINT) AS s, count(*) AS n, (s - ((s % n) + n) % n) // n AS f
           FROM (SELECT cluster, unnest(e) AS x, unnest(range({dims})) AS j FROM a{i}) GROUP BY cluster, j) GROUP BY cluster),
c{i + 1} AS (SELECT cluster, coalesce(m{i}.c, c{i}.c) AS c FROM c{i} LEFT JOIN m{i} USING (cluster))""")
    return f"""WITH {','.join(parts)}
SELECT vec_id, cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} USING (cluster)"""
