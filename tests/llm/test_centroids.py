"""Centroid clustering against a plain version, and its edge cases."""

import hashlib

import numpy as np
import pytest

from riskweave.llm import centroids as C

SCHEMA = "vec_id long, embedding array<float>, cluster int, distance string"


def plain(rows, k, rounds, dims, scale):
    kept = [(i, [int(np.floor(scale * float(np.float32(x)))) for x in e]) for i, e in rows
            if e is not None and len(e) == dims and all(x is not None and np.isfinite(x) for x in e)]
    def key(r):
        return (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1])
    own = [e for _, e in sorted(kept, key=key)[:k]]
    def nearest(e):
        return min((sum((a - b) ** 2 for a, b in zip(e, c)), n) for n, c in enumerate(own))
    for _ in range(rounds):
        of = [nearest(e)[1] for _, e in kept]
        own = [[sum(col) // len(col) for col in zip(*m)] if (m := [e for (_, e), o in zip(kept, of) if o == n]) else c
               for n, c in enumerate(own)]
    found = [(i, *nearest(e)[::-1]) for i, e in kept]
    inertia = {n: sum(f[2] for f in found if f[1] == n) for n in range(len(own))}
    return sorted(((i, n, d, inertia[n], sum(inertia.values()), hashlib.sha256(",".join(map(str, own[n])).encode()).hexdigest())
                   for i, n, d in found), key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia",
                                               "centroid_sha256").collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(i, e, 9, "x") for i, e in rows], SCHEMA).repartition(3)


def test_equals_the_plain_version_with_edge_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=4).astype(np.float32).tolist()) for i in range(150)]
    rows += [(7, rows[7][1]), (7, rows[7][1]), (500, [0.0] * 4), (501, [0.0] * 4), (None, rows[3][1]), (None, None),
             (502, None), (503, []), (504, [1.0, None, 0.0, 0.0]), (505, [float("nan")] * 4), (506, [1.0] * 3),
             (507, [float("inf"), 0.0, 0.0, 0.0]), (508, [-0.5] * 4), (509, [3.0e5, 0.0, 0.0, 0.0])]
    for k, rounds in ((5, 3), (1, 2), (40, 1)):
        got = rows_of(C.cluster(frame(spark, rows), k=k, rounds=rounds, dims=4, scale=8))
        assert got == plain(rows, k, rounds, 4, 8)


def test_few_rows_and_none(spark):
    rows = [(1, [0.5] * 4), (2, [0.25] * 4)]
    assert rows_of(C.cluster(frame(spark, rows), k=5, dims=4)) == plain(rows, 5, 3, 4, 64)
    assert rows_of(C.cluster(frame(spark, []), dims=4)) == []


def test_huge_components_count_as_the_limit(spark):
    got = C.cluster(frame(spark, [(1, [3e38] * 4), (2, [-3e38] * 4), (3, [0.0] * 4)]), k=1, rounds=0, dims=4).collect()
    assert {r["distance"] for r in got} <= {0, 4 * C.LIMIT**2, 4 * (2 * C.LIMIT) ** 2}


@pytest.mark.parametrize("spread", [1, 30, 3000])
def test_search_is_exact_and_rejects(spread):
    rng = np.random.default_rng(spread)
    own = rng.integers(-spread, spread + 1, (24, 16)) + 20 * rng.integers(-spread, spread + 1, (24, 1))
    own = np.concatenate([own, own[:3]])  # ties go to the smaller number
    x = np.concatenate([rng.integers(-spread, spread + 1, (300, 16)) + 20 * rng.integers(-spread, spread + 1, (300, 1)), own])
    search = C.Centroids(own)
    number, far = search.nearest(x)
    every = ((x[:, None, :] - own[None]) ** 2).sum(axis=2)
    assert (number == every.argmin(axis=1)).all() and (far == every.min(axis=1)).all()
    assert search.computed < 0.5 * every.size  # both inequalities reject most of them
