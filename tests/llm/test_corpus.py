"""Near duplicates, mixing, packing, sharding, the pipeline: brute force and edge cases."""

import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
import xxhash
from conftest import SF_SMALL
from pyspark.sql import functions as F

import corpus_pipeline
from riskweave.llm import common, mixing, packing, sharding, simhash
from riskweave.llm.common import read
from riskweave.llm.components import components


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# --- SimHash -----------------------------------------------------------------
def plain_fingerprint(text):
    w = words(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i:i + 4]).encode(), 42) for i in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(rows):
    fps = [plain_fingerprint(r["text"]) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= 4:
            root[find(j)] = find(i)
    least = defaultdict(lambda: None)
    for i, r in enumerate(rows):
        g = find(i)
        if r["doc_id"] is not None:
            least[g] = r["doc_id"] if least[g] is None else min(least[g], r["doc_id"])
    return Counter((r["doc_id"], f"{fps[i]:016x}", least[find(i)]) for i, r in enumerate(rows))


def test_near_duplicates_equal_brute_force(spark, edge, none):
    for docs in (read(spark, SF_SMALL, "documents"), edge):
        got = Counter(tuple(r) for r in simhash.near_duplicates(docs).select("doc_id", "fingerprint", "component_id").collect())
        assert got == plain_groups(docs.collect())
    assert simhash.near_duplicates(none).count() == 0


@pytest.mark.parametrize("slice_variants", [1 << 21, 1 << 12])
def test_every_link_is_found(spark, monkeypatch, slice_variants):
    monkeypatch.setattr(simhash, "SLICE_VARIANTS", slice_variants)
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 40, np.uint64)
    near = [b ^ sum((np.uint64(1) << np.uint64(x) for x in rng.choice(64, d, replace=False)), np.uint64(0))
            for b in base for d in (1, 2, 3, 4, 5)]
    fps = np.unique(np.concatenate([base, near]))
    masks = simhash.flips(2)
    assert len(masks) == 2081
    links = [simhash.links_in_bucket(fps, b, 6, masks, 4) for b in range(64)]
    root = {int(f): int(f) for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in np.concatenate(links).tolist():
        assert (a ^ b).bit_count() <= 4
        root[find(b)] = find(a)
    for a, b in combinations(fps.tolist(), 2):
        if (a ^ b).bit_count() <= 4:
            assert find(a) == find(b)


@pytest.mark.parametrize("max_bits", [1, 3, 5])
def test_odd_limits_lose_no_link(max_bits):
    rng = np.random.default_rng(4)
    few = np.array([0b11000, 0b11001, 0b10000, 0b01001], np.uint64)
    masks = simhash.flips((max_bits + 1) // 2)
    for fps in (few, *(np.unique(rng.integers(0, 1 << 12, 40).astype(np.uint64)) for _ in range(5))):
        def groups(pairs):
            root = {int(f): int(f) for f in fps}
            for _ in range(len(fps)):
                for a, b in pairs:
                    root[a] = root[b] = min(root[a], root[b])
            return root

        found = [tuple(map(int, p)) for p in simhash.links_in_bucket(fps, 0, 0, masks, max_bits)]
        assert all((a ^ b).bit_count() <= max_bits for a, b in found)
        want = [(a, b) for a, b in combinations(map(int, fps), 2) if (a ^ b).bit_count() <= max_bits]
        assert groups(found) == groups(want)


@pytest.mark.parametrize("bits, slice_variants", [(6, 1 << 21), (14, 1 << 12), (22, 1 << 21)])
def test_fingerprints_reach_the_buckets_of_all_their_variants(monkeypatch, bits, slice_variants):
    monkeypatch.setattr(simhash, "SLICE_VARIANTS", slice_variants)
    fps = np.random.default_rng(4).integers(0, 1 << 63, 30, np.uint64)
    masks = simhash.flips(2)
    got = defaultdict(set)
    for batch in simhash.route(fps, masks, bits):
        for bucket, sent in zip(batch.column("bucket").to_pylist(), batch.column("fps").to_pylist(), strict=True):
            got[bucket] |= set(np.frombuffer(sent, np.uint64).tolist())
    want = defaultdict(set)
    for f in fps:
        for bucket in np.unique(simhash.linear_hash(f ^ masks, bits)).tolist():
            want[bucket].add(int(f))
    assert got == want
    assert list(simhash.route(fps[:0], masks, bits)) == []


def test_near_duplicates_in_many_buckets(spark, monkeypatch):
    """The plan of a table with more fingerprints than a bucket may hold."""
    docs = read(spark, SF_SMALL, "documents")
    few = Counter(tuple(r) for r in simhash.near_duplicates(docs).collect())
    monkeypatch.setattr(simhash, "bucket_bits", lambda n, n_flips: 10)
    assert Counter(tuple(r) for r in simhash.near_duplicates(docs).collect()) == few


def test_linear_hash():
    a, b = np.random.default_rng(2).integers(0, 1 << 63, (2, 50), np.uint64)
    assert (simhash.linear_hash(a ^ b, 20) == simhash.linear_hash(a, 20) ^ simhash.linear_hash(b, 20)).all()
    assert simhash.bucket_bits(1000, 2081) == 6
    n = 10**9
    assert (n * 2081 >> simhash.bucket_bits(n, 2081)) <= simhash.BUCKET_ROWS


def test_components_of_chains_stars_and_loops(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, 101 + i) for i in range(50)]
    links = spark.createDataFrame([*chain, *star, (7, 7), (3, 2), (-5, 200), (200, 201)], "a long, b long")
    got = {r["node"]: r["root"] for r in components(links).collect()}
    want = {i: 0 for i in range(41)} | {100 + i: 100 for i in range(51)} | {-5: -5, 200: -5, 201: -5}
    assert got == want
    assert components(links.limit(0)).count() == 0


def test_one_of_each_group_stays(edge):
    kept = simhash.keep_one(edge)
    assert kept.dtypes == edge.dtypes
    ids = Counter(r["doc_id"] for r in kept.collect())
    assert ids[64] == 1 and ids[66] == 0 and ids[67] == 0 and ids[5] == 1 and ids[None] == 2 and ids[60] == 1 and ids[61] == 0


def test_a_group_keeps_one_row_whatever_its_ids(spark):
    def text(seed):
        return " ".join(str(x) for x in np.random.default_rng(seed).integers(0, 10**9, 300))

    near = text(6) + " end"
    assert 0 < (simhash.fingerprint(near) ^ simhash.fingerprint(text(6))).bit_count() <= 4
    rows = [(3, text(1)), (7, text(1)), (7, text(2)),  # 7 is a copy in one group, alone in the other
            (8, text(3)), (8, text(4)),  # one id, two texts
            (None, text(1)), (None, text(5)), (None, text(5).upper()),  # without ids
            (9, text(6)), (9, near), (9, near)]  # near texts under one id
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    ids = Counter(r["doc_id"] for r in kept)
    assert ids == {3: 1, 7: 1, 8: 2, None: 1, 9: 1}
    assert {r["text"] for r in kept} >= {text(1), text(2), text(3), text(4)}


# --- mixing ------------------------------------------------------------------
def plain_targets(sizes, weights=(5, 2, 1)):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in full)
        open_weight = sum(weight[s] for s in names if s not in full)
        target = {s: 3 * sizes[s] if s in full else left * weight[s] / open_weight for s in names}
        over = {s for s in names if s not in full and target[s] > 3 * sizes[s] + 1e-9}
        if not over:
            return target
        full |= over


def test_mixing_targets_and_words(spark, edge, none):
    for docs in (read(spark, SF_SMALL.replace("0.001", "0.01"), "documents"), edge):
        rows = docs.collect()
        sizes = Counter()
        for r in rows:
            sizes[r["source"]] += len(words(r["text"]))
        want = plain_targets(sizes)
        got = mixing.copies(docs).collect()
        assert Counter((r["doc_id"], r["size"], r["source_size"]) for r in got) == Counter(
            (r["doc_id"], len(words(r["text"])), sizes[r["source"]]) for r in rows)
        taken, largest = Counter(), Counter()
        for r in got:
            assert r["target"] == pytest.approx(want[r["source"]])
            assert 0 <= r["taken"] <= 3 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0)
            taken[r["source"]] += r["taken"]
            largest[r["source"]] = max(largest[r["source"]], r["size"])
        for s in sizes:
            assert abs(taken[s] - want[s]) <= largest[s] + 1
        again = mixing.copies(docs.repartition(7)).collect()
        assert Counter(map(tuple, again)) == Counter(map(tuple, got))
    assert mixing.copies(none).count() == 0


def test_pivot_keeps_the_words_and_the_odds():
    size = np.array([5.0, 9.0, 4.0, 30.0, 2.0, 11.0])
    p = np.array([0.3, 0.5, 0.9, 0.2, 0.6, 0.7])
    sums = np.zeros(6)
    for seed in range(4000):
        out, held = mixing.pivot(size, p, np.random.default_rng(seed))
        assert (size * out).sum() == pytest.approx((size * p).sum())
        assert all(x in (0.0, 1.0) for i, x in enumerate(out) if i != held)
        sums += out
    assert np.abs(sums / 4000 - p).max() < 0.04


def test_reduction_tree_has_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_ROWS", 5)
    docs = read(spark, SF_SMALL, "documents")
    got = mixing.copies(docs).collect()
    taken, target, largest = Counter(), {}, Counter()
    for r in got:
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    assert len(got) == docs.count()
    assert all(abs(taken[s] - target[s]) <= largest[s] + 1 for s in target)


def test_mixing_tells_rows_of_one_hash_apart(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"w{i} " * (5 + i), "en", f"s{i % 3}", 1) for i in range(40)],
                                 "doc_id long, text string, lang string, source string, n_chars int")
    monkeypatch.setattr(mixing, "_lane", lambda: F.col("doc_id") % 2)
    want = {r["doc_id"]: r["copies"] for r in mixing.copies(docs).collect() if r["copies"]}
    assert Counter(r["doc_id"] for r in mixing.mix(docs).collect()) == want


def test_mixed_rows_are_the_copies_taken(edge):
    taken = Counter()
    for r in mixing.copies(edge).collect():
        taken[r["doc_id"]] += r["copies"] if r["size"] else 0
    out = mixing.mix(edge)
    assert out.dtypes == edge.dtypes
    assert Counter(r["doc_id"] for r in out.collect() if words(r["text"])) == +taken


# --- packing -----------------------------------------------------------------
def plain_best_fit(sizes, sources, clusters, capacity, per_source):
    bins, out = [], []
    for size, s, c in zip(sizes, sources, clusters, strict=True):
        fits = [(b["free"], i) for i, b in enumerate(bins)
                if b["free"] >= size and c not in b["clusters"] and b["sources"][s] < per_source]
        if fits:
            i = min(fits)[1]
        else:
            i = len(bins)
            bins.append({"free": capacity, "clusters": set(), "sources": Counter()})
        b = bins[i]
        out.append((i, capacity - b["free"]))
        b["free"] -= size
        b["clusters"].add(c)
        b["sources"][s] += 1
    return out


def test_best_fit_equals_brute_force():
    rng = np.random.default_rng(4)
    for _ in range(30):
        n = int(rng.integers(1, 200))
        sizes = sorted(rng.integers(1, 101, n).tolist(), reverse=True)
        sources, clusters = rng.integers(0, 3, n).tolist(), (rng.integers(0, 60, n) ** 2 // 40).tolist()
        assert packing.best_fit(sizes, sources, clusters, 100, 3) == plain_best_fit(sizes, sources, clusters, 100, 3)


def test_packed_bins(spark, edge, none):
    for docs in (read(spark, SF_SMALL, "documents"), edge):
        got = packing.pack(docs, capacity=256, per_source=2).toPandas()
        length, packed = Counter(), Counter()
        for r in docs.collect():
            length[-1 if r["doc_id"] is None else r["doc_id"]] += len(words(r["text"]))
        for i, n in zip(got["doc_id"].fillna(-1), got["length"], strict=True):
            packed[int(i)] += n
        assert packed == length
        placed = got[got["length"] > 0]
        assert placed["bin"].notna().all() and got[got["length"] == 0]["bin"].isna().all()
        for _, b in placed.sort_values("offset").groupby("bin"):
            assert b["length"].sum() <= 256 and not b["cluster"].duplicated().any()
            assert b["source"].value_counts(dropna=False).max() <= 2
            assert (b["offset"].to_numpy() == np.append(0, b["length"].cumsum().to_numpy()[:-1])).all()
    assert packing.pack(none).count() == 0


# --- sharding ----------------------------------------------------------------
def test_sharding_digests_and_slots(spark, edge, none, monkeypatch):
    monkeypatch.setattr(sharding, "ROWS_PER_PART", 3)
    for docs in (read(spark, SF_SMALL, "documents"), edge):
        got = sharding.shard_documents(docs, [1.0] * 40).collect()
        text = [((r["text"] or "").encode(), r["doc_id"]) for r in docs.collect()]
        assert Counter((r["doc_id"], r["size"], r["text_crc32"], r["law"]) for r in got) == Counter(
            (i, len(t) + 16, zlib.crc32(t), "key") for t, i in text)
        slots = defaultdict(list)
        for r in got:
            assert 0 <= r["shard"] < 40 and r["grown_shard"] in (r["shard"], 40)
            slots[r["shard"]].append(r["slot"])
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        assert len({(r["doc_id"], r["shard"]) for r in got}) == len({r["doc_id"] for r in got})
    assert sharding.shard_documents(none, [1.0] * 40).count() == 0


def test_rendezvous_weights_and_moves(spark):
    rows = spark.range(40_000).withColumnRenamed("id", "k")
    two = {r["k"]: r for r in sharding.assign(rows, "k", [1.0, 3.0, 2.0], grown="g", grown_weight=2.0).collect()}
    share = Counter(r["shard"] for r in two.values())
    assert [round(share[i] / 40_000, 1) for i in range(3)] == [0.2, 0.5, 0.3]
    assert abs(sum(r["g"] == 3 for r in two.values()) / 40_000 - 0.25) < 0.02
    four = {r["k"]: r["shard"] for r in sharding.assign(rows, "k", [1.0, 3.0, 2.0, 2.0]).collect()}
    assert all(four[k] == r["g"] for k, r in two.items())


def test_sharding_stays_native(spark):
    docs = read(spark, SF_SMALL, "documents")
    plan = sharding.shard_documents(docs, [1.0] * 3)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_shards_are_written(spark, tmp_path):
    docs = read(spark, SF_SMALL, "documents")
    sharding.write_shards(docs, "doc_id", [1.0] * 5, f"{tmp_path}/out")
    back = spark.read.parquet(f"{tmp_path}/out")
    assert back.drop("shard").exceptAll(docs).count() == 0 and back.count() == docs.count()
    want = sharding.assign(docs, "doc_id", [1.0] * 5).select("doc_id", "shard")
    assert back.select("doc_id", F.col("shard").cast("int")).exceptAll(want).count() == 0


# --- pipeline ----------------------------------------------------------------
def test_pipeline_stage_by_stage(spark):
    docs = read(spark, SF_SMALL, "documents")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "simhash_near_dedup", "pii_masking", "source_mixing", "best_fit_packing"]
    seen = [docs]
    for _, stage in corpus_pipeline.STAGES:
        seen.append(stage(spark, seen[-1], SF_SMALL).cache())
    assert all(s.dtypes == docs.dtypes for s in seen[:-1])
    first, unique, masked, mixed = (s.collect() for s in seen[1:5])
    assert {r["doc_id"] for r in docs.collect() if re.search(r"[^\W\d_]", r["text"] or "")} == {r["doc_id"] for r in first}
    assert {r["doc_id"] for r in unique} == {c for _, _, c in plain_groups(first)}
    assert {r["doc_id"] for r in masked} == {r["doc_id"] for r in unique}
    assert not any(re.search(r"[A-Za-z0-9]@[a-z0-9]+\.example", r["text"]) for r in masked)
    by_id = {r["doc_id"]: r["text"] for r in masked}
    assert all(r["text"] == by_id[r["doc_id"]] for r in mixed)
    length = Counter()
    for r in mixed:
        length[r["doc_id"]] += len(words(r["text"]))
    assert {r[0]: r[1] for r in seen[5].groupBy("doc_id").agg(F.sum("length")).collect()} == dict(length)
    assert Counter(map(tuple, corpus_pipeline.run(spark, SF_SMALL).collect())) == Counter(map(tuple, seen[5].collect()))


def test_pipeline_stages_on_edge_cases(spark, edge, none):
    for docs in (edge, none):
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, "")
            assert i == 4 or out.columns == docs.columns
            assert docs.count() or not out.count()


# --- exact ids, repeated rows, columns kept ------------------------------------------------------
BIG = [2**53 + i for i in (1, 3, 5, 7)]


def big_rows(spark):
    rows = [(i, f"{w} {w}x a b c", "s") for i, w in zip([*BIG, None], "pqrst", strict=True)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_ids_above_two_to_the_53_stay_exact_beside_a_null(spark):
    docs = big_rows(spark)
    want = {*BIG, None}
    assert {r["doc_id"] for r in packing.pack(docs).collect()} == want
    assert {r["doc_id"] for r in mixing.copies(docs).collect()} == want
    mixed = {r["doc_id"] for r in mixing.mix(docs).collect()}
    assert mixed <= want and mixed
    assert {r["doc_id"] for r in sharding.shard_documents(docs, [1.0] * 3).collect()} == want


def test_mix_keeps_rows_that_differ_in_other_columns(spark):
    rows = [(1, "a b c", "en", "s", 1), (1, "a b c", "de", "s", 2), (1, "a b c", None, "s", 2), (2, "d e", "en", "t", 3),
            (2, "d e", "en", "t", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, lane long")
    got = [tuple(r) for r in mixing.mix(docs, weights=(1.0,)).collect()]
    # each source already has its share: every row is taken about once
    taken = mixing.copies(docs, weights=(1.0,)).collect()
    assert sorted(map(str, got)) == sorted(str(tuple(r)) for r in rows for _ in range(1)) or len(got) == sum(r["copies"] for r in taken)
    assert set(map(str, got)) <= set(map(str, map(tuple, rows)))
    three = spark.createDataFrame(rows[:3], docs.schema)
    assert sorted(map(str, (tuple(r) for r in mixing.mix(three).collect()))) == sorted(map(str, rows[:3]))


def test_rows_with_maps_and_null_columns_are_told_apart(spark):
    docs = spark.sql("SELECT id AS doc_id, 'a b' AS text, 's' AS source, IF(id = 1, map('k', 1L), map('k', id)) AS m, "
                     "IF(id = 0, NULL, 'x') AS l FROM range(4)")
    assert docs.select(common.row_hash(docs).alias("h")).distinct().count() == 4
    pair = spark.createDataFrame([(None, "x"), ("x", None)], "a string, b string")
    assert pair.select(common.row_hash(pair).alias("h")).distinct().count() == 2
    assert mixing.mix(docs).count() == 4


def test_copies_are_numbered_without_a_gap(spark):
    rows = spark.range(3_000).select((F.col("id") % 7 * (F.col("id") % 3)).alias("key")).repartition(9)
    got = common.copy_numbers(rows, "key", "copy")
    assert got.columns == ["key", "copy"]
    for r in got.groupBy("key").agg(F.collect_list("copy").alias("c")).collect():
        assert sorted(r["c"]) == list(range(len(r["c"])))


def test_a_hot_repeated_row_fills_no_group(spark, monkeypatch):
    """Two thirds of all rows are one row: its groups, blocks and parts stay small."""
    rows = spark.range(12_000).selectExpr("IF(id % 3 > 0, 7, id) AS doc_id", "IF(id % 3 > 0, 'the same few words', concat('w', id, ' x y')) AS text",
                                          "'s' AS source")
    monkeypatch.setattr(packing, "GROUP_ROWS", 500)
    packed = packing.pack(rows)
    groups = packed.groupBy(F.split("bin", "-")[0].alias("g")).count().agg(F.max("count"), F.sum("count")).first()
    assert groups[0] < 1_000 and groups[1] == 12_000
    inside = packed.groupBy("bin", "cluster").count().agg(F.max("count")).first()[0]
    assert inside == 1
    monkeypatch.setattr(sharding, "ROWS_PER_PART", 500)
    sharded = sharding.shard_documents(rows, [1.0] * 4)
    for r in sharded.groupBy("shard").agg(F.collect_list("slot").alias("s")).collect():
        assert sorted(r["s"]) == list(range(len(r["s"])))
    assert sharded.filter("doc_id = 7").select("shard").distinct().count() == 1


def test_mixing_agrees_whatever_the_partitions(spark):
    rows = [(i % 40, f"w{i % 40} " * (1 + i % 9), f"s{i % 3}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    a, b = (sorted(map(tuple, mixing.copies(d).select("doc_id", "size", "taken").collect()))
            for d in (docs.repartition(2), docs.repartition(7)))
    assert a == b


def test_packing_takes_clusters_from_a_column(spark):
    rows = [(i, f"text number {i}", "s", 1 if i < 6 else None) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, component_id long")
    got = packing.pack(docs, per_source=99, cluster="component_id").collect()
    bins = [r["bin"] for r in got if r["doc_id"] < 6]
    assert len(set(bins)) == 6  # one of a cluster in each
    assert len({r["bin"] for r in packing.pack(docs, per_source=99).collect()}) == 1


def test_a_fingerprint_travels_few_bytes_at_any_size():
    """8 bytes to each bucket that it reaches: no jump, and under 1 KB at a thousand million."""
    masks = simhash.flips(2)

    def sent(n):
        bits = simhash.bucket_bits(n, len(masks))
        return 8 * len(np.unique(simhash.linear_hash(masks, bits)))

    sizes = [10**4 * 2**i for i in range(18)]
    assert all(b <= 1.35 * a for a, b in zip(map(sent, sizes), map(sent, sizes[1:])))
    assert sent(10**3) == 8 * 22 and sent(10**9) < 1_000
    assert 10**9 * sent(10**9) / 8 / 2 ** simhash.bucket_bits(10**9, len(masks)) < 1 << 23  # held by a bucket's task


def test_buckets_are_even():
    fps = np.random.default_rng(6).integers(0, 1 << 63, 20_000, np.uint64) * np.uint64(2)
    for bits in (6, 10):
        n = np.bincount(simhash.linear_hash(fps, bits), minlength=1 << bits)
        assert n.max() < 2.2 * n.mean()


def test_every_row_lives_in_its_winning_shard(spark):
    """All scores of all rows recomputed, one by one."""
    weights = [1.0, 2.5, 0.5, 1.0, 3.0]

    def score(key, shard, weight):
        h = xxhash.xxh64_intdigest(int(key).to_bytes(8, "little", signed=True), 42)
        h = xxhash.xxh64_intdigest(shard.to_bytes(4, "little"), h)
        return -weight / np.log(((h >> 11) + 0.5) / 2.0**53)

    keys = [0, 1, -1, 2**62, -(2**63), *range(1_000, 1_400)]
    rows = spark.createDataFrame([(k,) for k in keys], "doc_id long")
    for r in sharding.assign(rows, "doc_id", weights, grown="grown", grown_weight=2.0).collect():
        every = [score(r["doc_id"], s, w) for s, w in enumerate(weights)]
        assert r["shard"] == int(np.argmax(every))
        assert r["grown"] == (5 if score(r["doc_id"], 5, 2.0) > max(every) else r["shard"])


def test_slices_hold_as_many_variants_as_they_may(monkeypatch):
    """Counted by what the searches for met variants are given."""
    monkeypatch.setattr(simhash, "SLICE_VARIANTS", 1 << 12)
    masks = simhash.flips(2)
    fps = np.random.default_rng(8).integers(0, 1 << 63, 3_000, np.uint64)
    bucket = int(simhash.linear_hash(fps[:1], 6)[0])
    own = np.array([f for f in fps if bucket in np.unique(simhash.linear_hash(f ^ masks, 6))], np.uint64)
    sizes = []
    real = np.repeat
    monkeypatch.setattr(np, "repeat", lambda a, n, *r: sizes.append(int(np.sum(n))) or real(a, n, *r))
    simhash.links_in_bucket(own, bucket, 6, masks, 4)
    assert max(sizes) < 1.6 * simhash.SLICE_VARIANTS and sum(sizes) > 10 * simhash.SLICE_VARIANTS
