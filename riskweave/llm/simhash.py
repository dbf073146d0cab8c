"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two 64-bit fingerprints differ in at most 4 bits exactly if some value lies within
2 bits of both. So every distinct fingerprint emits its 2,081 variants (itself and
all flips of one or two bits), variants are shuffled, and fingerprints that meet in
a variant are linked. A link's bit distance is verified.

Emitting 2,081 rows a fingerprint would shuffle far more bytes than the texts have.
So a variant's bucket is a *linear* hash of its bits: they are dealt into groups, and the
bucket number has the parity of each group. The bucket of ``fp ^ flips`` is ``bucket(fp) ^
bucket(flips)``, which tells for every fingerprint which buckets hold variants of it: with
s groups, 1 + s + s (s - 1) / 2 of the 2^s at a radius of 2 (22 of 64, 121 of 32,768). The fingerprint travels to
each of those once, deduplicated, and the bucket's task expands exactly its own
variants, slice by slice, in bounded memory. Every variant is still made and met in
one place; only its bytes on the wire are shared.

Fingerprints that meet in a variant are all within 4 bits of each other, so each is
linked to the smallest one only: a star joins the same rows as all pairs. (For an odd
limit the radius is rounded up, and the centre is one that is nearer than that.)

Defined cases: a null or empty text has fingerprint zero, linked like any other; a
text under four words is one shingle; a very long text is hashed whole, by its task alone;
ties of a bit (set in just half of the shingles) are 0; repeated rows share a fingerprint; a row
without doc_id takes part, and its group is named by the smallest id there is (null
if none); an empty table gives an empty table; further input columns are ignored.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, longs, map_batches, record, texts
from .components import components

SHINGLE = 4
MAX_BITS = 4
SEED = 42
BITS = 64

MIN_BUCKET_BITS = 6
#: Variants that a bucket's task makes in all, and those that it holds and sorts at a time.
BUCKET_ROWS = 1 << 26
SLICE_VARIANTS = 1 << 20

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash: a bit is set if over half of the shingles' XXH64 have it."""
    words = text.encode("utf-8").translate(_LOWER).split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    # A-Z only: translate() on UTF-8 leaves every other character as it is
    hashes = np.fromiter((xxhash.xxh64_intdigest(b" ".join(words[i:i + shingle]), SEED) for i in range(n)),
                         np.uint64, n)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, 1 << 16):
        ones += np.unpackbits(hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8),
                              axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) with the fingerprint as a signed long."""
    kind = dict(docs.dtypes)["doc_id"]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = np.array([fingerprint(t, shingle) for t in texts(batch)], np.uint64)
        return record(doc_id=batch.column("doc_id"), fp=longs(found.view(np.int64)))

    return map_batches(docs.select("doc_id", "text"), run, f"doc_id {kind}, fp long")


def flips(radius: int) -> np.ndarray:
    """Every 64-bit mask with at most ``radius`` bits set."""
    masks = ring = {0}
    for _ in range(radius):
        ring = {m | 1 << b for m in ring for b in range(BITS) if not m >> b & 1}
        masks = masks | ring
    return np.array(sorted(masks), np.uint64)


@functools.cache
def _codes(groups: int) -> np.ndarray:
    """Linear hash by byte: codes[i, x] is the xor of the codes of byte i's set bits. Of
    a code's low ``groups`` bits just one is set, that of the bit's group; the 32 bits above
    are drawn, and cut a bucket into slices."""
    bit = np.random.default_rng(2024).integers(1, 1 << 32, BITS, np.uint64) << np.uint64(groups)
    if groups:
        bit |= np.uint64(1) << np.arange(BITS, dtype=np.uint64) % np.uint64(groups)
    out = np.zeros((8, 256), np.uint64)
    for i in range(8):
        for x in range(256):
            out[i, x] = np.bitwise_xor.reduce(bit[[8 * i + b for b in range(8) if x >> b & 1]], initial=np.uint64(0))
    return out


def linear_hash(values: np.ndarray, bits: int, more: int = 0) -> np.ndarray:
    """``bits + more`` bits of each value, the parities of ``bits`` groups lowest;
    hash(a ^ b) = hash(a) ^ hash(b)."""
    by_byte = np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(-1, 8)
    codes = _codes(bits)
    out = np.zeros(len(by_byte), np.uint64)
    for i in range(8):
        out ^= codes[i, by_byte[:, i]]
    return (out & np.uint64((1 << bits + more) - 1)).astype(np.int64)


def bucket_bits(n: int, n_flips: int) -> int:
    """Bits of the bucket number for n fingerprints, so that a bucket's task makes no more
    than ``BUCKET_ROWS`` variants."""
    bits = MIN_BUCKET_BITS
    while n * n_flips >> bits > BUCKET_ROWS and bits < 30:
        bits += 1
    return bits


def route(fps: np.ndarray, masks: np.ndarray, bits: int):
    """Batches (bucket, fps): for each bucket that holds variants of some of ``fps``,
    those fingerprints, 8 bytes each. Only buckets that are reached are looked at,
    however many there are, and about ``SLICE_VARIANTS`` destinations at a time."""
    reach = np.unique(linear_hash(masks, bits))  # what flips add to a bucket number
    step = max(1, SLICE_VARIANTS // len(reach))
    for at in range(0, len(fps), step):
        own = fps[at:at + step]
        to = (linear_hash(own, bits)[:, None] ^ reach).ravel()
        order = np.argsort(to, kind="stable")
        to = to[order]
        first = np.flatnonzero(np.append(True, to[1:] != to[:-1]))
        ends = np.append(first, len(to)).astype(np.int32) * 8
        sent = pa.py_buffer(own[order // len(reach)].tobytes())
        yield record(bucket=pa.array(to[first], pa.int32()),
                     fps=pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(ends.tobytes()), sent]))


def links_in_bucket(fps: np.ndarray, bucket: int, bits: int, masks: np.ndarray, max_bits: int) -> np.ndarray:
    """Links (centre, other), n x 2, of the fingerprints that meet in a variant of
    this bucket. Variants are made, sorted and compared a slice at a time: a slice
    is a further part of the linear hash."""
    fps = np.unique(fps)
    # how many variants there are: the flips that lead from each fingerprint into this bucket
    into, wanted = np.sort(linear_hash(masks, bits)), linear_hash(fps, bits) ^ bucket
    here = int((np.searchsorted(into, wanted, side="right") - np.searchsorted(into, wanted)).sum())
    more = 0
    while here >> more > SLICE_VARIANTS and more < 30:
        more += 1
    of_mask = linear_hash(masks, bits, more)
    masks = masks[np.argsort(of_mask, kind="stable")]
    of_mask = np.sort(of_mask)
    of_fp = linear_hash(fps, bits, more)
    found = []
    for part in range(1 << more):
        wanted = of_fp ^ (part << bits | bucket)  # the hash of the flips that lead into this slice
        start = np.searchsorted(of_mask, wanted)
        count = np.searchsorted(of_mask, wanted, side="right") - start
        owner = np.repeat(np.arange(len(fps)), count)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        variant = fps[owner] ^ masks[np.repeat(start, count) + nth]
        in_order = np.sort(variant)
        shared = np.unique(in_order[1:][in_order[1:] == in_order[:-1]])
        if not len(shared):
            continue
        at = np.searchsorted(shared, variant)
        met = np.flatnonzero(np.append(shared, 0)[at] == variant)
        met = met[at[met] < len(shared)]
        group, owner = at[met], owner[met]
        # for an odd max_bits two members at the full radius may be too far apart; with a nearer one none is
        far = np.bitwise_count(variant[met] ^ fps[owner]) > max_bits // 2
        order = np.lexsort((owner, far, group))  # the first of a group is its smallest near member
        group, owner, far = group[order], owner[order], far[order]
        first = np.append(True, group[1:] != group[:-1])
        at = np.flatnonzero(first)[np.cumsum(first) - 1]
        linked = ~first & ~far[at]
        found.append(np.unique(np.stack([owner[at][linked], owner[linked]], axis=1), axis=0))
    if not found:
        return np.zeros((0, 2), np.uint64)
    pairs = fps[np.unique(np.concatenate(found), axis=0)]
    return pairs[np.bitwise_count(pairs[:, 0] ^ pairs[:, 1]) <= max_bits]


def link_fingerprints(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (a, b) among the distinct fingerprints ``fps(fp)`` that join all that
    are within ``max_bits`` bits, through chains."""
    masks = flips((max_bits + 1) // 2)
    bits = bucket_bits(fps.count(), len(masks))

    def send(batches):
        for batch in batches:
            yield from route(batch.column("fp").to_numpy().view(np.uint64), masks, bits)

    def expand(key, table):
        own = np.frombuffer(b"".join(table.column("fps").to_pylist()), np.uint64)
        pairs = links_in_bucket(own, key[0].as_py(), bits, masks, max_bits).view(np.int64)
        return pa.table({"a": longs(pairs[:, 0]), "b": longs(pairs[:, 1])})

    routed = fps.select("fp").mapInArrow(send, "bucket int, fps binary")
    return routed.groupBy("bucket").applyInArrow(expand, "a long, b long").distinct()


def _grouped(rows: DataFrame, max_bits: int) -> DataFrame:
    """``rows(doc_id, fp)`` with ``least``, the smallest doc_id of the row's group."""
    groups = checkpointed(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(link_fingerprints(groups, max_bits)).withColumnRenamed("node", "fp")
    named = groups.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    # groups and their roots are one row for each distinct fingerprint
    least = checkpointed(named.groupBy("root").agg(F.min("least").alias("least")))
    of_fp = checkpointed(named.select("fp", "root").join(least, "root").select("fp", "least"))
    return rows.join(of_fp, "fp")  # a hot fingerprint is split by AQE's skew join


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row."""
    rows = _grouped(checkpointed(fingerprints(docs, shingle)), max_bits)
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                       F.col("least").alias("component_id"))


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` but for the copies: each group keeps one row, that of the
    smallest doc_id (a row without id only if none has one), then of the smallest
    hash. Only a row with neither id nor text always stays, once."""
    # a row is known by two hashes: an id may repeat with other texts, or be missing
    some = F.col("doc_id").isNotNull() | F.col("text").isNotNull()
    a = F.when(some, F.xxhash64("doc_id", "text"))
    b = F.when(some, F.xxhash64(F.lit(1), "doc_id", "text"))
    key = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), a.alias("a"), b.alias("b"))
    rows = _grouped(checkpointed(fingerprints(docs.select(key.alias("doc_id"), "text"), shingle)), max_bits)
    copies = checkpointed(rows.filter(F.col("doc_id") != F.col("least")).select("doc_id.a", "doc_id.b").distinct())
    copies = copies.toDF("__a", "__b")
    stay = docs.withColumn("__a", a).withColumn("__b", b).join(copies, ["__a", "__b"], "left_anti")
    return stay.dropDuplicates(["doc_id", "text"]).select(*docs.columns)
