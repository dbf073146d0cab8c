"""Ranked lexical search with range-maximum queries on posting lists.

One scan of the texts counts the terms that the items ask for and writes each document's
(term, count) pairs to the shared folder. Document frequencies follow from that table, and
with them the weights, so a posting's impact (its part of the score) is an exact integer.

Tasks gather documents into blocks of bounded size, sorted by id. Over the impacts of a
block's posting lists lie sparse tables: for every power of two, where the largest impact
of that many neighbouring postings is. The largest impact of a term in any document
interval is then two look-ups, and their sum over an item's terms bounds every score
inside. The search begins with the whole block, takes the intervals with the highest
bounds first, scores the document of the largest impact in each, and splits the interval
there. What can't reach the item's k-th score is dropped unseen; the rest goes on until
no interval is left, so the result is exact.

Blocks know each other through a floor for every item: a first 256th of the partitions is
searched, then a 16th, then the rest, and the k-th score so far (a true lower bound of the
final one) goes to the next pass. So later blocks return few rows, whatever their number.
Items are a stated query set: they are dealt into groups of about ``GROUP_BYTES`` of text,
and each group is searched in passes of its own, so what tasks receive is bounded.

Defined cases: a null or empty text, and one without a term, has no terms and isn't counted
or found; items without a term have no rows; null ids sort last among ties; repeated items
are searched each, repeated documents found each; a very long text is one document with
at most as many postings as the group has terms; empty tables give an empty table; further
columns are ignored. 50 * terms of a document * documents must fit 64 bits.
"""

from __future__ import annotations

import math
from collections import Counter
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, longs, map_batches, record

K = 50
GROUP_BYTES = 16_000_000  # of item texts that are searched together, on average
BLOCK_DOCS = 8_192
BLOCK_POSTINGS = 2_000_000
WAVE = 128  # intervals that are split at a time
SHARES = (256, 16, 1)  # of the partitions, searched up to each pass

#: Bytes of a term: digits, letters, and all of code points from U+0080; only A-Z change.
_BYTES = bytes((b | 32 if 65 <= b <= 90 else b) if chr(b).isalnum() or b >= 128 else 32 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text, in order, repeats included."""
    return text.translate(_BYTES).split()


def _bytes(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    return [t or b"" for t in batch.column(name).cast(pa.binary()).to_pylist()]


def count_terms(docs: DataFrame, number: dict[bytes, int]) -> DataFrame:
    """part, doc_id, n, terms, counts: of each document, how many terms it has and how
    often those of ``number``."""
    shared = docs.sparkSession.sparkContext.broadcast(number)

    def run(batches):
        known, part = shared.value, TaskContext.get().partitionId()
        for batch in batches:
            n, ends, terms, counts = [], [0], [], []
            for text in _bytes(batch):
                words = terms_of(text)
                found = Counter(words)
                own = known.keys() & found.keys()
                n.append(len(words))
                terms += [known[t] for t in own]
                counts += [found[t] for t in own]
                ends.append(len(terms))
            ends = pa.array(ends, pa.int32())
            yield record(part=pa.array([part] * len(n), pa.int32()), doc_id=batch.column("doc_id"), n=longs(n),
                         terms=pa.ListArray.from_arrays(ends, pa.array(terms, pa.int32())),
                         counts=pa.ListArray.from_arrays(ends, pa.array(counts, pa.int32())))

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(
        run, f"part int, doc_id {kind}, n long, terms array<int>, counts array<int>")


def weights(index: DataFrame, n_terms: int) -> tuple[np.ndarray, int, int]:
    """(weight of each term, documents with a term, all terms)."""

    def run(batches):
        df, of, some = np.zeros(n_terms, np.int64), 0, 0
        for batch in batches:
            n = batch.column("n").to_numpy()
            of, some = of + int(n.sum()), some + int((n > 0).sum())
            df += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=n_terms)
        at = np.flatnonzero(df)
        yield record(term=longs(np.append([-2, -1], at)), n=longs(np.append([of, some], df[at])))

    sums = index.select("n", "terms").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n")).toArrow()
    count = dict(zip(sums[0].to_pylist(), sums[1].to_pylist(), strict=True))  # n_terms rows at most
    whole, some = count.get(-2, 0), count.get(-1, 0)
    weight = [math.floor(1000 * math.log((2 * some + 2) / (2 * count[t] + 1))) if t in count else 0 for t in range(n_terms)]
    return np.array(weight, np.int64), some, whole


def impacts(weight: np.ndarray, count: np.ndarray, n: np.ndarray, some: int, whole: int) -> np.ndarray:
    m = 50 + (50 * n * some) // whole
    return weight * ((1_000_000_000 * count) // (1000 * count + 20 * m))


class Block:
    """Posting lists of a block's documents, with sparse tables of where the largest
    impacts are. ``places`` and ``terms`` and ``impact`` give one posting each."""

    def __init__(self, places: np.ndarray, terms: np.ndarray, impact: np.ndarray, n_docs: int, n_terms: int):
        self.n_docs = n_docs
        some = impact > 0
        key = terms[some].astype(np.int64) * n_docs + places[some]
        order = np.argsort(key, kind="stable")
        self.key, self.impact = key[order], impact[some][order]
        self.start = np.searchsorted(self.key, np.arange(n_terms + 1, dtype=np.int64) * n_docs)
        longest = int(np.diff(self.start).max(initial=1))
        table = [np.arange(len(self.key), dtype=np.int32)]
        for j in range(longest.bit_length() - 1):
            # the last entries reach beyond the end and are never asked for
            last, step = table[-1], 1 << j
            left, right = last[:-step], last[step:]
            table.append(np.append(np.where(self.impact[left] >= self.impact[right], left, right), last[-step:]))
        self.table = np.concatenate(table)
        self.log = np.floor(np.log2(np.maximum(1, np.arange(longest + 1)))).astype(np.int64)
        self.split = 0  # documents scored, for the tests

    def largest(self, first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(posting, impact) of the largest impact among postings first to end - 1 of a
        list; impact 0 where there is none."""
        n = len(self.key)
        size = end - first
        level = self.log[size]
        left = self.table[level * n + np.minimum(first, n - 1)]
        right = self.table[level * n + np.clip(end - (1 << level), 0, n - 1)]
        a, b = self.impact[left], self.impact[right]
        return np.where(a >= b, left, right), np.where(size > 0, np.maximum(a, b), 0)

    def search(self, terms: np.ndarray, k: int, floor: int = 1) -> tuple[np.ndarray, np.ndarray]:
        """(places, scores) of the k best documents with a score of ``floor`` or more,
        highest first, ties to the smaller place."""
        terms = terms[self.start[terms + 1] > self.start[terms]]
        best, score = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if not len(terms):
            return best, score
        base = terms * self.n_docs
        wave = max(1, min(WAVE, (1 << 20) // len(terms)))
        lo, hi = np.array([0]), np.array([self.n_docs])
        first, end = self.start[terms][None], self.start[terms + 1][None]
        at, most = self.largest(first, end)
        bound = most.sum(axis=1)
        while True:
            full = len(best) == k
            least = max(floor, int(score[-1])) if full else floor
            # an equal bound can only win by a smaller place
            alive = (bound > least) | ((bound == least) & (lo < best[-1] if full and score[-1] == least else True))
            alive = np.flatnonzero(alive & (bound > 0))
            if not len(alive):
                return best, score
            if len(alive) > wave:
                alive = alive[np.argsort(-bound[alive], kind="stable")]
            now, rest = alive[:wave], alive[wave:]
            # split at the document of the largest impact
            heaviest = most[now].argmax(axis=1)
            place = self.key[at[now, heaviest]] % self.n_docs
            wanted = base + place[:, None]
            cut = np.searchsorted(self.key, wanted)
            found = np.minimum(cut, len(self.key) - 1)
            has = self.key[found] == wanted
            got = np.where(has, self.impact[found], 0).sum(axis=1)
            self.split += len(now)
            good = got >= least
            best, score = np.append(best, place[good]), np.append(score, got[good])
            top = np.lexsort((best, -score))[:k]
            best, score = best[top], score[top]
            new_lo, new_hi = np.append(lo[now], place + 1), np.append(place, hi[now])
            new_first = np.concatenate([first[now], cut + has])
            new_end = np.concatenate([cut, end[now]])
            new_at, new_most = self.largest(new_first, new_end)
            lo, hi = np.append(lo[rest], new_lo), np.append(hi[rest], new_hi)
            first, end = np.concatenate([first[rest], new_first]), np.concatenate([end[rest], new_end])
            at, most = np.concatenate([at[rest], new_at]), np.concatenate([most[rest], new_most])
            bound = np.append(bound[rest], new_most.sum(axis=1))


def _blocks(batches):
    """Batches of the index put together to blocks of bounded size."""
    held, docs, postings = [], 0, 0
    for batch in batches:
        # a batch of long documents is cut, so that a block stays near its bound
        per = np.cumsum(batch.column("terms").value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            done = int(per[at - 1]) if at else 0
            take = int(np.searchsorted(per, done + BLOCK_POSTINGS - postings)) + 1 - at
            take = min(max(1, take), BLOCK_DOCS - docs, batch.num_rows - at)
            held.append(batch.slice(at, take))
            docs, postings, at = docs + take, postings + int(per[at + take - 1]) - done, at + take
            if docs >= BLOCK_DOCS or postings >= BLOCK_POSTINGS:
                yield pa.Table.from_batches(held).combine_chunks()
                held, docs, postings = [], 0, 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def search_blocks(index: DataFrame, asked: list[np.ndarray], floors: np.ndarray, weight: np.ndarray, some: int,
                  whole: int, k: int) -> DataFrame:
    """item (its number in ``asked``), doc_id, score: of every block, each item's k best
    documents that reach its floor."""
    kind = dict(index.dtypes)["doc_id"]
    shared = index.sparkSession.sparkContext.broadcast((asked, floors, weight))

    def run(batches):
        queries, least, w = shared.value
        for table in _blocks(batches):
            table = table.sort_by("doc_id")  # nulls last
            lists = table["terms"].combine_chunks()
            terms = lists.flatten().to_numpy()
            size = lists.value_lengths().to_numpy()
            places = np.repeat(np.arange(len(size)), size)
            counts = table["counts"].combine_chunks().flatten().to_numpy().astype(np.int64)
            worth = impacts(w[terms], counts, table["n"].to_numpy()[places], some, whole)
            block = Block(places, terms, worth, len(size), len(w))
            found = [block.search(q, k, int(f)) for q, f in zip(queries, least, strict=True)]
            item = np.repeat(np.arange(len(found)), [len(f[0]) for f in found])
            place = np.concatenate([f[0] for f in found])
            yield record(item=longs(item), doc_id=table["doc_id"].combine_chunks().take(pa.array(place)),
                         score=longs(np.concatenate([f[1] for f in found])))

    return index.drop("part").mapInArrow(run, f"item long, doc_id {kind}, score long")


def _ranked(found: DataFrame) -> DataFrame:
    best_first = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(best_first))


def _search_group(docs: DataFrame, items: DataFrame, k: int) -> DataFrame:
    spark = docs.sparkSession

    def split(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = [sorted(set(terms_of(t))) for t in _bytes(batch)]
        return record(item_id=batch.column("item_id"), terms=pa.array(own, pa.list_(pa.binary())))

    kind = dict(items.dtypes)["item_id"]
    # about GROUP_BYTES of terms
    rows = map_batches(items.select("item_id", "text"), split, f"item_id {kind}, terms array<binary>").toArrow()
    per_item = rows["terms"].to_pylist()
    number = {t: i for i, t in enumerate(sorted({t for own in per_item for t in own}))}
    asked = [np.array([number[t] for t in own], np.int64) for own in per_item]
    index = checkpointed(count_terms(docs, number))
    weight, some, whole = weights(index, len(number))
    floors = np.ones(len(asked), np.int64)
    passes = []
    for i, share in enumerate(SHARES if asked else ()):
        new = F.col("part") % share == 0
        for before in SHARES[:i]:
            new &= F.col("part") % before != 0
        found = search_blocks(index.filter(new), asked, floors, weight, some, whole, k)
        passes.append(checkpointed(_ranked(found).filter(F.col("rank") <= k).drop("rank")))
        if share > 1:
            kth = _ranked(reduce(DataFrame.unionByName, passes)).filter(F.col("rank") == k).select("item", "score")
            for r in kth.collect():  # a row for each item at most
                floors[r["item"]] = r["score"]
    names = pa.table({"item": longs(range(len(asked))), "item_id": rows["item_id"]})
    names = spark.createDataFrame(names, f"item long, item_id {kind}")
    if not passes:
        passes = [spark.createDataFrame([], f"item long, doc_id {dict(docs.dtypes)['doc_id']}, score long")]
    best = _ranked(reduce(DataFrame.unionByName, passes)).filter(F.col("rank") <= k)
    return best.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = K, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score: each item's k highest-scoring documents."""
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(1, -(-size // group_bytes))
    dealt = items.select("item_id", "text", F.pmod(F.xxhash64("item_id", "text"), F.lit(groups)).alias("group"))
    return reduce(DataFrame.unionByName, [
        _search_group(docs, dealt.filter(F.col("group") == g), k) for g in range(groups)])


def oracle(k: int = K) -> str:
    """The same result as SQL over ``documents`` and ``benchmark``."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    terms = (rf"regexp_extract_all(translate(text, '{upper}', '{upper.lower()}'), "
             r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {terms} AS t FROM documents WHERE text IS NOT NULL),
s AS (SELECT count(*) AS n_docs, sum(len(t))::BIGINT AS n_all FROM d WHERE len(t) > 0),
i AS (SELECT row_number() OVER () AS q, item_id, list_distinct({terms}) AS t FROM benchmark WHERE text IS NOT NULL),
iq AS (SELECT q, unnest(t) AS term FROM i),
p AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM d)
      WHERE term IN (SELECT term FROM iq) GROUP BY r, term),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
      FROM p CROSS JOIN s GROUP BY term, n_docs),
m AS (SELECT r, doc_id, 50 + (50 * len(t)::BIGINT * n_docs) // n_all AS m FROM d CROSS JOIN s),
x AS (SELECT q, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
      FROM p JOIN w USING (term) JOIN m USING (r) JOIN iq USING (term) GROUP BY q, r, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank,
       doc_id, score
FROM x JOIN i USING (q) WHERE score > 0 QUALIFY rank <= {k}"""
