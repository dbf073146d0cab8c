"""Toxicity by the nearest labelled examples.

A bounded sample of labelled texts (``EXAMPLES`` of each class, by a hash of the id, none
longer than ``EXAMPLE_BYTES``, together at most ``CLASS_BYTES`` of a class) becomes TF-IDF
vectors over all their words; document frequencies for the IDF are counted over all texts.
Plain TF-IDF is dominated by the topic, so a word's weight grows by how far the classes
differ in it (``CLASS_WEIGHT`` times the squared phi coefficient): a departure from plain
TF-IDF, with figures in the README. No word is left out, and a vector's length is taken
over all of them.

The vectors lie in sparse posting lists, with each term's largest weight, its largest in
every wide block and where its small blocks begin. A text's exact cosine neighbours are
found term by term, those worth most first. After a portion of the postings, the k-th
partial cosine is a floor, and a vector stays a candidate while its partial cosine plus
its wide block's bound for the terms to come reaches that floor; once few are left, their
small blocks alone are read to the end. Neighbours vote by their similarity; a vote
stands for as many labelled texts as its example does, which calibrates the score.

The index holds the words of texts of at most 2 x ``CLASS_BYTES`` bytes, whatever the input,
so it may be sent to every task; the texts are scored where they lie. Words that no
example has meet no posting; a text's own length is a common factor of its cosines and of
its votes.

Defined cases: a text without a word of the examples (empty and null ones too) has
the examples without words for its neighbours, all equally near; with no labels of one
class the score is the share of the other; ties go to the earlier example; a labelled id
that repeats teaches once, by its smallest text; very long texts are scored whole, and
only as examples passed over; repeated rows are scored alike; an empty table gives an
empty table; further columns are ignored.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import held_out, learnable, longs, map_batches, record, texts

EXAMPLES = 2_048  # labelled rows of each class
EXAMPLE_BYTES = 1 << 17  # of a text that may be an example
CLASS_BYTES = 1 << 24  # of a class's examples together
CLASS_WEIGHT = 200.0  # a word that tells the classes apart weighs 1 + this times its IDF
NEIGHBOURS = 15
BLOCK = 16  # vectors of a small block
WIDE = 256  # vectors of a wide block
PORTIONS = (0.2, 0.5)  # of a query's postings, after which candidates are counted
FEW = 400  # candidates that are finished in their blocks
TIE = 2e-12  # cosines nearer than this may be equal
#: Bytes of a word: ASCII letters and digits, and all of code points from U+0080.
_BYTES = bytes(b if chr(b).isalnum() or b >= 128 else 32 for b in range(256))


def words_of(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "surrogatepass").translate(_BYTES).split()


def _ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (count[0] numbers), start[1], ..."""
    return np.arange(count.sum()) + np.repeat(start - (np.cumsum(count) - count), count)


class BlockMaxIndex:
    """Posting lists of unit vectors, with each term's largest weight in blocks of vectors.
    ``vectors`` is a matrix, or its entries above zero (rows, terms, weights) with its
    shape."""

    def __init__(self, vectors, block: int = BLOCK, wide: int = WIDE):
        if isinstance(vectors, np.ndarray):
            vectors = (*np.nonzero(vectors), vectors[np.nonzero(vectors)], vectors.shape)
        rows, terms, weights, (n, n_terms) = vectors
        self.n, self.small, self.wide = n, block, wide
        # like vectors side by side: blocks then differ in their bounds
        heaviest, most = np.full(n, n_terms), np.zeros(n)
        order = np.lexsort((terms, -weights, rows))
        top = order[np.flatnonzero(np.diff(rows[order], prepend=-1))]
        heaviest[rows[top]], most[rows[top]] = terms[top], weights[top]
        self.order = np.lexsort((-most, heaviest))
        place_of = np.empty(n, np.int64)
        place_of[self.order] = np.arange(n)
        place = place_of[rows]
        order = np.lexsort((place, terms))
        terms = terms[order]
        # a term's postings lie together, by place
        self.place, self.weight = place[order].astype(np.int32), weights[order]
        self.of_term = np.searchsorted(terms, np.arange(n_terms + 1))
        # its small blocks: which, and where their postings begin; its wide blocks: which, and the largest weight
        first, self.small_of, self.small_term = self._cut(terms, block)
        self.small_start = np.append(first, len(terms)).astype(np.int32)
        first, self.wide_of, self.wide_term = self._cut(terms, wide)
        self.wide_largest = np.maximum.reduceat(self.weight, first) if len(first) else np.zeros(0)
        self.largest = np.zeros(n_terms)
        np.maximum.at(self.largest, terms, self.weight)
        self.read = self.had = 0  # postings read, and those that the queries' terms have

    def _cut(self, terms: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        of = self.place // size
        first = np.flatnonzero((np.diff(terms, prepend=-1) != 0) | (np.diff(of, prepend=-1) != 0))
        return first, of[first], np.searchsorted(terms[first], np.arange(len(self.of_term)))

    def _add(self, sums: np.ndarray, start: np.ndarray, size: np.ndarray, weights: np.ndarray) -> np.ndarray:
        at = _ranges(start, size)
        self.read += len(at)
        return sums + np.bincount(self.place[at], np.repeat(weights, size) * self.weight[at], self.n)

    def _candidates(self, sums: np.ndarray, terms: np.ndarray, weights: np.ndarray, k: int) -> np.ndarray:
        """Places that the terms to come can still bring to the k-th partial sum."""
        least = np.partition(sums, -k)[-k] - TIE if self.n > k else 0.0
        count = self.wide_term[terms + 1] - self.wide_term[terms]
        lists = _ranges(self.wide_term[terms], count)
        bound = np.bincount(self.wide_of[lists], np.repeat(weights, count) * self.wide_largest[lists], -(-self.n // self.wide))
        return np.flatnonzero(sums + np.repeat(bound, self.wide)[:self.n] >= least)

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(examples, cosines) of the exact k nearest with a cosine above zero."""
        some = self.of_term[terms + 1] > self.of_term[terms]
        terms, weights = terms[some], weights[some]
        start = self.of_term[terms]
        size = self.of_term[terms + 1] - start
        # most worth for a posting first
        first = np.argsort(-weights * self.largest[terms] / np.sqrt(size), kind="stable")
        terms, weights, start, size = terms[first], weights[first], start[first], size[first]
        until = np.cumsum(size)
        whole = int(size.sum())
        self.had += whole
        sums, done = np.zeros(self.n), 0
        for portion in PORTIONS:
            to = int(np.searchsorted(until, portion * whole, side="right"))
            if to <= done:
                continue
            sums = self._add(sums, start[done:to], size[done:to], weights[done:to])
            done = to
            left = self._candidates(sums, terms[done:], weights[done:], k)
            if len(left) <= FEW:
                wanted = np.zeros(-(-self.n // self.small), bool)
                wanted[left // self.small] = True
                count = self.small_term[terms[done:] + 1] - self.small_term[terms[done:]]
                lists = _ranges(self.small_term[terms[done:]], count)
                own = wanted[self.small_of[lists]]
                lists, asked = lists[own], np.repeat(weights[done:], count)[own]
                sums = self._add(sums, self.small_start[lists], self.small_start[lists + 1] - self.small_start[lists], asked)
                only = np.zeros(self.n)
                only[left] = sums[left]
                sums, done = only, len(terms)
                break
        if done < len(terms):
            sums = self._add(sums, start[done:], size[done:], weights[done:])
        found = np.flatnonzero(sums > 0)
        ids, cos = self.order[found], sums[found]
        if len(cos) > k:
            near = cos >= np.partition(cos, -k)[-k] - TIE
            ids, cos = ids[near], cos[near]
        best = np.lexsort((ids, -np.round(cos, 12)))[:k]
        return ids[best], cos[best]


class Model:
    """The examples' postings (row, term, count) and what their votes are worth."""

    def __init__(self, vocabulary: list[bytes], idf: np.ndarray, postings: tuple[np.ndarray, np.ndarray, np.ndarray],
                 toxic: np.ndarray, ids: np.ndarray, stands_for: tuple[float, float], neighbours: int = NEIGHBOURS):
        self.number = {t: i for i, t in enumerate(vocabulary)}
        self.toxic, self.ids, self.neighbours = toxic, ids, neighbours
        rows, terms, counts = postings
        self.term_weight = idf * (1 + CLASS_WEIGHT * phi_squared(rows, terms, toxic, len(vocabulary)))
        weights = (1 + np.log(counts)) * self.term_weight[terms]
        norm = np.sqrt(np.bincount(rows, weights * weights, len(toxic)))
        some = weights > 0  # a word that all texts have weighs nothing
        self.index = BlockMaxIndex((rows[some], terms[some], (weights / np.maximum(norm[rows], 1e-300))[some],
                                    (len(toxic), len(vocabulary))))
        self.vote = np.where(toxic == 1, stands_for[1], stands_for[0])
        none = np.flatnonzero(norm == 0)
        self.without = self.share(none, np.ones(len(none)))
        self.prior = self.share(np.arange(len(toxic)), np.ones(len(toxic)))

    def share(self, rows: np.ndarray, closeness: np.ndarray) -> float | None:
        votes = closeness * self.vote[rows]
        return float((votes * self.toxic[rows]).sum() / votes.sum()) if len(rows) else None

    def score(self, text: str) -> tuple[float, list[int]]:
        """(score, ids of the examples that voted)."""
        found = Counter(words_of(text))
        own = self.number.keys() & found.keys()
        if own:
            at = np.array([self.number[t] for t in own], np.int64)
            count = np.array([found[t] for t in own], np.float64)
            weights = (1 + np.log(count)) * self.term_weight[at]
            rows, cos = self.index.nearest(at, weights / max(np.linalg.norm(weights), 1e-300), self.neighbours)
            if len(rows):
                return self.share(rows, cos), self.ids[rows].tolist()
        prior = 0.0 if self.prior is None else self.prior
        return (prior if self.without is None else self.without), []


def phi_squared(rows: np.ndarray, terms: np.ndarray, toxic: np.ndarray, n_terms: int) -> np.ndarray:
    """Of each term: the squared correlation, over the examples, of having it and of
    being toxic. 0 for a term that all have, and with one class."""
    n, n1 = len(toxic), float(toxic.sum())
    n0 = n - n1
    b = np.bincount(terms, toxic[rows], n_terms)
    a = np.bincount(terms, minlength=n_terms) - b
    gap = a * (n1 - b) - b * (n0 - a)
    spread = (a + b) * (n - a - b) * n0 * n1
    return np.where(spread > 0, gap * gap / np.maximum(spread, 1), 0.0)


def learn(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES) -> Model:
    """The model, from the learnable labelled rows and the frequencies of all texts."""
    known = labels.select("doc_id", "toxic").filter(learnable(F.col("doc_id")) & F.col("toxic").isin(0, 1))
    known = known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi").distinct()
    n = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    sample = [known.filter(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(examples) for c in (0, 1)]
    sample = F.broadcast(sample[0].unionByName(sample[1]))  # 2 x examples rows at most
    chosen = docs.select("doc_id", "text").filter(F.octet_length("text") <= EXAMPLE_BYTES).join(sample, "doc_id")
    # an id that repeats teaches once (its smallest text), or it could fill the index
    chosen = chosen.groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    together = F.sum(F.octet_length("text")).over(Window.partitionBy("toxic").orderBy(F.xxhash64("doc_id"), "doc_id"))
    chosen = chosen.withColumn("bytes", together).filter(F.col("bytes") <= CLASS_BYTES)

    def words(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [Counter(words_of(t)) for t in texts(batch)]
        return record(doc_id=batch.column("doc_id").cast(pa.int64()), toxic=batch.column("toxic").cast(pa.int32()),
                      words=pa.array([list(f) for f in found], pa.list_(pa.binary())),
                      counts=pa.array([list(f.values()) for f in found], pa.list_(pa.int64())))

    # 2 x CLASS_BYTES of texts at most, as Arrow: the driver makes no object of each word
    rows = map_batches(chosen, words, "doc_id long, toxic int, words array<binary>, counts array<long>").toArrow()
    rows = rows.sort_by([("doc_id", "ascending"), ("toxic", "ascending")])
    coded = pc.list_flatten(rows["words"]).combine_chunks().dictionary_encode()
    terms = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    counts = pc.list_flatten(rows["counts"]).to_numpy()
    row = np.repeat(np.arange(len(rows)), pc.list_value_length(rows["words"]).to_numpy())
    vocabulary = coded.dictionary.to_pylist()
    toxic = rows["toxic"].to_numpy().astype(np.int64)
    stands_for = tuple(n.get(c, 0) / max(1, int((toxic == c).sum())) for c in (0, 1))
    return Model(vocabulary, inverse_frequencies(docs, vocabulary), (row, terms, counts), toxic, rows["doc_id"].to_numpy(),
                 stands_for)


def inverse_frequencies(docs: DataFrame, vocabulary: list[bytes]) -> np.ndarray:
    """ln((1 + texts) / (1 + texts with the term)) of each term, over all texts."""
    shared = docs.sparkSession.sparkContext.broadcast({t: i for i, t in enumerate(vocabulary)})

    def count(batches):
        number = shared.value
        n, found = 0, np.zeros(len(number), np.int64)
        for batch in batches:
            n += batch.num_rows
            for text in texts(batch):
                found[[number[t] for t in number.keys() & set(words_of(text))]] += 1
        some = np.flatnonzero(found)
        yield record(term=longs(np.append(-1, some)), n=longs(np.append(n, found[some])))

    rows = docs.select("text").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    term, n = rows["term"].to_numpy(), rows["n"].to_numpy()
    df = np.zeros(len(vocabulary))
    df[term[term >= 0]] = n[term >= 0]
    return np.log((1 + n[term < 0].sum()) / (1 + df))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted, evidence (ids of the voting examples)."""
    kind = dict(docs.dtypes)["doc_id"]

    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        own = shared.value
        for batch in batches:
            known: dict[str, tuple[float, list[int]]] = {}
            for text in texts(batch):
                if text not in known:
                    known[text] = own.score(text)
            got = [known[text] for text in texts(batch)]
            yield record(doc_id=batch.column("doc_id"), score=pa.array([g[0] for g in got], pa.float64()),
                         evidence=pa.array([g[1] for g in got], pa.list_(pa.int64())))

    out = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double, evidence array<long>")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, learn(docs, labels))
