"""Lexical search against a plain scorer, and its edge cases."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from riskweave.llm import lexical as L

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}
ITEMS = "item_id long, text string, doc_id string, score int"


def plain(docs, items, k):
    """item_id, rank, doc_id, score by scoring every document."""
    found = [(i, TERM.findall((t or "").translate(UPPER))) for i, t in docs]
    some, whole = sum(bool(t) for _, t in found), sum(len(t) for _, t in found)
    df = Counter(x for _, t in found for x in set(t))
    out = []
    for item, text in items:
        asked = set(TERM.findall((text or "").translate(UPPER)))
        scored = []
        for doc, terms in found:
            tf = Counter(terms)
            m = 50 + (50 * len(terms) * some) // whole if terms else 0
            s = sum(math.floor(1000 * math.log((2 * some + 2) / (2 * df[t] + 1)))
                    * ((1_000_000_000 * tf[t]) // (1000 * tf[t] + 20 * m)) for t in asked if tf[t])
            if s > 0:
                scored.append((-s, doc is None, doc or 0, doc))
        out += [(item, r, doc, -s) for r, (s, _, _, doc) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


def items_of(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], ITEMS)


QUESTIONS = [(1, "the of Contact us"), (2, "der und nicht 7 12 33"), (3, None), (4, ""), (5, "!! ??"), (None, "word WORD café"),
             (6, "nowhereatall"), (7, "the the THE"), (7, "the the THE"), (8, "the"), (9, "\U0001f600 ann example x 4111")]


@pytest.mark.parametrize("k", [3, 50])
def test_equals_the_plain_scorer(spark, edge, k, monkeypatch):
    monkeypatch.setattr(L, "SHARES", (3, 2, 1))
    docs = [(r["doc_id"], r["text"]) for r in edge.collect()]
    want = plain(docs, QUESTIONS, k)
    assert rows_of(L.search(edge, items_of(spark, QUESTIONS), k)) == want
    # several groups of items, searched in passes of their own
    assert rows_of(L.search(edge, items_of(spark, QUESTIONS), k, group_bytes=20)) == want


def test_empty_tables(spark, edge, none):
    assert rows_of(L.search(none, items_of(spark, QUESTIONS))) == []
    assert rows_of(L.search(edge, items_of(spark, []))) == []
    assert L.search(none, items_of(spark, [])).columns == ["item_id", "rank", "doc_id", "score"]


def test_terms_are_those_of_the_pattern():
    every = "".join(map(chr, range(0x250))) + "Ä İ\U0001f600 a b\x85c"
    assert L.terms_of(every.encode()) == [t.encode() for t in TERM.findall(every.translate(UPPER))]


def test_blocks_are_bounded_and_whole():
    import pyarrow as pa

    lists = pa.array([list(range(n % 7)) for n in range(5_000)], pa.list_(pa.int32()))
    batch = pa.RecordBatch.from_arrays([pa.array(range(5_000)), lists], names=["doc_id", "terms"])
    for docs, postings in ((100, 10**9), (10**9, 50), (64, 90)):
        old = L.BLOCK_DOCS, L.BLOCK_POSTINGS
        L.BLOCK_DOCS, L.BLOCK_POSTINGS = docs, postings
        try:
            got = list(L._blocks([batch.slice(0, 1_700), batch.slice(1_700)]))
        finally:
            L.BLOCK_DOCS, L.BLOCK_POSTINGS = old
        assert [i for t in got for i in t["doc_id"].to_pylist()] == list(range(5_000))
        assert max(t.num_rows for t in got) <= docs
        assert max(len(t["terms"].combine_chunks().flatten()) for t in got) < postings + 7


@pytest.mark.parametrize("seed", range(6))
def test_block_search_is_exact_with_ties_and_floors(seed):
    rng = np.random.default_rng(seed)
    n, v = 400, 30
    dense = rng.integers(0, 6, (n, v)) * (rng.random((n, v)) < 0.2)
    dense[50:150] = dense[7]  # many equal documents
    places, terms = np.nonzero(dense)
    block = L.Block(places, terms, dense[places, terms], n, v)
    for _ in range(20):
        asked = rng.choice(v, rng.integers(1, 12), replace=False)
        score = dense[:, asked].sum(axis=1)
        for k, floor in ((1, 1), (10, 1), (120, 1), (10, int(score.max())), (500, 5), (3, 10**9)):
            order = np.lexsort((np.arange(n), -score))
            want = order[score[order] >= floor][:k]
            got, has = block.search(asked.astype(np.int64), k, floor)
            assert got.tolist() == want.tolist() and has.tolist() == score[want].tolist()


def test_bounds_leave_most_documents_unseen():
    rng = np.random.default_rng(1)
    n, v = 8_000, 400
    places = np.repeat(np.arange(n), 20)
    terms = rng.zipf(1.3, len(places)) % v
    key = np.unique(places * v + terms)
    places, terms = key // v, key % v
    df = np.bincount(terms, minlength=v)
    worth = (1000 * np.log((2 * n + 2) / (2 * df[terms] + 1))).astype(np.int64) * rng.integers(100, 1000, len(terms))
    block = L.Block(places, terms, worth, n, v)
    asked = rng.choice(v, 8, replace=False).astype(np.int64)
    _, score = block.search(asked, 10)
    first = block.split
    assert first < 0.5 * n
    block.search(asked, 10, int(score[-1]))  # a floor from other blocks saves more
    assert block.split - first <= first
