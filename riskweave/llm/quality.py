"""Quality rules: repetition coverage by rolling hashes.

For each text, numpy rolls a polynomial hash over the words for several n-gram
lengths and measures how many characters lie inside duplicated n-grams and inside
duplicated lines. Rows go through Spark in Arrow batches; a text never leaves its
task, so there is no shuffle at all.

Defined cases: a null text has no words; texts under ten words fail the base rule;
a very long text is rolled over whole, in arrays of its words, by its task alone; shares at
just a limit pass, and of all n-grams of a length the one that covers most characters counts;
repeated rows are judged alike; an empty table gives an empty table; further input columns
are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import SPACES, longs, map_batches, record, texts

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 10
WINDOW = 5
MAX_REPEAT_PCT = 20

# Published repetition limits of the Gopher rules (Rae et al. 2021,
# table A1), as shares of the text's characters. The share of duplicated lines by
# number is left out: one repeated short line would fail a clean text of three.
MAX_DUP_LINE_CHARS = 0.20
MAX_TOP_NGRAM = {2: 0.20, 3: 0.18, 4: 0.16}
MAX_DUP_NGRAM = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}

_BASE = np.uint64(0x9E3779B97F4A7C15)


def _mixed(ids: np.ndarray) -> np.ndarray:
    """Spread word numbers over 64 bits (splitmix finalizer)."""
    z = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def _covered(starts: np.ndarray, n: int, length: int) -> np.ndarray:
    """Words lying in a window of ``length`` words that begins at one of ``starts``."""
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + length, -1)
    return np.cumsum(edge[:-1]) > 0


def _groups(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in order of their hash, and whether each equals the one before."""
    order = np.argsort(hashes, kind="stable")
    same = np.zeros(len(order), bool)
    same[1:] = hashes[order[1:]] == hashes[order[:-1]]
    return order, same


def _equal_windows(ids: np.ndarray, order: np.ndarray, same: np.ndarray, length: int) -> np.ndarray:
    """Check the windows that share a hash word by word."""
    at = np.flatnonzero(same)
    ok = np.ones(len(at), bool)
    for k in range(length):
        ok &= ids[order[at] + k] == ids[order[at - 1] + k]
    out = same.copy()
    out[at] = ok
    return out


def repetition(ids: np.ndarray, sizes: np.ndarray) -> tuple[int, dict[int, int], dict[int, int]]:
    """(words in repeated windows, characters of the top n-gram by length,
    characters inside duplicated n-grams by length) of a text's word numbers."""
    n = len(ids)
    top = dict.fromkeys(MAX_TOP_NGRAM, 0)
    dup = dict.fromkeys(MAX_DUP_NGRAM, 0)
    repeat_words = 0
    mixed = _mixed(ids)
    rolled = np.zeros(n, np.uint64)
    for length in range(1, max(MAX_DUP_NGRAM) + 1):
        if n < length:
            break
        # hash of the window at i over `length` words, from the one over length - 1
        rolled = rolled[:n - length + 1] * _BASE + mixed[length - 1:]
        if length not in top and length not in dup:
            continue
        order, same = _groups(rolled)
        if not same.any():
            if length >= max(MAX_TOP_NGRAM):
                break  # a longer n-gram can't occur twice when this one doesn't
            continue
        if length == WINDOW:
            same = _equal_windows(ids, order, same, length)
        if length in top:
            run = np.diff(np.flatnonzero(np.append(~same, True)))
            first = order[np.flatnonzero(~same)]
            chars = np.append(0, np.cumsum(sizes))
            top[length] = int(np.max(np.where(run > 1, run * (chars[first + length] - chars[first]), 0)))
            continue
        twice = same.copy()
        twice[:-1] |= same[1:]
        inside = _covered(order[twice], n, length)
        dup[length] = int(sizes[inside].sum())
        if length == WINDOW:
            repeat_words = int(inside.sum())
    return repeat_words, top, dup


def measure(text: str) -> dict:
    """All measures and the verdict for one text."""
    words = text.encode("utf-8").split()
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    length = {w: len(w) if w.isascii() else len(w.decode("utf-8")) for w in numbers}
    sizes = np.array(list(length.values()), np.int64)[ids] if words else np.zeros(0, np.int64)
    chars = int(sizes.sum())
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    seen: set[str] = set()
    dup_lines = dup_line_chars = 0
    for x in lines:
        if x in seen:
            dup_lines += 1
            dup_line_chars += len(x)
        seen.add(x)
    repeat_words, top, dup = repetition(ids, sizes)
    failed = len(words) < MIN_WORDS or 100 * repeat_words > MAX_REPEAT_PCT * len(words)
    repeated = (dup_line_chars > MAX_DUP_LINE_CHARS * chars
                or any(top[k] > share * chars for k, share in MAX_TOP_NGRAM.items())
                or any(dup[k] > share * chars for k, share in MAX_DUP_NGRAM.items()))
    return {"n_words": len(words), "word_chars": chars, "n_symbols": sum(text.count(c) for c in SYMBOLS),
            "n_dup_lines": dup_lines, "n_repeat_words": repeat_words, "dup_line_chars": dup_line_chars,
            "top_ngram_chars": max(top.values()), "dup_ngram_chars": dup[WINDOW],
            "base_failed": failed, "kept": not failed and not repeated}


_LONGS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "dup_line_chars", "top_ngram_chars", "dup_ngram_chars")


def quality_rules(docs: DataFrame) -> DataFrame:
    """Measures and verdict (``kept``) of every whole text."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        got = [measure(t) for t in texts(batch)]
        return record(doc_id=batch.column("doc_id"), **{k: longs([g[k] for g in got]) for k in _LONGS},
                      **{k: pa.array([g[k] for g in got], pa.bool_()) for k in ("base_failed", "kept")})

    kinds = dict(docs.dtypes)
    schema = f"doc_id {kinds['doc_id']}, " + ", ".join(f"{k} long" for k in _LONGS) + ", base_failed boolean, kept boolean"
    return map_batches(docs.select("doc_id", "text"), run, schema)
