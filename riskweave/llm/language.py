"""Language identification by rank-order n-gram profiles (Cavnar and Trenkle 1994).

A profile is a list of the most frequent character n-grams (one to three letters,
word borders marked) in order of frequency. A document's own list is compared to
each language's by the out-of-place distance: the sum of rank differences, the
profile length for an n-gram that the language lacks. Profiles are learned from a
bounded sample of labelled rows (``per_language`` rows of each language on average,
chosen by a hash of id and text) of the ``max_languages`` most frequent labels, a documented
bound of the fit; every whole text is predicted.

The ranks of all profiles are one sparse table by n-gram, so a document meets only the
languages that have its n-grams, however many there are.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; with
no labelled rows everything is ``und``; ties go to the smaller language code; labels beyond
``max_languages`` are never predicted; a very long text is counted whole, in one task, and
learned from n-gram by n-gram; repeated rows teach once and are predicted alike; an empty
table gives an empty table; further input columns are ignored.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import held_out, learnable, longs, map_batches, record, texts

PROFILE = 300  # n-grams of a profile
PER_LANGUAGE = 2_000  # labelled rows that a language's profile is learned from, on average
MAX_LANGUAGES = 10_000  # labels that are learned, the most frequent first
HELD = 1 << 21  # n-grams of a language that a task holds before it adds them up
UNKNOWN = "und"
_SALT = 10_000_000


@functools.cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def ngram_codes(text: str) -> np.ndarray:
    """Every n-gram of one to three characters as an integer (21 bits a character;
    a run of other characters is one border, 1, between words)."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[points]
    points = np.append(np.where(letter, points, 1).astype(np.int64), 1)
    letter = np.append(letter, False)
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # of other characters, only the first after a letter
    points = np.append(1, points[keep])
    one = points[points > 1]
    two = (points[:-1] << 21) | points[1:]
    three = (two[:-1] << 21) | points[2:]
    return np.concatenate([one, two, three[points[1:-1] > 1]])


def ranked(codes: np.ndarray, k: int) -> np.ndarray:
    """The k most frequent codes, most frequent first, ties to the smaller code."""
    codes = np.sort(codes)
    first = np.flatnonzero(np.append(True, codes[1:] != codes[:-1])) if len(codes) else np.zeros(0, np.int64)
    count = np.diff(np.append(first, len(codes)))
    # the sort is stable and codes ascend, so ties stay in order of the code
    return codes[first][np.argsort(-count, kind="stable")[:k]]


class Profiles:
    """Rank of every profile n-gram in every language that has it, by n-gram."""

    def __init__(self, lists: dict[str, list[int]], size: int = PROFILE):
        self.size = size
        self.languages = sorted(lists)
        code = np.array([c for name in self.languages for c in lists[name]], np.int64)
        of = np.repeat(np.arange(len(lists)), [len(lists[name]) for name in self.languages])
        rank = np.concatenate([np.zeros(0, np.int64), *[np.arange(len(lists[name])) for name in self.languages]])
        order = np.lexsort((of, code))
        self.codes, first = np.unique(code[order], return_index=True)
        self.start = np.append(first, len(code))
        self.language, self.rank = of[order], rank[order].astype(np.int64)

    @property
    def ranks(self) -> np.ndarray:
        """The table as a matrix, languages x (n-grams and one unknown), -1 where a language
        lacks one: to look at, for a few languages."""
        out = np.full((len(self.languages), len(self.codes) + 1), -1, np.int64)
        out[self.language, np.repeat(np.arange(len(self.codes)), np.diff(self.start))] = self.rank
        return out

    def predict(self, text: str) -> tuple[str, float]:
        """(language, 1 - mean out-of-place distance as a share of the largest)."""
        own = ranked(ngram_codes(text), self.size)
        if not len(own) or not self.languages:
            return UNKNOWN, 0.0
        at = np.searchsorted(self.codes, own)
        known = np.flatnonzero(np.append(self.codes, -1)[at] == own)
        at = at[known]
        count = self.start[at + 1] - self.start[at]
        entry = np.arange(count.sum()) + np.repeat(self.start[at] - (np.cumsum(count) - count), count)
        # an n-gram that a language lacks costs the profile's length
        near = self.size - np.abs(self.rank[entry] - np.repeat(known, count))
        distance = self.size * len(own) - np.bincount(self.language[entry], near, len(self.languages))
        best = int(distance.argmin())
        return self.languages[best], float(1 - distance[best] / (self.size * len(own)))


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    code, back = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return code, np.bincount(back, np.concatenate([p[1] for p in parts]), len(code)).astype(np.int64)


def learn_profiles(docs: DataFrame, size: int = PROFILE, per_language: int = PER_LANGUAGE,
                   max_languages: int = MAX_LANGUAGES) -> Profiles:
    """Profiles from the learnable labelled rows of ``docs``.

    Rows of each language are counted over all of them; the hash threshold that
    follows keeps about ``per_language`` rows of each, so the hot language is no
    larger than the others. n-grams are counted inside the tasks first."""
    labelled = docs.select("doc_id", "text", "lang").filter(
        learnable(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(max_languages).collect()
    if not counts:
        return Profiles({}, size)
    share = docs.sparkSession.createDataFrame(
        [(r["lang"], max(1, -(-per_language * _SALT // r["count"]))) for r in counts], "lang string, share long")
    sample = labelled.join(F.broadcast(share), "lang").filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(_SALT)) < F.col("share"))
    # a repeated row is one row, however hot its id
    sample = sample.select("lang", "doc_id", "text").distinct()

    def count(batches):
        for batch in batches:
            names = batch.column("lang").to_pylist()
            by: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
            held: dict[str, int] = {}
            for name, text in zip(names, texts(batch), strict=True):
                code, n = np.unique(ngram_codes(text), return_counts=True)
                by.setdefault(name, []).append((code, n))
                held[name] = held.get(name, 0) + len(code)
                if held[name] > HELD:
                    by[name] = [_added(by[name])]
                    held[name] = len(by[name][0][0])
            for name, parts in by.items():
                code, n = _added(parts)
                yield record(lang=pa.array([name] * len(code), pa.string()), code=longs(code), n=longs(n))

    total = (sample.select("lang", "text").mapInArrow(count, "lang string, code long, n long")
             .groupBy("lang", "code").agg(F.sum("n").alias("n")))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "code"))
    # at most languages x profile length rows, both bounded above
    rows = total.withColumn("rank", rank).filter(F.col("rank") <= size).select("lang", "rank", "code").toArrow()
    rows = rows.sort_by([("lang", "ascending"), ("rank", "ascending")])
    lists: dict[str, list[int]] = {}
    for name, code in zip(rows["lang"].to_pylist(), rows["code"].to_pylist(), strict=True):
        lists.setdefault(name, []).append(code)
    return Profiles(lists, size)


def identify(docs: DataFrame, profiles: Profiles | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row."""
    model = profiles or learn_profiles(docs)
    kind = dict(docs.dtypes)["doc_id"]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        got = [model.predict(t) for t in texts(batch)]
        return record(doc_id=batch.column("doc_id"), lang_pred=pa.array([g[0] for g in got], pa.string()),
                      score=pa.array([g[1] for g in got], pa.float64()))

    out = map_batches(docs.select("doc_id", "text"), run, f"doc_id {kind}, lang_pred string, score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, min_score: float, profiles: Profiles | None = None) -> DataFrame:
    """The rows of ``docs``, all columns, whose language is known with ``min_score``."""
    model = profiles or learn_profiles(docs)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        got = [model.predict(t) for t in texts(batch)]
        return batch.filter(pa.array([name != UNKNOWN and score >= min_score for name, score in got], pa.bool_()))

    return map_batches(docs, run, docs.schema)
