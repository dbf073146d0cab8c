"""Language, quality, toxicity, personal data: brute force, accuracy and edge cases."""

import hashlib
import re
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from riskweave.llm import language, pii, quality, toxicity
from riskweave.llm.common import read

from .conftest import CARD, EMAIL, IP, PHONE


def fold(i):
    return zlib.crc32(str(i).encode()) % 5


# --- language ----------------------------------------------------------------
def test_ngrams_are_those_of_padded_words():
    text = "The cat, the Hat 99 Über"
    grams = Counter()
    for w in ("the", "cat", "the", "hat", "über"):
        w = f"\0{w}\0"
        for n in (1, 2, 3):
            grams.update(w[i:i + n] for i in range(len(w) - n + 1) if w[i:i + n].strip("\0"))
    codes, n = np.unique(language.ngram_codes(text), return_counts=True)
    assert sorted(n.tolist()) == sorted(grams.values())
    assert language.ranked(language.ngram_codes("aab aab"), 1).tolist() == [ord("a")]


def test_out_of_place_distance():
    model = language.Profiles({"x": [1, 2, 3], "y": [3, 9, 1]}, size=3)
    own = np.array([3, 1, 7])

    def far(profile):
        return sum(abs(profile.index(c) - i) if c in profile else 3 for i, c in enumerate(own.tolist()))

    at = np.searchsorted(model.codes, own)
    known = np.append(model.codes, -1)[at] == own
    ranks = model.ranks[:, np.where(known, at, len(model.codes))]
    got = np.where(ranks < 0, 3, np.abs(ranks - np.arange(3))).sum(axis=1).tolist()
    assert got == [far([1, 2, 3]), far([3, 9, 1])]


def test_language_held_out_accuracy(spark):
    docs = read(spark, SF_SMALL, "documents")
    got = {r["doc_id"]: r for r in language.identify(docs).collect()}
    rows = docs.collect()
    assert len(got) == len(rows)
    held = [r for r in rows if fold(r["doc_id"]) == 0]
    assert all(got[r["doc_id"]]["held_out"] == (fold(r["doc_id"]) == 0) for r in rows)
    assert np.mean([got[r["doc_id"]]["lang_pred"] == r["lang"] for r in held]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_language_edge_cases(edge, none):
    got = language.identify(edge).collect()
    assert len(got) == edge.count()
    by_id = {r["doc_id"]: r for r in got}
    for i in (60, 61, 62, 63):
        assert (by_id[i]["lang_pred"], by_id[i]["score"]) == ("und", 0.0)
    assert all(by_id[i]["lang_pred"] == ("en" if i % 2 else "de") for i in range(60))
    assert by_id[None]["held_out"] is False
    assert language.identify(none).count() == 0
    kept = language.keep_identified(edge, 0.2)
    assert kept.columns == edge.columns and kept.dtypes == edge.dtypes
    assert {60, 61, 62, 63}.isdisjoint(r["doc_id"] for r in kept.collect())
    assert {r["lang_pred"] for r in language.identify(edge.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


# --- quality -----------------------------------------------------------------
def plain_quality(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]

    def covered(n):
        grams = [tuple(words[i:i + n]) for i in range(len(words) - n + 1)]
        many = Counter(grams)
        inside = set()
        for i, g in enumerate(grams):
            if many[g] > 1:
                inside.update(range(i, i + n))
        return inside

    repeat = len(covered(5))
    chars = sum(map(len, words))
    seen, dup, dup_chars = set(), 0, 0
    for x in lines:
        dup += x in seen
        dup_chars += len(x) * (x in seen)
        seen.add(x)
    failed = len(words) < 10 or 100 * repeat > 20 * len(words)
    top_ok = all(max([c * sum(map(len, g)) for g, c in Counter(
        tuple(words[i:i + n]) for i in range(len(words) - n + 1)).items() if c > 1], default=0) <= share * chars
        for n, share in quality.MAX_TOP_NGRAM.items())
    dup_ok = all(sum(len(words[i]) for i in covered(n)) <= share * chars for n, share in quality.MAX_DUP_NGRAM.items())
    kept = not failed and top_ok and dup_ok and dup_chars <= quality.MAX_DUP_LINE_CHARS * chars
    return (len(words), chars, len(re.findall(r"[#*$%&|<>]", text)), dup, repeat, failed, kept)


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@pytest.mark.parametrize("text", [
    "", "a", "a b c d e " * 9, "one two three four five six\n" * 3 + "seven", "x y z w v u t s r q p", "a b " * 30,
    "ää \U0001f600 ß\n\n \t\nää \U0001f600 ß\n" * 4, "# * $ % & | < >" * 5, "a a a a a a a a a a a a"])
def test_quality_of_one_text(text):
    got = quality.measure(text)
    assert tuple(got[c] for c in COLUMNS) == plain_quality(text)


def test_quality_equals_brute_force(spark, edge, none):
    for docs in (read(spark, SF_SMALL, "documents"), edge):
        want = Counter((r["doc_id"], *plain_quality(r["text"])) for r in docs.collect())
        assert Counter((r["doc_id"], *(r[c] for c in COLUMNS)) for r in quality.quality_rules(docs).collect()) == want
    assert quality.quality_rules(none).count() == 0


def test_quality_hash_collisions_are_checked():
    ids = np.array([1, 2, 3, 4, 5, 1, 2, 3, 4, 6])
    order = np.array([0, 5])
    assert quality._equal_windows(ids, order, np.array([False, True]), 4).tolist() == [False, True]
    assert quality._equal_windows(ids, order, np.array([False, True]), 5).tolist() == [False, False]


def plain_predict(lists, text, size):
    """Out-of-place distances, n-gram by n-gram."""
    words = [f" {w} " for w in "".join(c if c.isalpha() else " " for c in text.lower()).split()]
    grams = Counter(g for w in words for k in (1, 2, 3) for g in (w[i:i + k] for i in range(len(w) - k + 1)) if g.strip())
    code = {g: int("".join(f"{1 if c == ' ' else ord(c):021b}" for c in g), 2) for g in grams}
    own = [c for _, c in sorted((-n, code[g]) for g, n in grams.items())[:size]]
    best = min((sum(abs(i - ranks.index(c)) if c in ranks else size for i, c in enumerate(own)), name) for name, ranks in lists.items())
    return best[1], 1 - best[0] / (size * len(own))


def test_predictions_equal_out_of_place_distances(spark):
    docs = read(spark, SF_SMALL, "documents")
    lists = {}
    for r in docs.filter("lang is not null").limit(12).collect():
        lists[f"{r['lang']}{len(lists)}"] = [int(c) for c in language.ranked(language.ngram_codes(r["text"]), 40)]
    model = language.Profiles(lists, 40)
    for r in docs.limit(40).collect():
        if any(c.isalpha() for c in r["text"]):
            name, score = plain_predict(lists, r["text"], 40)
            got = model.predict(r["text"])
            assert got[0] == name and got[1] == pytest.approx(score)


def test_more_than_a_thousand_labels_are_predicted(spark):
    rng = np.random.default_rng(7)
    letters = "abcdefghijklmnopqrstuvwxyz"

    def word(i, rng):  # each label has letters and pairs of its own
        a, b, c = letters[i % 26], letters[i // 26 % 26], letters[i // 676]
        return a + b + c + a + rng.choice(list(a + b + c))

    rows = [(3 * i + j, " ".join(word(i, rng) for _ in range(12)), f"l{i:04}") for i in range(1_500) for j in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = language.identify(docs).join(docs, "doc_id").collect()
    assert len({r["lang_pred"] for r in got}) > 1_200
    learned = {r["lang"] for r in got if not r["held_out"]}
    held = [r for r in got if r["held_out"] and r["lang"] in learned]
    assert np.mean([r["lang_pred"] == r["lang"] for r in held]) > 0.8
    few = language.learn_profiles(docs, max_languages=10)
    assert len(few.languages) == 10


def test_a_hot_row_teaches_once(spark):
    rows = [(i, f"the and of {i} with", "en") for i in range(60)] + [(5, "zzz zzz zzz", "en")] * 900 + [(i, "der die das und", "de") for i in range(60, 90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.learn_profiles(docs, per_language=10**6)
    z = int(language.ngram_codes("zzz")[0])
    at = int(np.searchsorted(model.codes, z))
    english = model.rank[model.start[at]:model.start[at + 1]]
    assert fold(5) == 0 or (english > 3).all()


# --- toxicity ----------------------------------------------------------------
def test_block_max_index_is_exact():
    rng = np.random.default_rng(3)
    vectors = rng.random((700, 30)) * (rng.random((700, 30)) < 0.2)
    vectors[5] = vectors[6] = vectors[400]
    vectors = vectors[np.linalg.norm(vectors, axis=1) > 0]
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    index = toxicity.BlockMaxIndex(vectors)
    for _ in range(50):
        terms = rng.choice(30, 4, replace=False)
        weights = rng.random(4)
        cos = vectors[:, terms] @ weights
        want = np.lexsort((np.arange(len(cos)), -np.round(cos, 12)))[:15]
        ids, got = index.nearest(terms, weights, 15)
        assert ids.tolist() == want[cos[want] > 0].tolist()
        assert np.allclose(got, cos[ids])


def test_toxicity_on_held_out_rows(spark):
    folder = SF_SMALL.replace("0.001", "0.1")
    docs, labels = read(spark, folder, "documents"), read(spark, folder, "labels")
    got = toxicity.toxicity(docs, labels).join(labels, "doc_id").toPandas()
    held = got[got.held_out]
    assert (held.predicted == held.toxic).mean() > 0.95
    assert held[held.toxic == 1].predicted.mean() > 0.8
    assert ((held.score - held.toxic) ** 2).mean() < 0.05


def test_toxicity_edge_cases(spark, edge, none):
    labels = spark.createDataFrame([(i, 0, int(i % 3 == 0)) for i in range(60)] + [(None, 0, 1), (61, None, None), (70, 1, 7)],
                                   "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(edge, labels).collect()
    assert len(got) == edge.count() and all(0 <= r["score"] <= 1 for r in got)
    one_class = toxicity.toxicity(edge, labels.filter("toxic = 0")).collect()
    assert {r["score"] for r in one_class} == {0.0}
    assert toxicity.toxicity(none, labels).count() == 0
    assert {r["score"] for r in toxicity.toxicity(edge, labels.limit(0)).collect()} == {0.0}


def test_an_id_that_repeats_teaches_once(spark):
    rows = [(i, "bad awful text" if i % 2 else "kind words here") for i in range(80)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)], "doc_id long, toxic int")
    once = spark.createDataFrame(rows, "doc_id long, text string")
    hot = next(i for i, _ in rows if i % 2 and zlib.crc32(str(i).encode()) % 5)
    often = spark.createDataFrame(rows + [(hot, "bad awful text")] * 500, "doc_id long, text string")
    assert toxicity.learn(often, labels).ids.tolist() == toxicity.learn(once, labels).ids.tolist()


def test_rare_words_of_a_class_are_in_the_index(spark):
    """Each toxic word is in about eight examples of 1,200, and there are 150 of them."""
    rng = np.random.default_rng(8)
    rows = [(i, " ".join([f"w{x}" for x in rng.integers(0, 50, 8)] + ([f"bad{i // 2 % 150}"] if i % 2 else [f"ok{i // 2 % 150}"])))
            for i in range(3_000)]
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, toxic int")
    got = toxicity.toxicity(spark.createDataFrame(rows, "doc_id long, text string"), labels).filter("held_out").collect()
    assert np.mean([r["predicted"] == r["doc_id"] % 2 for r in got]) > 0.95


def test_lengths_are_those_of_all_words(spark):
    rows = [(i, "vile " + " ".join(f"x{i}y{j}" for j in range(i))) for i in range(0, 40, 2)] + [(i, "kind") for i in range(1, 40, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.learn(docs, spark.createDataFrame([(i, 1 - i % 2) for i, _ in rows], "doc_id long, toxic int"))
    ids, cos = model.index.nearest(np.array([model.number[b"vile"]]), np.ones(1), 9)
    assert model.ids[ids].tolist() == sorted(i for i in model.ids.tolist() if i % 2 == 0)[:9]
    assert (np.diff(cos) < 0).all()
    assert len(model.number) == len({w for i, t in rows if i in model.ids for w in t.split()})


def plain_scores(rows, labels):
    """Every score by all cosines, without an index: id -> score."""
    label = {i: y for i, y in labels if y in (0, 1) and zlib.crc32(str(i).encode()) % 5}
    found = [(i, Counter(toxicity.words_of(t or ""))) for i, t in rows]
    df = Counter(w for _, c in found for w in c)
    examples = [(i, c, label[i]) for i, c in found if i in label]
    n = [sum(y == v for _, _, y in examples) for v in (0, 1)]

    def phi2(w):
        a, b = (sum(w in c for _, c, y in examples if y == v) for v in (0, 1))
        spread = (a + b) * (n[0] + n[1] - a - b) * n[0] * n[1]
        return (a * (n[1] - b) - b * (n[0] - a)) ** 2 / spread if spread else 0.0

    weight = {w: math.log((1 + len(rows)) / (1 + df[w])) * (1 + toxicity.CLASS_WEIGHT * phi2(w))
              for w in {w for _, c, _ in examples for w in c}}

    def vector(c):
        v = {w: (1 + math.log(x)) * weight[w] for w, x in c.items() if w in weight}
        length = math.sqrt(sum(x * x for x in v.values()))
        return {w: x / length for w, x in v.items()} if length else {}

    known = sorted((i, vector(c), y) for i, c, y in examples)
    out = {}
    for i, c in found:
        q = vector(c)
        near = sorted((-round(sum(x * e.get(w, 0.0) for w, x in q.items()), 12), at) for at, (_, e, _) in enumerate(known))
        votes = [(-far, known[at][2]) for far, at in near[:toxicity.NEIGHBOURS] if far < 0]
        out[i] = sum(f * y for f, y in votes) / sum(f for f, _ in votes) if votes else None
    return out


def test_scores_equal_the_plain_version(spark):
    rng = np.random.default_rng(12)
    rows, labels = [], []
    for i in range(260):
        y = int(i % 3 == 0)
        words = [f"t{i % 4}w{x}" for x in rng.zipf(1.4, rng.integers(5, 60)) % 60]
        words += [f"bad{x}" for x in rng.integers(0, 12, 2 * y)]
        rows.append((i, " ".join(words)))
        labels.append((i, y))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in toxicity.toxicity(docs, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()}
    for i, want in plain_scores(rows, labels).items():
        assert want is not None and got[i] == pytest.approx(want, abs=1e-9)


def test_blocks_that_cannot_win_are_not_read():
    """Topics of their own words: what is far from the query's topic stays unread."""
    rng = np.random.default_rng(13)
    topics = np.repeat(np.arange(40), 50)
    own = rng.integers(0, 30, (2_000, 12)) + 30 * topics[:, None]  # a topic's words
    common = 1_200 + rng.integers(0, 40, (2_000, 25))  # words of all topics, worth little
    vectors = np.zeros((2_000, 1_240))
    for words, worth in ((own, 1.0), (common, 0.15)):
        np.put_along_axis(vectors, words, rng.uniform(0.5, 1, words.shape) * worth, axis=1)
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    index = toxicity.BlockMaxIndex(vectors)
    for i in range(0, 2_000, 37):
        terms = np.flatnonzero(vectors[i])
        ids, cos = index.nearest(terms, vectors[i][terms], 15)
        every = vectors @ vectors[i]
        assert ids.tolist() == np.lexsort((np.arange(2_000), -np.round(every, 12)))[:15].tolist()
    assert index.read < 0.35 * index.had


def test_examples_are_bounded_in_bytes(spark, monkeypatch):
    rows = [(i, ("bad " if i % 2 else "kind ") * (i + 1)) for i in range(60)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    monkeypatch.setattr(toxicity, "EXAMPLE_BYTES", 200)
    monkeypatch.setattr(toxicity, "CLASS_BYTES", 900)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.learn(docs, labels)
    size = {i: len(t) for i, t in rows}
    assert max(size[i] for i in model.ids.tolist()) <= 200
    assert all(sum(size[i] for i in model.ids.tolist() if i % 2 == c) <= 900 for c in (0, 1)) and len(model.ids) > 4
    assert toxicity.toxicity(docs, labels).count() == 60  # all are scored


# --- personal data -----------------------------------------------------------
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text):
    def fits(kind, s):
        digits = re.sub("[^0-9]", "", s)
        if kind == "ip":
            return all(int(x) <= 255 for x in s.split("."))
        if kind == "card":
            odd, even = digits[-1::-2], digits[-2::-2]
            total = sum(map(int, odd)) + sum(sum(divmod(2 * int(c), 10)) for c in even)
            return 12 <= len(digits) <= 19 and total % 10 == 0
        return kind == "email" or 9 <= len(digits) <= 15

    found = [(m.start(), i, m.end(), kind) for i, kind in enumerate(pii.KINDS)
             for m in re.finditer(PLAIN[kind], text) if fits(kind, m.group())]
    return [(s, e, k) for s, _, e, k in sorted(found)]


@pytest.mark.parametrize("text", [
    "", f"{EMAIL} {PHONE} {CARD} {IP}", "a@b.c@d.e.f x@@y.z @q.r .@a-.-", "1.2.3.4.5.6.7.8 0000255.1.1.01 1.2.3 256.1.1.1",
    "4111-1111 1111-1111x41111111111111110 1 2 3", "+1 2 +12345678 +1(234)567-89- ++49 30 1234567.", "a@b..c a@b.c. %@x.y",
    "1-1-1-1.2.3.4", "١٢@ä.de +١ 23456789 xä@b.de"])
def test_base_spans_equal_the_plain_patterns(text):
    assert pii.base_spans(text) == plain_spans(text)


def test_pii_base_equals_brute_force(spark, edge, none):
    for docs in (read(spark, SF_SMALL, "documents"), edge.filter("doc_id is null or doc_id <> 70")):
        got = pii.extract(docs).collect()
        want = Counter()
        for r in docs.collect():
            spans = plain_spans(r["text"] or "")
            n = Counter(k for _, _, k in spans)
            want[(r["doc_id"], *(n[k] for k in pii.KINDS), hashlib.sha256(pii.join_spans(spans).encode()).hexdigest())] += 1
        assert Counter((r["doc_id"], r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"]) for r in got) == want
        for r in got:
            assert r["n_found"] > 0 or hashlib.sha256(r["spans"].encode()).hexdigest() == r["base_sha256"]
    assert pii.extract(none).count() == 0
    assert pii.extract(edge).count() == edge.count()  # row 70: long runs that a plain search would try again and again


def test_patterns_discover_what_no_format_rule_knows(spark):
    rows = [(i, f"alpha beta please call me on +1 (212) 555-01{i:02d} before noon {i}") for i in range(8)]
    rows += [(20, "you may call me on 555-0199-77 before noon"), (21, "we met on 2024-0199-77 at noon")]
    rows += [(30 + i, "walk on grass and see me at noon") for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["spans"] for r in pii.extract(docs).collect()}
    assert got[20] == "phone:19:30" and got[21] == "" and got[30] == ""
    assert got[3].startswith("phone:") and "," not in got[3]
    clean = {r["doc_id"]: r["text"] for r in pii.mask(docs).collect()}
    assert clean[20] == "you may call me on [PHONE] before noon" and clean[30] == rows[-1][1]


def test_contexts_are_whole_words_and_a_word_is_a_slot_once():
    text = f"write to {EMAIL}, or {EMAIL};{EMAIL} now or 4111 1111 1111 1111 later"
    places = pii.candidates(text, pii.base_spans(text))
    words = re.findall(pii._WORD, text)
    left, around = (k.view(np.int64).tolist() for k in pii._keys([pii._hash(w) for w in words]))
    at = [words.index(f"{EMAIL},"), words.index(f"{EMAIL};{EMAIL}"), words.index("4111")]
    assert pii.place_patterns(text, places) == [
        [left[at[0]], around[at[0]]], [left[at[1]], around[at[1]]], [], [left[at[2]]]]
    assert pii.place_patterns("", []) == []


def test_one_long_word_of_many_entities_is_read_once():
    for piece in ("a@b.co,", "1.2.3.4;"):
        places = pii.candidates(piece * 50_000, pii.base_spans(piece * 50_000))
        assert len(places) == 50_000
        assert sum(map(len, pii.place_patterns(piece * 50_000, places))) == 2


def test_masking_keeps_rows_and_columns(edge):
    got = pii.mask(edge)
    assert got.dtypes == edge.dtypes and got.count() == edge.count()
    text = {r["doc_id"]: r for r in got.collect()}
    assert text[69]["text"].startswith("[PHONE], [CARD]. [IP] 300.1.1.1") and text[69]["n_chars"] == len(text[69]["text"])
    assert text[60]["text"] is None and text[3]["text"].endswith("Contact us at [EMAIL] today.")
    assert pii.masked("abcdef", "ip:1:3,card:2:5") == "a[IP]f"


# --- the pattern graph -------------------------------------------------------
def plain_finds(rows, hops=pii.HOPS):
    """What the patterns add, text by text, with words instead of hashes: (id, start, end, kind)."""
    def norm(w):
        return re.sub("[0-9]", "0", w.lower())

    laid = []
    for i, text in rows:
        spans = [m.span() for m in pii._WORD.finditer(text)]
        words = [text[a:b] for a, b in spans]
        ctx = [norm(w) for w in words]
        at = lambda j, ctx=ctx: ctx[j] if 0 <= j < len(ctx) else None
        cores = [w.strip(pii._EDGE).lower() for w in words]
        seeds = pii.candidates(text, pii.base_spans(text))
        laid.append((i, text, spans, at, cores, seeds))

    def slots_of(entry):
        _, _, spans, at, cores, _ = entry
        for j in range(len(spans)):
            yield ("L", at(j - 2), at(j - 1)), j, 1
            for n in range(1, pii.MAX_RUN + 1):
                if j + n <= len(spans):
                    yield ("A", at(j - 1), at(j + n)), j, n

    edges, seed_places = Counter(), []
    for entry in laid:
        i, text, spans, at, _, seeds = entry
        free = 0
        for start, end, inst, kind in sorted(seeds, key=lambda x: x[:2]):
            first = max(j for j, (a, _) in enumerate(spans) if a <= start)
            last = max(j for j, (a, _) in enumerate(spans) if a < end)
            if first < free:
                continue
            free = last + 1
            own = [("L", at(first - 2), at(first - 1))] + ([("A", at(first - 1), at(last + 1))] if last - first < pii.MAX_RUN else [])
            seed_places.append((i, start, end, kind, own))
            for p in own:
                edges[p, ("seed", inst), kind] += 1
    total = Counter(p for entry in laid for p, _, _ in slots_of(entry))

    def kind_of(pairs):  # (kind, weight) -> the heaviest, first by name
        w = Counter()
        for k, n in pairs:
            w[k] += n
        return min(w, key=lambda k: (-w[k], k))

    def inner(entry, j, n):
        a, b = entry[2][j][0], entry[2][j + n - 1][1]
        return pii._inner(entry[1], a, b)

    slots, looked = [], set()
    for _ in range(hops):
        insts, held = defaultdict(dict), Counter()
        for (p, inst, kind), n in edges.items():
            insts[p].setdefault(inst, set()).add(kind)
            held[p] += n
        promising = {p for p in insts if len(insts[p]) >= pii.MIN_SEEDS and held[p] >= pii.MIN_START * total[p]}
        fresh = promising - looked
        if not fresh:
            break
        looked |= fresh
        for entry in laid:
            for p, j, n in slots_of(entry):
                if p in fresh and all(entry[4][j:j + n]):
                    a, b = inner(entry, j, n)
                    if not any(s < b and a < e for s, e, _, _ in entry[5]):
                        slots.append((entry[0], a, b, ("run", *entry[4][j:j + n]), p))
        wanted = {s[3] for s in slots}
        contexts = defaultdict(Counter)
        for entry in laid:
            for j in range(len(entry[2])):
                for n in range(1, pii.MAX_RUN + 1):
                    run = ("run", *entry[4][j:j + n])
                    if j + n <= len(entry[2]) and run in wanted:
                        at = entry[3]
                        contexts[run][("L", at(j - 2), at(j - 1)) if n == 1 else None, ("A", at(j - 1), at(j + n))] += 1
        known = {inst for _, inst, _ in edges}
        graph = Counter((s[4], s[3]) for s in slots if s[3] not in known)
        sure = {p: min(1.0, held[p] / total[p]) for p in promising}
        for _ in range(pii.ROUNDS):
            good = {p: c for p, c in sure.items() if c >= pii.MIN_CONFIDENCE}
            rel = {i: sum(n * (good.get(b, 0) if a is None else (good.get(a, 0) + good.get(b, 0)) / 2) for (a, b), n in c.items()) / sum(c.values())
                   for i, c in contexts.items() if i not in known}
            sure = {p: min(1.0, (held[p] + sum(n * rel[i] for (q, i), n in graph.items() if q == p)) / total[p]) for p in promising}
        accepted = {p: kind_of((k, 1) for inst, kinds in insts[p].items() for k in kinds) for p, c in sure.items() if c >= pii.MIN_CONFIDENCE}
        learned = {}
        for i, r in rel.items():
            pairs = [(accepted[s[4]], 1) for s in slots if s[3] == i and s[4] in accepted]
            if r >= pii.MIN_RELIABLE and pairs:
                learned[i] = kind_of(pairs)
        if not learned:
            break
        for i, kind in learned.items():
            for (a, b), n in contexts[i].items():
                for p in (a, b):
                    if p is not None:
                        edges[p, i, kind] += n
    insts, held, weights = defaultdict(set), Counter(), defaultdict(list)
    for (p, inst, kind), n in edges.items():
        insts[p].add(inst)
        held[p] += n
        weights[p].append((kind, 1))
    last = {p: (min(1.0, held[p] / total[p]), kind_of(weights[p])) for p in insts if len(insts[p]) >= pii.MIN_SEEDS}
    last = {p: v for p, v in last.items() if v[0] >= pii.MIN_CONFIDENCE}
    reliable = {inst for _, inst, _ in edges}
    marks = {}
    for i, a, b, inst, p in slots:
        if inst in reliable and p in last:
            marks.setdefault((i, a, b), []).append((*last[p], last[p][1]))
    for i, a, b, kind, own in seed_places:
        if kind == pii.SECRET:
            for p in own:
                if p in last:
                    marks.setdefault((i, a, b), []).append((*last[p], pii.SECRET))
    out, free = [], {}
    for (i, a, b), kinds in sorted(marks.items(), key=lambda m: (m[0][0], m[0][1], -m[0][2])):
        if a >= free.get(i, 0):
            out.append((i, a, b, max(kinds)[2]))
            free[i] = b
    return out


def finds(df, **options):
    """The spans that are no base entities."""
    out = []
    for r in pii.extract(df, **options).collect():
        n = r["n_email"] + r["n_ip"] + r["n_card"] + r["n_phone"]
        every = [(x.split(":")[0], int(x.split(":")[1]), int(x.split(":")[2])) for x in r["spans"].split(",") if x]
        assert len(every) - n == r["n_found"]
        base = {(k, s, e) for s, e, k in plain_spans(r["text"])} if "text" in r else None
        out += [(r["doc_id"], s, e, k) for k, s, e in every if base is None or (k, s, e) not in base]
    return sorted(out)


def without_base(rows, found):
    base = {(i, s, e, k) for i, t in rows for s, e, k in plain_spans(t)}
    return sorted(f for f in found if f not in base)


@pytest.mark.parametrize("seed", range(4))
def test_finds_equal_the_plain_graph(spark, seed):
    rng = np.random.default_rng(seed)
    names = [f"{a}{b}" for a in ("Ann", "Bo", "Cy", "Di") for b in ("", " Lee", "mar")]
    frames = ["please write to {} or call", "the account of {} was closed", 'token = "{}" set', "user {} logged in", "see {} there", "{}"]
    rows = []
    for i in range(60):
        parts = []
        for _ in range(rng.integers(1, 5)):
            thing = rng.choice([rng.choice(names), f"u{rng.integers(0, 9)}@mail.example.com", f"10.0.0.{rng.integers(1, 30)}", "nothing",
                                "".join(rng.choice(list("0123456789abcdef"), 40)), f"ID{rng.integers(0, 40)}x"])
            parts.append(rng.choice(frames).format(thing))
        rows.append((i, " ".join(parts)))
    rows += [rows[0], rows[1]]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for hops in (1, 3):
        got = set(without_base(rows, finds(docs, hops=hops)))  # the plain version names a repeated row once
        want = set(plain_finds(rows, hops))
        assert got == want, (hops, got ^ want)
    assert want  # something is found beyond the formats


def test_credentials_are_found_where_a_pattern_confirms_them(spark):
    rng = np.random.default_rng(1)
    keys = ["".join(rng.choice(list("0123456789abcdef"), 40)) for _ in range(12)]
    rows = [(i, f'w{i} x{i} token = "{k}" y{i}') for i, k in enumerate(keys)]
    rows += [(20, 'some token = "short-One" there'), (21, f"checksum{20} of it {keys[0][::-1]} z"), (22, "a token of thanks = none")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = finds(docs)
    assert [(i, k) for i, _, _, k in got] == [*[(i, "secret") for i in range(12)], (20, "secret")]
    text = dict(rows)
    assert {text[i][s:e] for i, s, e, _ in got} == {*keys, "short-One"}
    assert "[SECRET]" in {r["doc_id"]: r["text"] for r in pii.mask(docs).collect()}[20]


def test_finds_induce_further_patterns(spark):
    """Phones mark what is called on; of those, names that also sign letters mark who signs."""
    rows = [(100 + i, f"q{i} please call me on +1 (212) 555-01{i:02d} before noon {i}") for i in range(16)]
    rows += [(20 + i, f"v{i} please call me on code{c} before noon") for i, c in enumerate("ABCDE")]
    rows += [(30 + i, f"letter {i}{i} signed by code{c} with care r{i}") for i, c in enumerate("ABCDEXY")]
    rows += [(50 + i, f"grass {i} grows on walls till noon s{i}") for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    text = dict(rows)

    def words(hops):
        return {(i, text[i][s:e]) for i, s, e, _ in without_base(rows, finds(docs, hops=hops))}

    first = {(20 + i, f"code{c}") for i, c in enumerate("ABCDE")}
    assert not words(1) & {(35, "codeX"), (36, "codeY")}
    assert words(3) >= {(35, "codeX"), (36, "codeY")}
    assert not any(50 <= i < 60 for i, _ in words(3))
    assert first <= words(1) and first <= words(3)


def test_a_bitmap_has_all_and_little_else(spark):
    wanted = spark.range(5_000).select(F.xxhash64("id").alias("pattern"))
    bitmap = pii.Bitmap(wanted, "pattern")
    keys = np.array([r[0] for r in wanted.collect()], np.int64).view(np.uint64)
    assert bitmap.has(keys).all() and bitmap.bits >= 16
    assert bitmap.has(np.random.default_rng(0).integers(0, 1 << 63, 200_000, np.uint64)).mean() < 0.001
