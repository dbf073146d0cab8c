"""Personal data by bootstrapped contextual extraction.

Format rules find the base entities (e-mail and IP addresses, card and phone
numbers) and credentials of well-known formats. They are the seeds. Each round:

1. The words around reliable instances induce lexical patterns: the two words before, and
   the word before with the word after (around at most ``MAX_RUN`` words). A pattern needs
   ``MIN_SEEDS`` distinct instances, and its occurrences are counted over the whole corpus.
2. Every word, or short run of words, in a slot of a promising pattern is a candidate, whatever
   it looks like. Its other occurrences are counted over the whole corpus too.
3. Spark scores the graph of patterns and instances: a pattern is as good as the share of its
   occurrences that hold reliable instances; an instance that is no seed is as reliable as
   the contexts that it occurs in, all of them, on the left and around. So a common word is
   none, wherever it stands.
4. Reliable instances induce further patterns in the next round, from all the places
   where they occur. It ends when a round finds none, or after ``HOPS`` rounds.

Candidates in slots of confident patterns, if they are reliable themselves, are the spans that the
method adds, of the pattern's kind; a credential is added only where a pattern confirms it.

The texts are read once for the seeds, and in each round for totals, slots and candidates, each only
if there is something to look for. What is looked for goes out as a bitmap of hashes whose size
follows their number (128 MB at most); its false hits fall away in joins. Places are known by two
hashes of their text, so equal texts share them.

Defined cases: a null text is empty; repeated rows are searched each on its own and
count as one instance; ties between kinds go to the first by name; of overlapping finds the
first, then the longer one stays; a very long text is one row with as many places as it holds;
an empty table gives an empty table; further input columns are ignored (and kept by ``mask``).
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, longs, map_batches, record, texts

KINDS = ("email", "ip", "card", "phone")
SECRET = "secret"  # the kind of credentials
HOPS = 3  # rounds of patterns and instances
ROUNDS = 3  # of scores within a hop
MIN_SEEDS = 3  # distinct reliable instances that a pattern needs
MIN_START = 0.3  # share of a pattern's occurrences that must hold reliable instances for its slots to be looked at
MIN_CONFIDENCE = 0.6  # of a pattern
MIN_RELIABLE = 0.4  # of an instance that is no seed: it may stand in contexts that are not known yet
MAX_RUN = 3  # words of a slot
BITMAP_BITS = (20, 30)  # of a bitmap: at least, at most
WORDS_TOGETHER = 1 << 18  # words of texts that are looked at together

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match can only begin where a run of digits does, so longer runs aren't tried again
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_EDGE = ".,;:!?\"'()[]{}<>|=&*#"
# Public formats of credentials. Hex keys, and keys with their issuers' marks.
_SECRET = re.compile(r"(?<![0-9A-Za-z])(?:[0-9A-Fa-f]{32,128}|AKIA[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{36,255}|"
                     r"sk-[0-9A-Za-z_-]{20,200}|eyJ[0-9A-Za-z_-]{8,}\.[0-9A-Za-z_-]{8,}\.[0-9A-Za-z_-]{8,})(?![0-9A-Za-z])")

Span = tuple[int, int, str]


def _emails(text: str) -> list[Span]:
    """Leftmost matches of local part, @, dotted domain. The local part is the run of
    its characters before the @, so each @ is looked at once."""
    out, free, at_before = [], 0, 0
    for m in re.finditer("@", text):
        at = m.start()
        if at < free:
            continue
        before = text[max(free, at_before):at]
        start = at - (len(before) - len(before.rstrip(_LOCAL)))
        at_before = at + 1
        if start < at and (domain := _DOMAIN.match(text, at)):
            out.append((start, domain.end(), "email"))
            free = domain.end()
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and int(part) <= 255


def base_spans(text: str) -> list[Span]:
    """Base entities by start, then kind as listed."""
    out = _emails(text) if "@" in text else []
    if _DIGIT.search(text):
        if "." in text:
            out += [(*m.span(), "ip") for m in _IP.finditer(text) if all(map(_small, m.groups()))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 12:
                digits = re.sub(r"[\x20-]", "", m.group())
                if 12 <= len(digits) <= 19 and luhn(digits):
                    out.append((*m.span(), "card"))
        if "+" in text:
            out += [(*m.span(), "phone") for m in _PHONE.finditer(text)
                    if 9 <= sum(c.isdigit() for c in m.group() if c.isascii()) <= 15]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def join_spans(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def _normal(word: str) -> str:
    return re.sub(r"[0-9]", "0", word.lower())


def _hash(word: str) -> int:
    return xxhash.xxh64_intdigest(_normal(word).encode("utf-8", "surrogatepass"), 1)


def _mixed(second: np.ndarray, before: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pattern keys of places: of the two words before, of the words around."""
    mul = np.uint64(0x9E3779B97F4A7C15)
    return ((second * mul) ^ before) * mul, ((before * mul) ^ after) * mul + np.uint64(1)


def _keys(words: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Pattern keys at each word of a text."""
    h = np.array([0, 0, *words, 0], np.uint64)  # 0: the text's edge
    return _mixed(h[:-3], h[1:-2], h[3:])


def candidates(text: str, base: list[Span]) -> list[tuple[int, int, str, str]]:
    """(start, end, instance, kind) of the seeds: base entities, and credentials that have
    a digit and a letter."""
    out = [(s, e, text[s:e].lower(), kind) for s, e, kind in base]
    if _DIGIT.search(text):
        for m in _SECRET.finditer(text):
            word = m.group()
            if not word.isdigit() and not word.isalpha():
                out.append((*m.span(), word.lower(), SECRET))
    return out


def place_patterns(text: str, places: list[tuple]) -> list[list[int]]:
    """Pattern keys of each place, from the same whole words that ``count_contexts``
    counts: the two before the place's first word and, if it lies in ``MAX_RUN`` words at
    most, the words around them. A word is a slot once: a place that begins in a word of
    an earlier one has no patterns."""
    out: list[list[int]] = [[] for _ in places]
    if not places:
        return out
    spans = [m.span() for m in _WORD.finditer(text)]
    starts = [s for s, _ in spans]
    hashes: dict[int, int] = {}

    def word(i: int) -> int:
        if not 0 <= i < len(spans):
            return 0
        if i not in hashes:
            hashes[i] = _hash(text[slice(*spans[i])])
        return hashes[i]

    slots, free = [], 0
    for number in sorted(range(len(places)), key=lambda i: places[i][:2]):
        first, last = bisect_right(starts, places[number][0]) - 1, bisect_left(starts, places[number][1]) - 1
        if first >= free:
            slots.append((number, first, last))
            free = last + 1
    near = np.array([[word(first - 2), word(first - 1), word(last + 1)] for _, first, last in slots], np.uint64)
    left, around = (keys.view(np.int64).tolist() for keys in _mixed(*near.T))
    for (number, first, last), a, b in zip(slots, left, around, strict=True):
        out[number] = [a, b] if last - first < MAX_RUN else [a]
    return out


def find_occurrences(docs: DataFrame) -> DataFrame:
    """For every row: base counts, digest and spans, its seeds with their pattern keys and a
    hash of the instance, and two hashes of the text."""
    kind = dict(docs.dtypes)["doc_id"]
    place = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()),
                       ("instance", pa.int64()), ("patterns", pa.list_(pa.int64()))])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts: dict[str, list[int]] = {k: [] for k in KINDS}
        spans, digests, places = [], [], []
        for text in texts(batch):
            base = base_spans(text)
            joined = join_spans(base)
            for k in KINDS:
                counts[k].append(sum(s[2] == k for s in base))
            spans.append(joined)
            digests.append(hashlib.sha256(joined.encode()).hexdigest())
            own = []
            found = candidates(text, base)
            for (start, end, instance, name), keys in zip(found, place_patterns(text, found), strict=True):
                number = xxhash.xxh64_intdigest(instance.encode("utf-8", "surrogatepass")) - (1 << 63)
                own.append({"start": start, "end": end, "kind": name, "instance": number, "patterns": keys})
            places.append(own)
        return record(doc_id=batch.column("doc_id"), a=batch.column("a"), b=batch.column("b"),
                      **{f"n_{k}": longs(counts[k]) for k in KINDS}, base_sha256=pa.array(digests, pa.string()),
                      base=pa.array(spans, pa.string()), places=pa.array(places, pa.list_(place)))

    schema = (f"doc_id {kind}, a long, b long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, base string, "
              "places array<struct<start:long,end:long,kind:string,instance:long,patterns:array<long>>>")
    return map_batches(_keyed(docs).select("doc_id", "text", "a", "b"), run, schema)


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", "text", F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b"))


class Words:
    """The hashes of a word as context and as part of an instance, each made once."""

    def __init__(self, limit: int = 200_000):
        self.limit = limit
        self._clear()

    def _clear(self):
        self.number: dict[str, int] = {}
        self.context, self.core = np.zeros(0, np.uint64), np.zeros(0, np.uint64)

    def look(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.number) > self.limit:
            self._clear()
        if new := list(dict.fromkeys(w for w in words if w not in self.number)):
            self.number.update(zip(new, range(len(self.number), len(self.number) + len(new)), strict=True))
            self.context = np.append(self.context, np.array([_hash(w) for w in new], np.uint64))
            self.core = np.append(self.core, np.array([_core_hash(w) for w in new], np.uint64))
        at = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        return self.context[at], self.core[at]


def _core_hash(word: str) -> int:
    """Of the word without case and edge marks; 0 if nothing is left."""
    core = word.strip(_EDGE).lower()
    return xxhash.xxh64_intdigest(core.encode("utf-8", "surrogatepass"), 2) or 1 if core else 0


def _instances(core: np.ndarray, length: int) -> np.ndarray:
    """Instance keys of the runs of ``length`` words from each word on; 0 where the run has
    a word of edge marks alone. ``core`` has ``MAX_RUN`` zeros behind."""
    n = len(core) - MAX_RUN
    key, whole = np.zeros(n, np.uint64), np.ones(n, bool)
    for i in range(length):
        part = core[i:i + n]
        key = (key ^ part) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(length)
        whole &= part != 0
    return np.where(whole, key, 0)


class Laid:
    """Texts laid end to end, with the pattern keys of all slots."""

    def __init__(self, some: list[str], words: Words):
        found = [_WORD.findall(t) for t in some]
        self.count = np.array([len(f) for f in found], np.int64)
        pad = MAX_RUN + 1  # so that no slot reaches from one text into the next
        self.first = pad + np.cumsum(self.count + pad) - (self.count + pad)
        self.at = np.arange(self.count.sum()) + np.repeat(self.first - (np.cumsum(self.count) - self.count), self.count)
        size = int((self.count + pad).sum()) + 2 * pad
        self.context, self.core = np.zeros(size, np.uint64), np.zeros(size, np.uint64)
        self.context[self.at], self.core[self.at] = words.look([w for f in found for w in f])
        self.is_word = np.zeros(size, bool)
        self.is_word[self.at] = True

    def runs(self, length: int) -> np.ndarray:
        """Places where a run of that many words begins."""
        return self.at[self.is_word[self.at + length - 1]]

    def left(self, at: np.ndarray) -> np.ndarray:
        return _mixed(self.context[at - 2], self.context[at - 1], self.context[at])[0]

    def around(self, at: np.ndarray, length: int) -> np.ndarray:
        return _mixed(self.context[at], self.context[at - 1], self.context[at + length])[1]

    def text_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, at, side="right") - 1


def _together(some: list[str]):
    """Slices of texts of about WORDS_TOGETHER words, by their length."""
    at = 0
    while at < len(some):
        end, chars = at, 0
        while end < len(some) and (end == at or chars + len(some[end]) <= 6 * WORDS_TOGETHER):
            chars += len(some[end])
            end += 1
        yield slice(at, end)
        at = end


class Bitmap:
    """Which hashes may be among the wanted ones: three windows of a hash's bits, each
    a place in a bitmap of 64 bits for each wanted hash (a Bloom filter)."""

    SHIFTS = (0, 17, 34)

    def __init__(self, wanted: DataFrame, name: str):
        low, high = BITMAP_BITS
        self.bits = min(high, max(low, (64 * wanted.count()).bit_length()))
        mask = F.lit((1 << self.bits) - 1)
        places = F.explode(F.array(*[F.shiftrightunsigned(F.col(name), n).bitwiseAND(mask) for n in self.SHIFTS]))
        by_word = wanted.select(places.alias("bit")).groupBy(F.shiftright("bit", 6).alias("w")).agg(
            F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits"))
        self.words = np.zeros(1 << (self.bits - 6), np.uint64)
        for r in by_word.toLocalIterator():  # at most 2^24 rows
            self.words[r["w"]] = np.uint64(r["bits"] & (1 << 64) - 1)

    def has(self, keys: np.ndarray) -> np.ndarray:
        left = np.arange(len(keys))
        for n in self.SHIFTS:
            low = (keys[left] >> np.uint64(n)) & np.uint64((1 << self.bits) - 1)
            left = left[(self.words[low >> np.uint64(6)] >> (low & np.uint64(63))) & np.uint64(1) > 0]
        found = np.zeros(len(keys), bool)
        found[left] = True
        return found


def count_contexts(docs: DataFrame, patterns: DataFrame) -> DataFrame:
    """(pattern, total): how often each of ``patterns(pattern)`` occurs in the texts
    around any word, or run of words, at all."""
    shared = patterns.sparkSession.sparkContext.broadcast(Bitmap(patterns, "pattern"))

    def run(batches):
        wanted, words = shared.value, Words()
        for batch in batches:
            hits = [np.zeros(0, np.uint64)]
            some = texts(batch)
            for part in _together(some):
                own = Laid(some[part], words)
                for keys in (own.left(own.at), *(own.around(own.runs(n), n) for n in range(1, MAX_RUN + 1))):
                    hits.append(keys[wanted.has(keys)])
            key, n = np.unique(np.concatenate(hits), return_counts=True)
            yield record(pattern=longs(key.view(np.int64)), n=longs(n))

    counted = docs.select("text").mapInArrow(run, "pattern long, n long").groupBy("pattern").agg(F.sum("n").alias("total"))
    return counted.join(patterns, "pattern", "left_semi")


def find_slots(docs: DataFrame, patterns: DataFrame) -> DataFrame:
    """(a, b, start, end, instance, pattern, n): what stands in the slots of
    ``patterns(pattern)``, free of seeds; n rows have the text."""
    shared = patterns.sparkSession.sparkContext.broadcast(Bitmap(patterns, "pattern"))

    def run(batches):
        wanted, words = shared.value, Words()
        for batch in batches:
            some = texts(batch)
            out = {"row": [], "start": [], "end": [], "instance": [], "pattern": []}
            for part in _together(some):
                own = Laid(some[part], words)
                for length in range(1, MAX_RUN + 1):
                    at = own.runs(length)
                    key = _instances(own.core, length)[at]
                    for left in ((True, False) if length == 1 else (False,)):
                        pattern = own.left(at) if left else own.around(at, length)
                        for i in np.flatnonzero(wanted.has(pattern) & (key != 0)):
                            out["row"].append((part.start, own, int(at[i]), length))
                            out["instance"].append(int(key[i].view(np.int64)))
                            out["pattern"].append(int(pattern[i].view(np.int64)))
            rows, keep = [], []
            spans: dict[int, tuple[list, list]] = {}
            for number, (first, own, at, length) in enumerate(out["row"]):
                of = int(own.text_of(np.array([at]))[0])
                text = some[first + of]
                if first + of not in spans:
                    spans[first + of] = ([m.span() for m in _WORD.finditer(text)], candidates(text, base_spans(text)))
                every, seeds = spans[first + of]
                nth = at - int(own.first[of])
                start, end = _inner(text, every[nth][0], every[nth + length - 1][1])
                if not any(s < end and start < e for s, e, _, _ in seeds):
                    keep.append(number)
                    rows.append((first + of, start, end))
            of = pa.array([r[0] for r in rows], pa.int64())
            yield record(a=batch.column("a").take(of), b=batch.column("b").take(of), start=longs([r[1] for r in rows]),
                         end=longs([r[2] for r in rows]), instance=longs([out["instance"][i] for i in keep]),
                         pattern=longs([out["pattern"][i] for i in keep]))

    found = _keyed(docs).select("text", "a", "b").mapInArrow(
        run, "a long, b long, start long, end long, instance long, pattern long")
    return (found.join(patterns.select("pattern"), "pattern", "left_semi")
            .groupBy("a", "b", "start", "end", "instance", "pattern").agg(F.count(F.lit(1)).alias("n")))


def _inner(text: str, start: int, end: int) -> tuple[int, int]:
    """The place without the marks at its edges."""
    while start < end and text[start] in _EDGE:
        start += 1
    while start < end and text[end - 1] in _EDGE:
        end -= 1
    return start, end


def find_instances(docs: DataFrame, instances: DataFrame) -> DataFrame:
    """(instance, left, around, n): in which contexts each of ``instances(instance)``
    stands, in all texts. A run of several words has no left pattern (0), as its slot
    ends nowhere."""
    shared = instances.sparkSession.sparkContext.broadcast(Bitmap(instances, "instance"))

    def run(batches):
        wanted, words = shared.value, Words()
        for batch in batches:
            hits = [np.zeros((0, 3), np.uint64)]
            some = texts(batch)
            for part in _together(some):
                own = Laid(some[part], words)
                for length in range(1, MAX_RUN + 1):
                    at = own.runs(length)
                    key = _instances(own.core, length)[at]
                    some_hit = wanted.has(key) & (key != 0)
                    at, key = at[some_hit], key[some_hit]
                    left = own.left(at) if length == 1 else np.zeros(len(at), np.uint64)
                    hits.append(np.stack([key, left, own.around(at, length)], axis=1))
            rows, n = np.unique(np.concatenate(hits), axis=0, return_counts=True)
            rows = rows.view(np.int64)
            yield record(instance=longs(rows[:, 0]), left=longs(rows[:, 1]), around=longs(rows[:, 2]), n=longs(n))

    found = (docs.select("text").mapInArrow(run, "instance long, left long, around long, n long")
             .groupBy("instance", "left", "around").agg(F.sum("n").alias("n")))
    return found.join(instances.select("instance"), "instance", "left_semi")


def _most(kinds: DataFrame, key: str, weight: str) -> DataFrame:
    """The kind of each ``key`` with the largest ``weight``, the first by name of equals."""
    by = kinds.groupBy(key, "kind").agg(F.sum(weight).alias("w"))
    best = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("w"), "kind"))
    return by.withColumn("nth", best).filter("nth = 1").select(key, "kind")


def _scored(patterns: DataFrame, slots: DataFrame, contexts: DataFrame, rounds: int, min_confidence: float) -> tuple[DataFrame, DataFrame]:
    """(pattern, confidence) and (instance, reliability) after ``rounds`` over the graph.

    ``patterns(pattern, held, total)``: occurrences that hold seeds or earlier finds, and all;
    ``slots(pattern, instance, n)``: the others; ``contexts(instance, left, around, n)``."""
    sure = patterns.select("pattern", F.least(F.lit(1.0), F.col("held") / F.col("total")).alias("confidence"))
    found = None
    for _ in range(rounds):
        sure = checkpointed(sure)
        good = F.when(F.col("confidence") >= min_confidence, F.col("confidence")).otherwise(0.0)
        before = sure.select(F.col("pattern").alias("left"), good.alias("l"))
        beside = sure.select(F.col("pattern").alias("around"), good.alias("r"))
        # both contexts of a place count; a run of several words has the one around it
        worth = F.coalesce("r", F.lit(0.0))
        worth = F.when(F.col("left") == 0, worth).otherwise((F.coalesce("l", F.lit(0.0)) + worth) / 2)
        found = checkpointed(contexts.join(before, "left", "left").join(beside, "around", "left").groupBy("instance")
                             .agg((F.sum(F.col("n") * worth) / F.sum("n")).alias("reliability")))
        more = slots.join(found, "instance").groupBy("pattern").agg(F.sum(F.col("n") * F.col("reliability")).alias("more"))
        sure = patterns.join(more, "pattern", "left").select("pattern", F.least(
            F.lit(1.0), (F.col("held") + F.coalesce("more", F.lit(0.0))) / F.col("total")).alias("confidence"))
    return checkpointed(sure), found


def discover(rows: DataFrame, docs: DataFrame, min_seeds: int = MIN_SEEDS, min_confidence: float = MIN_CONFIDENCE,
             min_reliable: float = MIN_RELIABLE, rounds: int = ROUNDS, hops: int = HOPS) -> DataFrame:
    """(a, b, start, end, kind) of what the patterns add to the base entities of ``rows``
    (of ``find_occurrences``)."""
    seeds = checkpointed(rows.select("a", "b", F.explode("places").alias("p")).select("a", "b", "p.*"))
    # the graph's edges from reliable instances: (pattern, instance, kind, n)
    edges = (seeds.select(F.explode("patterns").alias("pattern"), "instance", "kind")
             .groupBy("pattern", "instance", "kind").agg(F.count(F.lit(1)).alias("n")))
    totals = slots = looked = contexts = None
    for _ in range(hops):
        edges = checkpointed(edges)
        induced = (edges.groupBy("pattern").agg(F.count_distinct("instance").alias("seeds"), F.sum("n").alias("held"))
                   .filter(F.col("seeds") >= min_seeds))
        induced = checkpointed(induced.join(_most(edges.withColumn("one", F.lit(1)), "pattern", "one"), "pattern"))
        new = induced.select("pattern") if totals is None else induced.select("pattern").join(totals, "pattern", "left_anti")
        new = checkpointed(new)
        if not new.isEmpty():
            counted = count_contexts(docs, new)
            totals = checkpointed(counted if totals is None else totals.unionByName(counted))
        if totals is None:
            break
        promising = checkpointed(induced.join(totals, "pattern").filter(F.col("held") >= F.col("total") * MIN_START))
        fresh = promising.select("pattern") if slots is None else promising.select("pattern").join(looked, "pattern", "left_anti")
        fresh = checkpointed(fresh)
        if fresh.isEmpty():
            break
        looked = fresh if slots is None else checkpointed(looked.unionByName(fresh))
        more = find_slots(docs, fresh)
        slots = checkpointed(more if slots is None else slots.unionByName(more))
        wanted = slots.select("instance").distinct()
        wanted = checkpointed(wanted if contexts is None else wanted.join(contexts, "instance", "left_anti"))
        if not wanted.isEmpty():
            more = find_instances(docs, wanted)
            contexts = checkpointed(more if contexts is None else contexts.unionByName(more))
        if contexts is None:
            contexts = checkpointed(wanted.select("instance", *[F.lit(0).cast("long").alias(c) for c in ("left", "around", "n")]))
        # what is reliable already counts in full, so it is no candidate again
        known = edges.select("instance").distinct()
        open_slots = slots.join(known, "instance", "left_anti").groupBy("pattern", "instance").agg(F.sum("n").alias("n"))
        sure, found = _scored(promising, checkpointed(open_slots), contexts.join(known, "instance", "left_anti"), rounds, min_confidence)
        accepted = checkpointed(sure.filter(F.col("confidence") >= min_confidence).join(promising.select("pattern", "kind"), "pattern"))
        good = checkpointed(found.filter(F.col("reliability") >= min_reliable))
        # a find is of the kind of the accepted patterns that hold it, and induces patterns wherever it stands
        kinds = _most(slots.join(good, "instance").join(accepted, "pattern"), "instance", "n")
        both = contexts.join(kinds, "instance")
        learned = checkpointed(both.select("left", "instance", "kind", "n").withColumnRenamed("left", "pattern")
                               .unionByName(both.select("around", "instance", "kind", "n").withColumnRenamed("around", "pattern"))
                               .filter("pattern <> 0")
                               .groupBy("pattern", "instance", "kind").agg(F.sum("n").alias("n")))
        if learned.isEmpty():
            break
        edges = edges.unionByName(learned)
    if slots is None:
        return rows.sparkSession.createDataFrame([], "a long, b long, start long, end long, kind string")
    # confidences after the last round, with all that was found
    edges = checkpointed(edges)
    last = (edges.groupBy("pattern").agg(F.count_distinct("instance").alias("seeds"), F.sum("n").alias("held"))
            .filter(F.col("seeds") >= min_seeds).join(totals, "pattern")
            .select("pattern", F.least(F.lit(1.0), F.col("held") / F.col("total")).alias("sure")).filter(F.col("sure") >= min_confidence))
    last = checkpointed(last.join(_most(edges.withColumn("one", F.lit(1)), "pattern", "one"), "pattern"))
    reliable = edges.select("instance").distinct()
    places = slots.join(reliable, "instance", "left_semi").select("a", "b", "start", "end", "pattern")
    secrets = (seeds.filter(F.col("kind") == SECRET).select("a", "b", "start", "end", F.explode("patterns").alias("pattern"))
               .distinct().withColumn("of", F.lit(SECRET)))
    marks = places.withColumn("of", F.lit(None).cast("string")).unionByName(secrets).join(last, "pattern")
    return marks.groupBy("a", "b", "start", "end").agg(F.max_by(F.coalesce("of", "kind"), F.struct("sure", "kind")).alias("kind"))


def extract(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_<kind>, base_sha256, spans, n_found, row: base entities and what the
    patterns found beside them (``n_found``), of every row."""
    rows = checkpointed(find_occurrences(docs))
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    order = F.array(*map(F.lit, (*KINDS, SECRET)))
    item = F.struct("start", (-F.col("end")).alias("until"), F.array_position(order, F.col("kind")).alias("order"),
                    F.concat_ws(":", "kind", "start", "end").alias("text"))
    found = checkpointed(discover(rows, docs, **options).groupBy("a", "b").agg(F.array_sort(F.collect_list(item)).alias("found")))
    # of overlapping finds, the first, then the longest
    state = "cast(struct(array(), 0L) as struct<kept:array<struct<start:long,order:long,text:string>>,free:long>)"
    kept = F.aggregate("found", F.expr(state), lambda s, x: F.when(x["start"] < s["free"], s).otherwise(F.struct(
        F.concat(s["kept"], F.array(F.struct(x["start"].alias("start"), x["order"].cast("long").alias("order"), x["text"].alias("text")))).alias("kept"),
        (-x["until"]).alias("free"))), lambda s: s["kept"])
    new = found.select("a", "b", kept.alias("new"))
    parts = F.split("base", ",")
    old = F.when(F.col("base") == "", F.expr(
        "cast(array() as array<struct<start:long,order:long,text:string>>)")).otherwise(F.transform(parts, lambda x: F.struct(
            F.split(x, ":")[1].cast("long").alias("start"),
            F.array_position(order, F.split(x, ":")[0]).cast("long").alias("order"), x.alias("text"))))
    both = F.when(F.col("new").isNull(), F.col("base")).otherwise(
        F.array_join(F.transform(F.array_sort(F.concat(old, "new")), lambda x: x["text"]), ","))
    return rows.join(new, ["a", "b"], "left").select(
        "doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", both.alias("spans"),
        F.coalesce(F.size("new"), F.lit(0)).cast("long").alias("n_found"), "row")


def masked(text: str, spans: str) -> str:
    """Each span's characters replaced by its kind; overlapping spans as one."""
    out, done = [], 0
    for item in spans.split(","):
        kind, start, end = item.split(":")
        if int(start) >= done:
            out += [text[done:int(start)], f"[{kind.upper()}]"]
        done = max(done, int(end))
    return "".join([*out, text[done:]])


def mask(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` with personal data masked in ``text`` and, where it exists,
    ``n_chars`` recounted. Rows are found again by their id and text."""
    # two hashes: with one, some documents of a very large corpus would share a key
    key = F.struct(F.xxhash64("doc_id", "text").alias("a"), F.xxhash64(F.lit(1), "doc_id", "text").alias("b"))
    keyed = docs.select(key.alias("doc_id"), "text")
    spans = (extract(keyed, **options).filter("spans <> ''").groupBy("doc_id").agg(F.max("spans").alias("__spans"))
             .withColumnRenamed("doc_id", "__key"))
    joined = docs.withColumn("__own", key).join(checkpointed(spans), F.col("__own") == F.col("__key"), "left")
    names = [*docs.columns, "__spans"]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = batch.column("__spans").to_pylist()
        old = batch.column("text").to_pylist()
        new = [t if s is None else masked(t or "", s) for t, s in zip(old, found, strict=True)]
        columns = {n: batch.column(n) for n in names[:-1]} | {"text": pa.array(new, batch.schema.field("text").type)}
        if "n_chars" in columns:
            size = [n if s is None else len(t) for n, s, t in zip(batch.column("n_chars").to_pylist(), found, new, strict=True)]
            columns["n_chars"] = pa.array(size, batch.schema.field("n_chars").type)
        return record(**columns)

    return map_batches(joined.select(*names), run, docs.schema)
