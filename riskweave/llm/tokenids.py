"""Token ids of whole texts, written to files of independent blocks and read back.

Documents go to range partitions in ascending order of their id; a task encodes its texts,
appends the end id to each and writes the ids through the context-mixing range coder
(``rangecoder``). Rows with equal ids are spread by a row number, so a hot id fills no
task. Files are Parquet files whose rows are chunks: ``part`` and ``chunk`` give the order, ``before`` the ids
of the part that come first, ``doc_id`` and ``n_tokens`` the documents inside, ``data`` the
coded blocks, each decodable on its own and checked by its crc32. Spark's own writer
commits them, so a lost executor leaves no half file. A chunk holds whole documents,
about ``CHUNK_IDS`` ids; a longer document is a chunk of its own.

The tokenizer drops white space, and none of its pieces reaches over a space. So a task
encodes every word between spaces once and keeps its ids in a table of bounded size; signs
behind a word are words of their own, and words of Latin letters go straight to the
tokenizer's model, where the tokenizer's own answers show that nothing differs.
``whole_texts`` encodes text by text instead, for tokenizers that need it.

Reading shuffles nothing: chunks are decoded where they lie, and the ids before a part are
sums over the parts (one row for each writing task).

Defined cases: a null or empty text has the end id alone; null doc_ids come last; rows with
equal doc_ids lie next to each other in any order; a very long text is held by its task as
a whole, the coder takes its blocks in groups of bounded size; an empty table gives an
empty table; further columns are ignored. A damaged block is an error when it is read.
"""

from __future__ import annotations

import os
import string
import uuid
import zlib
from array import array
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import rangecoder
from .common import checkpointed, longs, record, remove, shared_folder

TOKENIZER = "word_bpe_49k.json"
END_ID = 2
CHUNK_IDS = rangecoder.LANES * rangecoder.BLOCK_IDS  # as many blocks as are coded side by side
TEXTS_CHARS = 1 << 21  # characters of texts that are encoded together, unless one is longer
CACHE_WORDS = 1 << 19
CACHE_CHARS = 1 << 25


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class _Table(dict):
    """For ``str.translate``: a character without an entry becomes 0."""

    def __missing__(self, key: int) -> str:
        return "\0"


def _pieces(flat: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pieces of ``flat`` behind each other, and where each begins (and the last ends)."""
    total = np.append(0, np.cumsum(size))
    return flat[np.arange(total[-1]) + np.repeat(first - total[:-1], size)], total


class Encoder:
    """Texts to ids through a tokenizer file, with a table of the words it has met."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.vocabulary = max(self.tokenizer.get_vocab(with_added_tokens=True).values(), default=0) + 1
        self._ask()
        self._forget()

    def _ask(self) -> None:
        """What shortens the way, as far as this tokenizer itself answers so: ``letters`` are Latin letters
        and what its model sees of them, ``tails`` signs that it always parts from a letter or digit before them."""
        own = self.tokenizer
        added = [t.content for t in own.get_added_tokens_decoder().values()]
        normal = own.normalizer.normalize_str if own.normalizer else str
        parts = own.pre_tokenizer.pre_tokenize_str if own.pre_tokenizer else lambda text: [(text, (0, len(text)))]
        self.letters = _Table()
        for c in filter(str.isalpha, map(chr, range(0x250))):
            seen = [p for p, _ in parts(normal(f"e{c}{c}n"))]
            one = [p for p, _ in parts(normal(c))]
            if len(one) == 1 and seen == [f"e{one[0]}{one[0]}n"] and not any(map(str.isalpha, added)):
                self.letters[ord(c)] = one[0]
        self.ends = {chr(c) for c in self.letters}
        if self.letters:
            self.ends |= set(string.digits)
        self.tails = "".join(
            c for c in string.punctuation if c != "'" and not any(c in t for t in added)
            and all([at for _, at in parts(normal(f"{w}{c}{c}"))] == [(0, 1), (1, 3)] for w in ("a", "Z", "7", "\u00e9")))

    def _forget(self) -> None:
        self.number: dict[str, int] = {"": 0}
        self.chars = 0
        self.start, self.flat = np.zeros(2, np.int64), np.zeros(0, np.int32)

    def _learn(self, words: list[str]) -> None:
        seen = [w.translate(self.letters) for w in words]
        rest = iter(self.tokenizer.encode_batch_fast([w for w, s in zip(words, seen, strict=True) if "\0" in s], add_special_tokens=False))
        tokens = self.tokenizer.model.tokenize
        found, ends = array("i"), []  # flat, since Python's garbage collector goes through lists again and again
        for s in seen:
            found.extend(next(rest).ids if "\0" in s else [t.id for t in tokens(s)])
            ends.append(len(found))
        self.number.update(zip(words, range(len(self.start) - 1, len(self.start) - 1 + len(words)), strict=True))
        self.start = np.append(self.start, self.start[-1] + np.array(ends, np.int64))
        self.flat = np.append(self.flat, np.array(found, np.int32))
        self.chars += sum(map(len, words))

    def _numbers(self, words: list[str]) -> np.ndarray:
        found = np.fromiter(map(self.number.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(found < 0)
        if len(new):
            some = [words[i] for i in new.tolist()]
            self._learn(list(dict.fromkeys(some)))
            found[new] = [self.number[w] for w in some]
        return found

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of distinct words, where each word's begin and the last's end)."""
        cores = pc.utf8_rtrim(words, characters=self.tails) if self.tails else words
        cut = np.flatnonzero(pc.not_equal(pc.binary_length(cores), pc.binary_length(words)).to_numpy(zero_copy_only=False))
        cores, at, tails = cores.to_numpy(zero_copy_only=False).tolist(), [], []
        for i, word in zip(cut.tolist(), words.take(pa.array(cut)).to_numpy(zero_copy_only=False).tolist(), strict=True):
            if cores[i][-1:] in self.ends:
                at.append(i)
                tails.append(word[len(cores[i]):])
            else:
                cores[i] = word
        both = np.zeros((len(cores), 2), np.int64)
        both[:, 0], both[at, 1] = self._numbers(cores), self._numbers(tails)
        both = both.reshape(-1)
        first = self.start[both]
        ids, total = _pieces(self.flat, first, self.start[both + 1] - first)
        return ids, total[::2]

    def encode(self, some: list[str] | pa.Array, end_id: int = END_ID) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each with the end id behind; how many each has)."""
        if len(self.number) > CACHE_WORDS or self.chars > CACHE_CHARS:
            self._forget()
        split = pc.split_pattern(pc.replace_substring(some if isinstance(some, pa.Array) else pa.array(some, pa.string()), "\n", " "), " ")
        words = split.flatten().dictionary_encode()
        own, start = self._words(words.dictionary)
        at = words.indices.to_numpy()
        first = start[at]
        found, total = _pieces(own, first, start[at + 1] - first)
        per_text = np.diff(total[split.offsets.to_numpy() - split.offsets[0].as_py()])
        ids = np.full(len(found) + len(some), end_id, np.int32)
        # every text before moves the ids by its end id
        ids[np.arange(len(found)) + np.repeat(np.arange(len(some)), per_text)] = found
        return ids, per_text + 1

    def encode_whole(self, some: list[str] | pa.Array, end_id: int = END_ID) -> tuple[np.ndarray, np.ndarray]:
        """The same, each text in one call."""
        some = some.to_pylist() if isinstance(some, pa.Array) else some
        found = [np.append(np.array(e.ids, np.int32), np.int32(end_id)) for e in self.tokenizer.encode_batch_fast(some, add_special_tokens=False)]
        return np.concatenate([np.zeros(0, np.int32), *found]), np.array([len(f) for f in found], np.int64)


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """A Python worker's own encoder; it outlives the task."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _portions(sizes: list[int], limit: int):
    """Slices of at most ``limit`` characters, or of one longer text."""
    at = 0
    while at < len(sizes):
        end, chars = at, 0
        while end < len(sizes) and (end == at or chars + sizes[end] <= limit):
            chars += sizes[end]
            end += 1
        yield slice(at, end)
        at = end


def write(docs: DataFrame, folder: str, path: str | None = None, end_id: int = END_ID, whole_texts: bool = False,
          chunk_ids: int = CHUNK_IDS) -> None:
    """Write the ids of ``docs`` (doc_id, text) to ``folder``, a new one."""
    path = path or tokenizer_path()
    kind = dict(docs.dtypes)["doc_id"]
    row = F.monotonically_increasing_id()
    ordered = (docs.select("doc_id", "text", row.alias("row"))
               .repartitionByRange(F.asc_nulls_last("doc_id"), F.asc("row"))
               .sortWithinPartitions(F.asc_nulls_last("doc_id"), "row"))

    def run(batches):
        own = encoder(path)
        encode = own.encode_whole if whole_texts else own.encode
        part, chunk, before = TaskContext.get().partitionId(), 0, 0
        held: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []
        n = 0

        def close():
            ids = np.concatenate([h[1] for h in held])
            length = np.concatenate([h[2] for h in held])
            lists = [pa.ListArray.from_arrays(pa.array([0, len(length)], pa.int32()), x)
                     for x in (pa.concat_arrays([h[0] for h in held]), longs(length))]
            held.clear()  # the coder needs the room
            data = rangecoder.encode(ids, max(own.vocabulary, end_id + 1))
            return record(part=pa.array([part], pa.int32()), chunk=longs([chunk]), before=longs([before]),
                          n_ids=longs([len(ids)]), doc_id=lists[0], n_tokens=lists[1], data=pa.array([data], pa.binary()))

        for batch in batches:
            some = pc.fill_null(batch.column("text"), "")
            for portion in _portions(pc.utf8_length(some).to_pylist(), min(TEXTS_CHARS, chunk_ids)):
                ids, length = encode(some[portion], end_id)
                of = batch.column("doc_id")[portion]
                if held and n + len(ids) > chunk_ids:
                    yield close()
                    chunk, before, n = chunk + 1, before + n, 0
                held.append((of, ids, length))
                n += len(ids)
        if held:
            yield close()

    schema = (f"part int, chunk long, before long, n_ids long, doc_id array<{kind}>, n_tokens array<long>, data binary")
    ordered.select("doc_id", "text").mapInArrow(run, schema).write.mode("errorifexists").option(
        "compression", "none").parquet(folder)


def read_ids(spark: SparkSession, folder: str, fn, schema: str) -> DataFrame:
    """``fn(ids, lengths)`` gives a dict of columns for the documents of a chunk; part, chunk,
    doc_id and each document's place in its part come before them."""
    stored = spark.read.parquet(folder)
    kind = dict(stored.dtypes)["doc_id"].removeprefix("array<").removesuffix(">")

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                ids = rangecoder.decode(row.column("data")[0].as_py())
                length = row.column("n_tokens").flatten().to_numpy()
                if len(ids) != length.sum():
                    raise ValueError("a chunk's documents don't add up to its ids")
                start = row.column("before")[0].as_py() + np.cumsum(length) - length
                n = len(length)
                yield record(part=pa.array(np.full(n, row.column("part")[0].as_py()), pa.int32()),
                             doc_id=row.column("doc_id").flatten(), at=longs(start), **fn(ids, length))

    return stored.select("part", "before", "doc_id", "n_tokens", "data").mapInArrow(
        run, f"part int, doc_id {kind}, at long, {schema}")


def part_starts(spark: SparkSession, folder: str) -> DataFrame:
    """part, start: the ids of all parts before (a row for each writing task)."""
    sums = spark.read.parquet(folder).groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select(F.col("part").alias("of"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))


def digests(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the files."""

    def digest(ids: np.ndarray, length: np.ndarray) -> dict[str, pa.Array]:
        raw = memoryview(ids.astype("<u4").tobytes())
        ends = 4 * np.cumsum(length)
        crc = [zlib.crc32(raw[a:b]) for a, b in zip((ends - 4 * length).tolist(), ends.tolist(), strict=True)]
        return {"n_tokens": longs(length), "ids_crc32": longs(crc)}

    rows = read_ids(spark, folder, digest, "n_tokens long, ids_crc32 long")
    starts = part_starts(spark, folder)
    return rows.join(F.broadcast(starts), F.col("part") == F.col("of")).select(
        "doc_id", (F.col("first") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def ids(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, ids (array) of every document in the files."""

    def lists(found: np.ndarray, length: np.ndarray) -> dict[str, pa.Array]:
        return {"ids": pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(length)), pa.int32()), pa.array(found, pa.int32()))}

    return read_ids(spark, folder, lists, "ids array<int>").select("doc_id", "ids")


def round_trip(docs: DataFrame, path: str | None = None, end_id: int = END_ID, whole_texts: bool = False) -> DataFrame:
    """The digests of ``docs``, from files in the shared folder that go afterwards."""
    spark = docs.sparkSession
    folder = f"{shared_folder(spark)}/token-ids-{uuid.uuid4().hex}"
    write(docs, folder, path, end_id, whole_texts)
    found = checkpointed(digests(spark, folder))
    remove(spark, folder)
    return found
