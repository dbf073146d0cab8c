"""Round trips of the range coder and of the token files."""

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from riskweave.llm import rangecoder as R
from riskweave.llm import tokenids as T
from riskweave.llm.common import shared_folder


def text_like(rng, n, vocabulary):
    """Ids with a skewed distribution and repeated passages."""
    ids = rng.zipf(1.2, n) % vocabulary
    for _ in range(n // 200):
        a, b = rng.integers(0, max(1, n - 40), 2)
        ids[a:a + 30] = ids[b:b + 30][:len(ids[a:a + 30])]
    return ids


@pytest.mark.parametrize("n,vocabulary,block", [
    (0, 10, 16), (1, 1, 16), (1, 49_408, 16), (16, 2, 16), (17, 5, 16), (5_000, 300, 64), (9_000, 49_408, 4_096), (3_000, 100_000, 999)])
def test_round_trip(n, vocabulary, block):
    rng = np.random.default_rng(n)
    for ids in (text_like(rng, n, vocabulary), rng.integers(0, vocabulary, n), np.zeros(n, np.int64),
                np.full(n, vocabulary - 1)):
        data = R.encode(ids, vocabulary, block)
        assert (R.decode(data) == ids).all()


def test_more_blocks_than_lanes(monkeypatch):
    monkeypatch.setattr(R, "LANES", 7)
    ids = text_like(np.random.default_rng(0), 5_000, 500)
    assert (R.decode(R.encode(ids, 500, 100)) == ids).all()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 40), max_size=300), st.integers(1, 50))
def test_any_ids_come_back(ids, block):
    assert R.decode(R.encode(np.array(ids, np.int64), 41, block)).tolist() == ids


def test_blocks_are_independent():
    """A block's bytes are the same wherever it lies, and decode alone."""
    a, b = (text_like(np.random.default_rng(s), 200, 300) for s in (1, 2))
    both, alone = R.encode(np.append(a, b), 300, 200), R.encode(b, 300, 200)
    words = 2 * int(np.frombuffer(alone, "<u4", 3, 16)[1])
    assert both[-words:] == alone[-words:]


def test_a_block_that_ends_early_changes_no_other():
    """Blocks leave in the midst of a span, next to longer ones."""
    rng = np.random.default_rng(8)
    blocks = [text_like(rng, n, 900) for n in (700, 700, 333, 17, 1)]
    together = R._encode_side_by_side(blocks, 900)
    assert together == [R._encode_side_by_side([b], 900)[0] for b in blocks]
    back = R._decode_side_by_side(together, list(map(len, blocks)), 900)
    assert all((a == b).all() for a, b in zip(back, blocks, strict=True))


def test_a_large_vocabulary_comes_back():
    ids = np.random.default_rng(9).integers(0, 3_000_000, 600)
    assert (R.decode(R.encode(ids, 3_000_000, 300)) == ids).all()


def test_distributions_are_mixed_for_spans_not_for_ids(monkeypatch):
    mixed, plain = [], R._Lanes._mix
    monkeypatch.setattr(R._Lanes, "_mix", lambda self: (mixed.append(1), plain(self)))
    ids = text_like(np.random.default_rng(10), 4_096, 300)
    assert (R.decode(R.encode(ids, 300)) == ids).all()
    assert 4 < len(mixed) < 60


def test_models_make_the_files_smaller():
    rng = np.random.default_rng(4)
    n, v = 40_000, 2_000
    even = len(R.encode(rng.integers(0, v, n), v))
    skewed = len(R.encode(rng.zipf(1.5, n) % v, v))  # order 0
    cycle = rng.permutation(v)[:300]
    chain = len(R.encode(np.tile(cycle, n // 300), v))  # order 1
    walk = np.tile(np.array([1, 1, 2, 1, 3, 2, 2, 3, 3]), n // 9)  # every pair is followed by one id, every id by three
    assert even < 1.45 * n * np.log2(v) / 8
    assert skewed < 0.6 * even and chain < 0.25 * even and len(R.encode(walk, v)) < 0.05 * even


def test_damage_is_found():
    data = R.encode(text_like(np.random.default_rng(5), 3_000, 500), 500, 256)
    for at in (0, 9, 17, 24, len(data) // 2, len(data) - 40):
        broken = bytearray(data)
        broken[at] ^= 0x10
        with pytest.raises(ValueError):
            R.decode(bytes(broken))
    for part in (data[:10], data[:30], data[:-2], data + b"xx", b""):
        with pytest.raises(ValueError):
            R.decode(part)
    with pytest.raises(ValueError):
        R.encode(np.array([5]), 5)


def test_words_between_spaces_encode_as_the_whole_text():
    own = T.Encoder(T.tokenizer_path())
    some = ["", " ", "  two  spaces ", "Don't we'll  <|endoftext|>x <|startoftext|>", "tab\tnew\nline\r\n\n end", "a b c\x1cd\x85e",
            "ΑΣ ΣΑΣ. İstanbul ǅ ﬁ", " ́x é 가", "1234 56,7 #2 \U0001f600‍ 你好 世界", "x" * 5_000, "12 " * 3_000]
    ids, n = own.encode(some)
    whole, m = own.encode_whole(some)
    assert ids.tolist() == whole.tolist() and n.tolist() == m.tolist()


def test_a_word_is_encoded_once_whatever_signs_follow():
    own = T.Encoder(T.tokenizer_path())
    some = ["erst erst. erst, erst... (erst) (erst)! erst's erst'", "erst?", "Ñandú ñandú. 7 7. 7% a\u0301. \u0130. \u0149! \u00aa# \u1e9e. x<|endoftext|>. <|endoftext|>,"]
    ids, n = own.encode(some)
    whole, m = own.encode_whole(some)
    assert ids.tolist() == whole.tolist() and n.tolist() == m.tolist()
    assert not {"erst.", "erst,", "erst...", "erst?", "(erst)", "ñandú.", "7%"} & own.number.keys()
    assert {"erst", "(erst", ".", "...", "ñandú"} <= own.number.keys()


@pytest.mark.parametrize("kind", ["cased", "whitespace", "letters"])
def test_other_tokenizers_are_asked_what_they_part(tmp_path, kind):
    """No short way where this tokenizer's answers don't allow it."""
    from tokenizers import AddedToken, models, pre_tokenizers

    words = ["a", "b", "A", "B", ".", "b.", "ab", "AB", "ab.", "x", "[U]"]
    other = Tokenizer(models.BPE({w: i for i, w in enumerate(words)}, [("a", "b"), ("b", "."), ("A", "B"), ("ab", ".")], unk_token="[U]"))
    if kind == "whitespace":
        other.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    elif kind == "cased":
        other.pre_tokenizer = pre_tokenizers.Whitespace()
    else:
        other.pre_tokenizer = pre_tokenizers.Whitespace()
        other.add_tokens([AddedToken("bx", normalized=False)])
    other.save(str(tmp_path / "t.json"))
    own = T.Encoder(str(tmp_path / "t.json"))
    some = ["ab. AB ab ab AB. b.", "abx bx. aB. \u00e9. 7."]
    assert own.encode(some)[0].tolist() == own.encode_whole(some)[0].tolist()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="aZé'.,!%<|>7 \u0130\u0301\u03a3中\t", max_size=30), max_size=5))
def test_any_word_with_signs_encodes_as_a_whole(some):
    own = T.encoder(T.tokenizer_path())
    assert own.encode(some)[0].tolist() == own.encode_whole(some)[0].tolist()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=5))
def test_any_text_encodes_as_a_whole(some):
    own = T.encoder(T.tokenizer_path())
    assert own.encode(some)[0].tolist() == own.encode_whole(some)[0].tolist()


def test_the_table_of_words_stays_bounded(monkeypatch):
    monkeypatch.setattr(T, "CACHE_WORDS", 50)
    own = T.Encoder(T.tokenizer_path())
    for i in range(20):
        some = [" ".join(f"w{i}x{j}" for j in range(30))]
        assert own.encode(some)[0].tolist() == own.encode_whole(some)[0].tolist()
        assert len(own.number) <= 80


def expected(rows):
    """The digests, in order of the ids; equal ids may come in any order."""
    tokenizer = Tokenizer.from_file(T.tokenizer_path())
    out, start = [], 0
    for i, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, T.END_ID], "<u4")
        out.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_files_give_every_document_back(spark, edge):
    rows = [(r["doc_id"], r["text"]) for r in edge.collect()]
    got = [tuple(r) for r in T.round_trip(edge).select("doc_id", "start", "n_tokens", "ids_crc32").collect()]
    got.sort(key=lambda r: r[1])
    want = expected(rows)
    assert [r[0] for r in got] == [r[0] for r in want]
    assert sorted(map(str, ((r[0], r[2], r[3]) for r in got))) == sorted(map(str, ((r[0], r[2], r[3]) for r in want)))
    ends = np.cumsum([r[2] for r in got])
    assert [r[1] for r in got] == [0, *ends[:-1]]  # gapless


def test_many_chunks_and_whole_ids(spark, edge, tmp_path):
    rows = [(r["doc_id"], r["text"]) for r in edge.collect() if r["doc_id"] is not None and r["doc_id"] != 64]
    docs = edge.filter("doc_id is not null and doc_id <> 64")
    folder = f"{shared_folder(spark)}/{tmp_path.name}"
    T.write(docs.repartition(40), folder, whole_texts=True, chunk_ids=300)
    assert spark.read.parquet(folder).count() > 1
    tokenizer = Tokenizer.from_file(T.tokenizer_path())
    want = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, T.END_ID] for i, t in rows}
    assert {r["doc_id"]: list(r["ids"]) for r in T.ids(spark, folder).collect()} == want
    assert sorted(map(tuple, T.digests(spark, folder).collect())) == expected(rows)


def test_empty_table(spark, none):
    got = T.round_trip(none)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and got.count() == 0
