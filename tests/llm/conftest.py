"""Small tables with every defined edge case: nulls in any column, empty and very
long texts, ties, repeated rows, clashing extra columns."""

import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, shard int, lane long, word string"
WORDS = {
    "en": "the of and to in that it is was for on are with as they be at one have this from".split(),
    "de": "der die und das nicht von sie ist des sich mit dem dass er es ein ich auf so eine auch".split(),
}
EMAIL, PHONE, CARD, IP = "ann.b@mail1.example.com", "+1 (212) 555-0147", "4111 1111 1111 1111", "10.0.255.7"


def sentence(rng, lang, n):
    return " ".join(rng.choice(WORDS[lang]) for _ in range(n))


def edge_rows():
    rng = random.Random(5)
    rows = []
    for i in range(60):
        lang = "en" if i % 2 else "de"
        text = f"Nr {i} " + sentence(rng, lang, rng.randrange(12, 60)) + f"\nContact us at {EMAIL} today."
        rows.append((i, text, lang, f"src{i % 4}", len(text)))
    rows += [
        (60, None, "en", "src0", None), (61, "", "en", "src0", 0), (62, " \t\n ", None, None, 4),
        (63, "1234 !! ??", "de", "src1", 10), (None, "no id here at all", "en", "src1", 17),
        (None, None, None, None, None), (64, "word", "en", "src2", 4), (64, "word", "en", "src2", 4),
        (65, sentence(rng, "en", 40_000), "en", "src3", None), (66, rows[5][1], "de", None, 1),
        (67, rows[5][1].upper(), "de", "src1", 1), (68, "äö\U0001f600 café   x" * 9, "de", "src2", 3),
        (69, f"{PHONE}, {CARD}. {IP} 300.1.1.1 4111111111111112 a@b", "en", "src0", 5),
        (70, "-" * 5_000 + "9" * 5_000 + "@" * 50 + "a." * 3_000, "en", "src1", 5),
    ]
    return [(*r, 1, 2, 3, "x") for r in rows]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(edge_rows(), DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)
