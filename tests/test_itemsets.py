"""Itemsets of any length against brute force and FP-growth."""

from collections import Counter
from itertools import combinations

import numpy as np
import pytest

from riskweave.operators import basket as mb
from riskweave.operators import itemsets


def brute(baskets, min_support, max_len):
    n = len(baskets)
    counts = Counter()
    for b in baskets:
        own = sorted({x for x in b or () if x is not None})
        for k in range(1, (max_len or len(own)) + 1):
            counts.update(combinations(own, k))
    return {s: c for s, c in counts.items() if c / n >= min_support}


def found(df):
    return {tuple(r["itemset"]): r["count"] for r in df.collect()}


@pytest.mark.parametrize("max_len", [1, 2, 4, 5, None])
def test_levels_equal_brute_force(spark, max_len, monkeypatch):
    rng = np.random.default_rng(4)
    baskets = [[f"i{x}" for x in np.flatnonzero(rng.random(9) < 0.45)] for _ in range(300)]
    baskets += [None, [], ["i1", "i1", None, "i3"], baskets[0]]
    df = spark.createDataFrame([(b,) for b in baskets], "items array<string>")
    for sent in (10**6, 0):  # by broadcast and by shuffle
        monkeypatch.setattr(itemsets, "SENT_NODES", sent)
        assert found(itemsets.frequent_by_level(df, 0.05, max_len)) == brute(baskets, 0.05, max_len)


def test_long_itemsets_equal_fpgrowth(spark):
    rng = np.random.default_rng(5)
    baskets = [sorted({f"i{x}" for x in rng.zipf(1.6, 8) % 15}) for _ in range(400)]
    df = spark.createDataFrame([(b,) for b in baskets], "items array<string>")
    ours = mb.frequent_itemsets(df, 0.03, 6)
    assert found(ours) == found(mb.frequent_itemsets(df, 0.03, 6, method="fpgrowth"))
    assert max(map(len, found(ours))) > 3
    assert found(mb.frequent_itemsets(df, 0.03, 3)) == found(mb.frequent_itemsets(df, 0.03, 3, method="levels"))


def test_no_candidate_has_an_infrequent_subset(spark):
    baskets = [list("abc")] * 5 + [list("abd")] * 5 + [list("cd")] * 4
    df = spark.createDataFrame([(b,) for b in baskets], "items array<string>")
    got = found(itemsets.frequent_by_level(df, 5 / 14, None))
    assert got == brute(baskets, 5 / 14, None) and ("a", "b", "c", "d") not in got
    level = spark.createDataFrame([(i, list(s)) for i, s in enumerate(("ab", "ac", "ad", "bc"))], "node long, itemset array<string>")
    # a b c is left; a b d lacks b d, a c d lacks c d
    assert [r["itemset"] for r in itemsets._grown(level, 3).collect()] == [list("abc")]


def test_rules_of_four_items(spark):
    baskets = [list("abcd")] * 6 + [list("ab")] * 2 + [list("cd")] * 2 + [list("e")] * 2
    df = spark.createDataFrame([(b,) for b in baskets], "items array<string>")
    rules = mb.association_rules(mb.frequent_itemsets(df, 0.1, 4), 0.0).collect()
    four = [r for r in rules if len(r["antecedents"]) + len(r["consequents"]) == 4]
    assert len(four) == 14 and all(r["support"] == 0.5 for r in four)
    one = next(r for r in four if r["antecedents"] == ["a", "b"])
    assert one["consequents"] == ["c", "d"] and one["confidence"] == 6 / 8 and one["lift"] == (6 / 8) / (8 / 12)


def test_empty_and_bad_input(spark):
    df = spark.createDataFrame([], "items array<string>")
    assert found(itemsets.frequent_by_level(df, 0.1, 4)) == {}
    with pytest.raises(ValueError):
        itemsets.frequent_by_level(df, 0.1, 0)


def test_a_node_keeps_only_the_items_behind_it(spark, monkeypatch):
    """whole baskets were written again beside each node, the last level's too."""
    baskets = [list("abcdef")] * 9 + [list("abd")] * 3
    df = spark.createDataFrame([(b,) for b in baskets], "items array<string>")
    kept, known = [], itemsets.materialize
    monkeypatch.setattr(itemsets, "materialize", lambda d: kept.append(known(d)) or kept[-1])
    assert found(itemsets.frequent_by_level(df, 0.1, 3)) == brute(baskets, 0.1, 3)
    reached = [d for d in kept if d.columns == ["items", "times", "node"]]
    assert len(reached) == 1  # the pairs; triples are only counted
    assert max(len(r["items"]) for r in reached[0].collect()) == 4
