"""Top-k search and HTML extraction: brute force, accuracy and edge cases."""

import re
from collections import Counter
from html import unescape

import numpy as np
import pytest
from conftest import SF_SMALL

from riskweave.llm import html, topk
from riskweave.llm.common import read


def plain_topk(rows, k=10):
    fit = [(i, r["vec_id"], [int(np.floor(1024 * float(x))) for x in r["embedding"]]) for i, r in enumerate(rows)
           if r["embedding"] and all(x is not None and np.isfinite(x) for x in r["embedding"])]
    out = []
    for i, q, e in fit:
        if q is None or q % 100:
            continue
        scored = sorted((-sum(a * b for a, b in zip(e, f, strict=True)), v is None, v or 0) for j, v, f in fit
                        if j != i and len(f) == len(e))[:k]
        out += [(q, n + 1, None if gone else v, -s) for n, (s, gone, v) in enumerate(scored)]
    return sorted(out, key=str)


def got_topk(df, **options):
    return sorted((tuple(r) for r in topk.search(df, **options).select("query_id", "rank", "vec_id", "score").collect()), key=str)


def test_topk_equals_brute_force(spark, monkeypatch):
    df = read(spark, SF_SMALL, "embeddings")
    want = plain_topk(df.collect())
    assert got_topk(df) == want
    monkeypatch.setattr(topk, "CELL_ROWS", 70)
    monkeypatch.setattr(topk, "CELL_QUERIES", 2)
    assert got_topk(df) == want


def test_topk_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, -0.25]), (100, [0.5, -0.25]), (100, [0.5, -0.25]), (1, None), (2, [1.0, None]), (200, [nan, 1.0]), (3, [inf, 0.0]),
            (4, []), (None, [0.5, -0.25]), (5, [-3000.0, 2500.5]), (6, [0.0, 0.0]), (-100, [1e-9, -1e-9]), (300, [0.1, 0.2, 0.3])]
    rows = [(i, e, "x", 1) for i, e in rows]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string, rank int")
    assert got_topk(df) == plain_topk(df.collect())
    assert got_topk(df, k=2) == plain_topk(df.collect(), 2)
    assert got_topk(df.limit(0)) == []


@pytest.mark.parametrize("seed", range(6))
def test_bit_slices_never_lose_a_row(seed):
    rng = np.random.default_rng(seed)
    scale = [3, 90, 1000, 10**6, 40, 7][seed]
    have = rng.integers(-scale, scale + 1, (500, 9))
    if seed == 4:
        have[:] = have[0]  # all tied
    ask = rng.integers(-scale, scale + 1, (70, 9))
    ask[0] = 0
    slices = topk.BitSlices(have)
    scores = ask @ have.T
    for q, (rows, found) in enumerate(slices.best(ask, 11)):
        assert (found == scores[q, rows]).all()
        assert sorted(found, reverse=True)[:11] == sorted(scores[q], reverse=True)[:11]
        tenth = sorted(scores[q], reverse=True)[10]
        assert set(np.flatnonzero(scores[q] >= tenth)) <= set(rows.tolist())
    if seed == 2:
        assert np.mean([len(r) for r, _ in slices.best(ask, 11)]) < 250


# --- pages -------------------------------------------------------------------
def plain_article(page):
    inside = page.split("<article>", 1)[1].split("</article>")[0].replace("<br>", " ")
    parts = [" ".join(unescape(re.sub(r"<[^>]*(>|\Z)", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", inside)]
    return "\n".join(x for x in parts if x)


@pytest.fixture(scope="module")
def tree(spark):
    return html.train_tree(spark)


def test_the_tree_learns_its_table(tree):
    assert len(html.LABELLED) < 200
    assert all(html.classify(tree, r[:-1]) == r[-1] for r in html.LABELLED)


def test_pages_equal_their_articles(spark):
    pages = read(spark, SF_SMALL.replace("0.001", "0.01"), "pages")
    rows = {r["page_id"]: r for r in pages.collect()}
    got = html.extract(pages).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["text"] == plain_article(rows[r["page_id"]]["html"])
        assert r["n_chars"] == len(r["text"]) and r["url"] == rows[r["page_id"]]["url"]


LONG = "These are the words of a long paragraph that anyone would read as the text of this page, and it goes on a while."


def test_furniture_goes(tree):
    page = f"""<!DOCTYPE html><html><head><title>T</title><style>p {{}}</style><script>var a = "</p><p>x";</script></head>
    <body class="has-sidebar"><header><h1>Site</h1></header><nav><a href="/">Home</a> <a href=/b>B</a></nav>
    <div class="cookie-notice"><p>We use cookies and much else on this page, as you may well have guessed by now.</p></div>
    <article class="post"><h1>A &amp; B</h1><p>{LONG} <b>bold</b>ly<p>Un&#99;losed &lt;p&gt; &nbsp; x<br>y
    <div id="ad-slot"><p>{LONG}</p></div><ul><li><a href="#">one more link</a></li><li><a href="#">and another link</a></li></ul>
    <form><p>{LONG}</p></form><p>Last.</p><section class="comments"><p>{LONG}</p></section></article>
    <aside><p>{LONG}</p></aside><!-- <p>{LONG}</p> --><footer>&copy; x</footer></body></html>"""
    assert html.article(page, tree) == f"A & B\n{LONG} boldly\nUnclosed <p> x y\nLast."


def test_pages_without_a_marked_article(tree):
    page = f"<div><a href=1>a</a> <a href=2>b</a></div><div><h2>Title of it</h2><p>{LONG}</p><p>{LONG}</p></div><div>Ok go</div>"
    assert html.article(page, tree) == f"Title of it\n{LONG}\n{LONG}"


def test_comments_end_where_the_standard_says(tree):
    page = f"<article><!--><p>One {LONG}</p><!-- x --!><p>Two {LONG}</p><!---><p>Three {LONG}</p><!-- a > b --></article><!-- open"
    assert html.article(page, tree) == f"One {LONG}\nTwo {LONG}\nThree {LONG}"


@pytest.mark.parametrize("page", ["", "<", "<p", "<article><p>x", "a < b", "</p></div>", "<!--", "<script>", "<a href='", "<p class=\"x>y</p>" * 3])
def test_broken_pages_do_not_fail(tree, page):
    assert isinstance(html.article(page, tree), str)


def test_pages_edge_cases(spark):
    rows = [(1, "u", None, "t"), (2, None, "", "t"), (None, "u", f"<article><p>{LONG}", "t"), (3, "u", f"<article><p>{LONG}", "t"),
            (3, "u", f"<article><p>{LONG}", "t"), (4, "u", "<article>" + "<div>" * 3000 + LONG + "<a \"" * 2000, "t")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html.extract(pages).collect()
    assert len(got) == 6
    assert sorted(r["n_chars"] for r in got)[:5] == [0, 0, len(LONG), len(LONG), len(LONG)]
    assert html.extract(pages.limit(0)).count() == 0


def test_items_without_end_tags(tree):
    page = (f"<article><p>{LONG}</p><ul><li class=share>Share this<li>One {LONG}<li>Two {LONG}</ul>"
            f"<table><tr><td class=ad>Buy<td>Three {LONG}<tr><td>Four {LONG}</table></article>")
    assert html.article(page, tree) == f"{LONG}\nOne {LONG}\nTwo {LONG}\nThree {LONG}\nFour {LONG}"


def test_deep_pages_with_end_tags_that_fit_nothing(tree):
    page = "<div>" * 50_000 + "</li>" * 50_000 + f"<p>{LONG}</p>"
    assert html.article(page, tree) == LONG


@pytest.mark.parametrize("frame", [
    "class='has-sidebar'", "class='no-comments'", "class='with-ads'", "class='layout social'", "id='content-search'",
    "class='comments-open hasSidebar'", "class='page sidebar'"])
def test_words_of_a_page_frame_hide_no_text(tree, frame):
    assert html.article(f"<div {frame}><article><p>{LONG}</p></article></div>", tree) == LONG
    assert html.article(f"<main><div {frame}><article><p>{LONG}</p><p>Yes.</p></article></div></main>", tree) == f"{LONG}\nYes."
    assert html.article(f"<div {frame}><p>{LONG}</p><p>{LONG}</p></div>", tree) == f"{LONG}\n{LONG}"


def test_an_article_ends_the_furniture_around_it(tree):
    page = f"<form id=aspnet><div class=sidebar><p>{LONG}</p><main><p>One {LONG}</p><div class=share>Share</div></main></div></form>"
    assert html.article(page, tree) == f"One {LONG}"


def test_comments_marked_as_articles_go(tree):
    page = (f"<article class='post no-comments'><p>{LONG}</p></article><article class='comment'><p>One {LONG}</p></article>"
            f"<div id=comments><article><div><p>Two {LONG}</p></div></article></div><aside><article><p>Three {LONG}</p></article></aside>"
            f"<div style='display: none'><article><p>Four {LONG}</p></article></div>")
    assert html.article(page, tree) == LONG


@pytest.mark.parametrize("page", [
    "<article><p>{0}</p><section id='related-work'><h2 id='related-work-1'>Related work</h2><p>One {0}</p><p>Two {0}</p></section></article>",
    "<main><div id='advertising-in-france'><h2>Advertising in France</h2><p>{0}</p><p>One {0}</p></div></main>",
    "<article><p id='banner-elk-history'>{0}</p><p>One {0}</p></article>",
    "<article><h2 id='comments'>Comments</h2><p>{0}</p><p id='notice'>One {0}</p></article>",
    "<div><p>{0}</p><div class='search-theory'><p>One {0}</p><p>Two {0}</p></div></div>"])
def test_ids_made_from_text_hide_none(tree, page):
    want = re.sub(r"</(h2|p)>", "\n", page)
    want = re.sub(r"<[^>]*>", "", want).strip().format(LONG)
    assert html.article(page.format(LONG), tree) == want


def test_compounds_of_furniture_words_still_name_it(tree):
    for name in ("class='ad-slot'", "id='ad-slot-3'", "class='comments-area'", "id=newsletter-signup-box", "class='social-share-links'",
                 "class='cookie-notice-bar'", "role=navigation", "class='sidebar widget'"):
        page = f"<article><p>{LONG}</p></article><div {name}><p>One {LONG}</p><p>Two {LONG}</p></div><article><p>Three {LONG}</p></article>"
        assert html.article(page, tree) == f"{LONG}\nThree {LONG}", name


def splits(tree):
    return [] if isinstance(tree, int) else [html.FEATURES[tree[0]], *splits(tree[2]), *splits(tree[3])]


def test_neighbours_take_part_in_the_decision(tree):
    used = Counter(splits(tree))
    print("splits by feature:", dict(used))
    assert {"words", "prev_words", "next_words"} <= set(used)
    assert used["prev_link_density"] + used["next_link_density"] >= 2
    # the same block, other neighbours
    page = "<div>{}</div><div>The committee agreed at once.</div><div>{}</div>"
    links = "<a href=1>Home</a> <a href=2>More of it</a>"
    assert "committee" in html.article(page.format(LONG, LONG), tree) and "committee" not in html.article(page.format(links, links), tree)


def plain_blocks(page):
    """(text, words, words in links) of each block of a simple page, by splitting."""
    out = []
    for part in re.split(r"</?(?:div|p|ul|li|h1|h2|table|tr|td|hr)[^>]*>", page):
        text = " ".join(re.sub(r"<[^>]*>", "", part).split())
        linked = " ".join(re.findall(r"<a[^>]*>(.*?)</a>", part)).split()
        if text:
            out.append((unescape(text), len(text.split()), len(linked)))
    return out


def bare_page(rng):
    """A page without article, nav, class or id, and its text."""
    words = "the of and a to in is was he for it with as his on be at by had not are but from or have".split()

    def run(n):
        return " ".join(rng.choice(words, n)).capitalize()

    def link(n):
        return f"<a href='/{rng.integers(99)}'>{run(n)}</a>"

    top = [f"<div>{run(rng.integers(1, 4))}</div>", "<ul>" + "".join(f"<li>{link(rng.integers(1, 4))}</li>" for _ in range(rng.integers(3, 8))) + "</ul>"]
    text = [("h1", run(rng.integers(4, 11)))]
    for i in range(rng.integers(3, 9)):
        n = int(rng.integers(25, 90))
        text.append(("p", f"{run(n - 5)}, {link(2) if rng.random() < 0.4 else run(2)} {run(3)}."))
        if rng.random() < 0.3:
            text.append(("p", run(rng.integers(2, 12)) + "."))
        if rng.random() < 0.2:
            text.append(("h2", run(rng.integers(2, 6))))
    while text[-1][0] == "h2" or len(text[-1][1].split()) < 25:
        text.pop()
    end = [f"<h2>{run(2)}</h2><ul>" + "".join(f"<li>{link(rng.integers(2, 8))}</li>" for _ in range(rng.integers(3, 7))) + "</ul>",
           f"<hr><div>{run(rng.integers(3, 8))} {link(1)}</div><div>{link(2)} {link(1)}</div>"]
    body = "".join(f"<{t}>{x}</{t}>" for t, x in text)
    return "".join([*top, f"<div>{body}</div>", *end]), [re.sub("<[^>]*>", "", x) for _, x in text]


def test_pages_without_any_marks(tree):
    rng = np.random.default_rng(21)
    right = found = there = 0
    for _ in range(30):
        page, text = bare_page(rng)
        assert [(b["text"], b["words"], b["links"]) for b in html.blocks(page)] == plain_blocks(page)
        got = Counter(html.article(page, tree).split("\n"))
        want = Counter(" ".join(t.split()) for t in text)
        right += sum((got & want).values())
        found, there = found + sum(got.values()), there + sum(want.values())
    print("blocks: precision", right / found, "recall", right / there)
    assert right / found > 0.95 and right / there > 0.95


def test_the_operator_equals_its_rule_block_by_block(tree):
    """Features recomputed from the blocks, and the tree walked, for every block."""
    rng = np.random.default_rng(22)
    for _ in range(10):
        page, _ = bare_page(rng)
        laid = [(0, 0, 0), *plain_blocks(page), (0, 0, 0)]
        headings = {" ".join(re.sub("<[^>]*>", "", x).split()) for x in re.findall(r"<h[12]>(.*?)</h[12]>", page)}
        want = []
        for (_, pw, pl), (text, w, n), (_, nw, nl) in zip(laid, laid[1:], laid[2:]):
            x = (w, n / w, pw, pl / pw if pw else 0.0, nw, nl / nw if nw else 0.0, 0.0, 0, int(text in headings))
            if html.classify(tree, x):
                want.append(text)
        assert html.article(page, tree) == "\n".join(want)


def test_very_long_pages_and_clashing_columns(spark):
    body = "".join(f"<p>{i} {LONG}</p>" for i in range(20_000))
    pages = spark.createDataFrame([(1, "u", f"<article>{body}</article>", "t", 5, 1)], "page_id long, url string, html string, text string, n_chars int, words int")
    r = html.extract(pages).first()
    assert r["n_chars"] == sum(len(f"{i} {LONG}") for i in range(20_000)) + 19_999 and len(r) == 4


# --- floors of the top-k search ----------------------------------------------
def test_topk_passes_and_stripes_equal_brute_force(spark, monkeypatch):
    df = read(spark, SF_SMALL, "embeddings")
    want = plain_topk(df.collect())
    monkeypatch.setattr(topk, "CELL_ROWS", 16)
    monkeypatch.setattr(topk, "STRIPE_BLOCKS", 2)
    monkeypatch.setattr(topk, "SHARES", (8, 3, 1))
    assert got_topk(df) == want


@pytest.mark.parametrize("seed", range(4))
def test_floors_lose_no_row_that_reaches_them(seed):
    rng = np.random.default_rng(seed)
    scale = [5, 300, 10**5, 2][seed]
    have = rng.integers(-scale, scale + 1, (400, 7)) * rng.integers(1, 9, (400, 1))
    ask = rng.integers(-scale, scale + 1, (30, 7))
    ask[0] = 0
    scores = ask @ have.T
    slices = topk.BitSlices(have)
    for floor in (np.iinfo(np.int64).min // 4, 0, int(np.quantile(scores, 0.9)), int(scores.max()), int(scores.max()) * 3):
        for q, (rows, found) in enumerate(slices.best(ask, 11, np.full(30, floor))):
            assert (found == scores[q, rows]).all()
            tenth = sorted(scores[q], reverse=True)[10]
            assert set(np.flatnonzero(scores[q] >= max(tenth, floor))) <= set(rows.tolist())


def test_a_stripe_carries_its_floors_on(monkeypatch):
    monkeypatch.setattr(topk, "CELL_ROWS", 50)
    rng = np.random.default_rng(3)
    have = rng.integers(-50, 51, (600, 6)) * np.repeat([20, 1], [60, 540])[:, None]
    ask = rng.integers(-50, 51, (9, 6))
    made = []
    real = topk.BitSlices
    monkeypatch.setattr(topk, "BitSlices", lambda x: made.append(len(x)) or real(x))
    none = np.full(9, np.iinfo(np.int64).min)
    rows = np.arange(600)
    got = topk.stripe_best(have, rows, rows, ask, np.full(9, -1), none, 10)
    scores = ask @ have.T
    for q, (place, score) in enumerate(got):
        want = np.lexsort((rows, -scores[q]))[:10]
        assert place.tolist() == want.tolist() and score.tolist() == scores[q, want].tolist()
    assert len(made) < 12  # short vectors' blocks are passed over
    few = topk.stripe_best(have, rows, rows, ask, np.full(9, -1), scores.max(axis=1), 10)
    assert all(set(s.tolist()) <= {m} for (_, s), m in zip(few, scores.max(axis=1), strict=True))
