"""Extraction against the articles the pages were made of, and the parts it is built from."""

import html
import random
import re
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pulsepanel.llm import html_extract, registry
from pulsepanel.llm.boosting import boost
from pulsepanel.llm.dom import FIGURES, Page, features, features_in_slices


PIECES = (
    "<p> </p> <div/class='x'> </div> <a> </a> <li> <ul> </ul> <br> text &amp; < > <!-- --> <script> </script> "
    "\" <td> <table é"
).split()


def article(source):
    """The blocks of the article element, by text patterns alone."""
    inner = source[source.index("<article>") + 9 : source.index("</article>")]
    inner = re.sub(r"<[^>]*>", " ", re.sub(r"</?(?:p|h1)[^>]*>", "\0", inner))
    blocks = (" ".join(html.unescape(b).split()) for b in inner.split("\0"))
    return "\n".join(b for b in blocks if b)


@pytest.fixture(scope="module")
def model(spark):
    return html_extract.fit(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))


def test_trees_learn_an_interaction():
    r = np.random.default_rng(0)
    x = r.normal(size=(2000, 5))
    y = ((x[:, 1] > 0) ^ (x[:, 3] > 0.5)).astype(float)
    trees = boost(x[:1500], y[:1500])
    assert ((trees.log_odds(x[1500:]) > 0) == (y[1500:] > 0)).mean() > 0.95
    assert (boost(x, np.ones(len(x))).log_odds(x) > 0).all()


def test_pages_of_other_tables(spark, model):
    rows = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").collect()
    got = html_extract.extract([r.html for r in rows], model)
    wrong = [r.page_id for r, text in zip(rows, got) if text != article(r.html)]
    assert len(wrong) <= len(rows) // 100


def test_copies_of_a_page_fill_no_sample(spark, monkeypatch):
    taken = []
    monkeypatch.setattr(html_extract, "learn", lambda sources, variants: taken.append(sources))
    pages = [f"<article><p>text {i}</p></article>" for i in range(12)]
    rows = [(p,) for p in pages for _ in range(20)]
    html_extract.fit(spark.createDataFrame(rows, "html string"), max_pages=10)
    assert len(taken[0]) == len(set(taken[0])) == 10


@pytest.mark.parametrize("letter, capital", [("a", "A"), ("é", "É")])
def test_capitals_of_long_blocks(letter, capital):
    page = Page(f"<p>{letter * 300}{capital * 100}</p>")
    shares = features(page, {})[:, list(FIGURES).index("capital_share")]
    assert shares.max() == pytest.approx(0.25)


def test_other_templates(model):
    r = random.Random(2)
    words = "the river of and stone to light in that was on for with as at by from house".split()
    text = lambda n: (" ".join(r.choice(words) for _ in range(n)) + ".").capitalize()
    a, b, c = text(70), text(45), text(30)
    page = "".join((
        '<body><div class="navbar"><ul><li><a href=1>Home</a></li><li><a href=2>News</a></li></ul></div>',
        f'<div class="cookie-notice"><p>{text(20)}</p></div>',
        f'<div class="content"><h2>A short title</h2><p>{a}</p><p>{b}</p></div>',
        f"<aside><h3>Related</h3><p>{text(20)}</p></aside>",
        f'<form class="newsletter"><p>{text(9)}</p><input name=q></form>',
        f'<div id="comments"><h3>Comments</h3><div class="comment"><p>{c}</p></div></div>',
        f"<footer><p>{text(12)}</p></footer></body>",
    ))
    assert html_extract.extract([page], model)[0].split("\n")[-2:] == [a, b]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=30))
def test_any_input_gives_a_tree_and_consistent_labels(pieces):
    page = Page("".join(pieces))
    assert all(p < i for i, p in enumerate(page.parent))
    odds = np.random.default_rng(len(pieces)).normal(size=len(page.tag))
    kept = html_extract.decode(page, odds)
    assert all(kept[page.parent[i]] for i in range(1, len(kept)) if kept[i])


def test_decoding_is_the_best_consistent_labelling():
    r = np.random.default_rng(3)
    page = Page("<div><p>a</p><p>b</p></div><ul><li>c</li></ul>")
    n = len(page.tag)
    for _ in range(50):
        odds = r.normal(size=n)
        best = max(
            sum(o for o, k in zip(odds[1:], kept[1:]) if k)
            for bits in range(2 ** (n - 1))
            if (kept := [True, *(bool(bits >> i & 1) for i in range(n - 1))])
            and all(kept[page.parent[i]] for i in range(1, n) if kept[i])
        )
        kept = html_extract.decode(page, odds)
        assert sum(o for o, k in zip(odds[1:], kept[1:]) if k) == pytest.approx(best)


def test_blocks_and_references():
    page = Page("<p>a&amp;b  <b>c</b>\n d<p>e<br>f</p><script>x<p></script><ul><li>g<li>h</ul>tail")
    assert [t for t in page.blocks() if t] == ["a&b c d", "e f", "g", "h", "tail"]


@pytest.mark.parametrize(
    "page",
    [
        "<b x=" * 1_000_000,  # no tag ever ends
        '<a ">"' * 300_000,
        "<a \"x'" * 300_000,
        "<div>" * 100_000 + "x",
        "<div>" * 50_000 + "</x>" * 50_000,
        "<b>" + "<div>" * 50_000 + "</b>" * 50_000,
        "<head>" * 100_000 + "<title>" * 100_000,
        "<ul><li>" * 50_000 + "</p>" * 50_000,
        "<!--" * 300_000,
    ],
    ids=lambda page: page[:9],
)
def test_broken_pages_take_linear_time(model, page):
    start = time.process_time()
    html_extract.extract([page], model)
    assert time.process_time() - start < 30


def test_slices_of_features_are_its_rows(model):
    page = Page("".join(f'<div class="content x{i % 7}"><p>text {i}</p><ul><li>a</ul></div>' for i in range(50)))
    whole = features(page, model.vocabulary)
    parts = list(features_in_slices(page, model.vocabulary, 17))
    assert len(parts) == -(-len(page.tag) // 17) and (np.concatenate(parts) == whole).all()
    known = model.vocabulary["<p"]
    assert whole[2, len(FIGURES) + known] == 1  # its own tag
    assert whole[2, len(FIGURES) + len(model.vocabulary) + model.vocabulary["<div"]] == 1  # its parent's
    assert html_extract.log_odds(page, model) == pytest.approx(model.trees.log_odds(whole))


def test_small_and_large_pages_together(spark, model):
    pages = [r.html for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()][:40]
    assert html_extract.extract(pages, model, at_once=30) == html_extract.extract(pages, model)


def test_trees_without_marked_pages(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    plain = [re.sub(r"<(/?)(?:article|main)\b[^>]*>", r"<\1div>", r.html) for r in rows]
    learned = html_extract.fit(spark.createDataFrame([(p,) for p in plain], "html string"))
    got = html_extract.extract([r.html for r in rows], learned)
    want = [article(r.html).split("\n") for r in rows]
    found = [set(g.split("\n")) & set(w) for g, w in zip(got, want)]
    assert sum(map(len, found)) > 0.9 * sum(len(set(w)) for w in want)
    extra = sum(len(set(g.split("\n")) - set(w)) for g, w in zip(got, want))
    assert extra < 0.2 * sum(len(w) for w in want)


def test_odd_pages(spark, model):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<p>"), (4, "u", "\x00<<>><p")]
    rows += [(4, "u", "<p>" * 3000 + "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    pages = pages.selectExpr("*", "'c' AS text", "1 AS n_chars")
    out = html_extract.main_text(pages, model).collect()
    assert len(out) == 5 and [r.text for r in out][:3] == ["", "", ""]
    assert html_extract.main_text(pages.where("false"), html_extract.fit(pages.where("false"))).count() == 0


def test_query_columns(spark, sf_dir):
    rows = registry.QUERIES["op1_boosted_dom"](spark, sf_dir).collect()
    assert len(rows) == spark.read.parquet(f"{sf_dir}/pages.parquet").count()
    assert all(r.n_chars == len(r.text) for r in rows) and sum(bool(r.text) for r in rows) == len(rows)
