"""Main text of web pages: boosted trees over DOM nodes, decoded along the hierarchy.

Every block node gets log-odds of holding main text from its subtree's size and densities, tag and attribute
words (its own and its ancestors'), depth and siblings. A node can be main text only if its ancestors
are: the labelling with the largest sum of log-odds under that rule is found bottom-up, as the value of a
kept node is its own log-odds plus whatever is positive among its children. So a weak paragraph in a strong
article stays, a strong paragraph in a comment section goes with it, and no kept node has a dropped ancestor.

Labels: a bounded sample of pages with an ``article`` or ``main`` element gives the texts. They
are taught in that form and in others: under plain or otherwise named containers, with menus, headers,
sidebars, notices, adverts, forms, related links and reader comments made of texts of other sampled pages
around and inside. So the trees learn densities and names, not one page's tags.

Text: blocks in page order, character references decoded, white space within a block as one blank, blocks
joined by a line feed. Null and empty pages, and pages without main text, give an empty text. Any bytes are
accepted as HTML, and time grows with the length of a page. Nodes are scored in slices, so a page of millions of
nodes needs memory for its tree, not for its features. Where no page marks its main text, the trees learn from
the generated frames alone, filled with blocks of any sampled pages; without any text they keep everything.
An empty table gives no rows.
"""

from __future__ import annotations

import html
import random
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsepanel.llm.boosting import Boosted, boost
from pulsepanel.llm.common import arrow_map
from pulsepanel.llm.dom import Page, features, features_in_slices

#: Pages that a model is learned from at most, and their length in characters.
MAX_PAGES = 150
MAX_PAGE_CHARS = 60_000
_FORCED = frozenset(("#root", "html", "body"))


@dataclass
class Model:
    vocabulary: dict[str, int]
    trees: Boosted | None


def decode(page: Page, log_odds: np.ndarray) -> list[bool]:
    """Which nodes are main text: the best labelling in which a kept node's ancestors are kept."""
    value = log_odds.tolist()
    for i in range(len(value) - 1, 0, -1):
        if value[i] > 0:
            value[page.parent[i]] += value[i]
    kept = [True] * len(value)
    for i in range(1, len(value)):
        kept[i] = kept[page.parent[i]] and (value[i] > 0 or page.tag[i] in _FORCED)
    return kept


def log_odds(page: Page, model: Model) -> np.ndarray:
    """Log-odds of each node, scored in slices."""
    assert model.trees is not None
    return np.concatenate([model.trees.log_odds(rows) for rows in features_in_slices(page, model.vocabulary)])


def extract(sources: list[str | None], model: Model, at_once: int = 20_000) -> list[str]:
    """The main text of each page; small pages are scored together, up to so many nodes."""
    out: list[str] = []
    held: list[tuple[Page, np.ndarray]] = []

    def finish() -> None:
        if held:
            odds = model.trees.log_odds(np.concatenate([rows for _, rows in held]))
            ends = np.cumsum([len(rows) for _, rows in held])
            out.extend(_kept_text(p, o) for (p, _), o in zip(held, np.split(odds, ends[:-1])))
            held.clear()

    nodes = 0
    for source in sources:
        page = Page(source or "")
        if model.trees is None:
            out.append("\n".join(t for t in page.blocks() if t))
        elif len(page.tag) > at_once:
            finish()
            nodes = 0
            out.append(_kept_text(page, log_odds(page, model)))
        else:
            if nodes + len(page.tag) > at_once:
                finish()
                nodes = 0
            held.append((page, features(page, model.vocabulary)))
            nodes += len(page.tag)
    finish()
    return out


def _kept_text(page: Page, odds: np.ndarray) -> str:
    return "\n".join(t for t, k in zip(page.blocks(), decode(page, odds)) if k and t)


# --- learning ------------------------------------------------------------------------------

_CONTENT_NAMES = (
    "content", "post", "entry-content", "article-body", "main-content", "story", "post-body", "page", "text",
    "body-copy", "",
)


def _p(text: str, tag: str = "p") -> str:
    return f"<{tag}>{html.escape(text, quote=False)}</{tag}>"


def _boilerplate(r: random.Random, kind: str, pool: list[str]) -> str:
    """One piece of a page that is no main text, filled with texts of other pages."""

    def words(low: int, high: int) -> str:
        text = r.choice(pool).split()
        n = r.randint(low, high)
        at = r.randrange(max(1, len(text) - n))
        return " ".join(text[at : at + n])

    def items(low: int, high: int, make) -> str:
        return "".join(make() for _ in range(r.randint(low, high)))

    def block(names: tuple[str, ...], body: str, tags: tuple[str, ...] = ("div", "section")) -> str:
        name, tag = r.choice(names), r.choice(tags)
        attribute = f' {r.choice(("class", "id"))}="{name}"' if name else ""
        return f"<{tag}{attribute}>{body}</{tag}>"

    line = html.escape(words(4, 30))
    links = "<ul>" + items(3, 9, lambda: f'<li><a href="/x">{html.escape(words(1, 4))}</a></li>') + "</ul>"
    some = items(1, 5, lambda: _p(words(6, 60)))
    title = _p(words(1, 5), r.choice(("h2", "h3", "h4")))
    either = r.choice((line, _p(words(4, 30))))
    if kind == "menu":
        return r.choice((f"<nav>{links}</nav>", block(("menu", "nav", "navbar", "breadcrumb"), links)))
    if kind == "header":
        name = html.escape(words(2, 8))
        named = f'<a href="/">{name}</a>{_p(words(3, 12))}'
        return r.choice((
            f"<header><h1>{name}</h1><p>{line}</p></header>",
            f"<header>{name}{links}</header>",
            block(("header", "masthead", "top", "site-header"), named),
        ))
    if kind == "footer":
        named = block(("footer", "site-footer", "copyright", "legal"), f"<p>&copy; {line}</p>{links}")
        return r.choice((f"<footer>&copy; {line}</footer>", f"<footer><p>{line}</p></footer>", named))
    if kind == "sidebar":
        names = ("sidebar", "widget", "related", "side", "trending", "popular")
        body = title + r.choice((links, some, links + some))
        return r.choice((f"<aside>{body}</aside>", block(names, body, ("div", "aside", "section"))))
    if kind == "notice":
        names = ("cookie-notice", "consent", "notice", "alert", "banner", "cookie-banner", "gdpr", "popup")
        return block(names, either + r.choice(("", "<button>OK</button>")))
    if kind == "advert":
        names = ("ad", "ads", "advert", "advertisement", "sponsored", "promo", "ad-slot", "sponsor")
        return block(names, either, ("div", "section", "aside"))
    if kind == "form":
        body = f'{title}{either}<input name="q"><button>{html.escape(words(1, 2))}</button>'
        return block(("newsletter", "subscribe", "search", "login", "signup", ""), body, ("form",))
    if kind == "share":
        names = ("share", "social", "tags", "byline", "meta", "pagination", "author-bio")
        return block(names, r.choice((links, _p(words(3, 14)))))
    one = r.choice(("comment", "reply", ""))
    body = items(1, 6, lambda: block((one,), _p(words(2, 4), "h4") + _p(words(8, 80)), ("div", "li")))
    names = ("comments", "comment-list", "responses", "discussion", "replies", "disqus-thread")
    return block(names, title + body, ("div", "section", "ol"))


_KINDS = ("menu", "header", "footer", "sidebar", "notice", "advert", "form", "share", "comments")


def _content(r: random.Random, tag: str, text: str) -> str:
    """A block of main text as it is, or as a list, a quotation, a table or under a heading."""
    body = html.escape(text, quote=False)
    words = body.split(" ")
    if r.random() < 0.15:
        k, name = r.randrange(len(words)), r.choice(("b", "em", "a", "span"))
        words[k] = f"<{name} title=x>{words[k]}</{name}>"
    body = " ".join(words)
    kind = r.random()
    if kind < 0.08:
        size = r.randint(3, 15)
        items = [" ".join(words[a : a + size]) for a in range(0, len(words), size)]
        name = r.choice(("ul", "ol"))
        return f"<{name}>{''.join(f'<li>{i}</li>' for i in items)}</{name}>"
    if kind < 0.12:
        return r.choice((f"<blockquote><p>{body}</p></blockquote>", f"<blockquote>{body}</blockquote>"))
    if kind < 0.15:
        size = r.randint(1, 6)
        cells = "".join(f"<td>{' '.join(words[a : a + size])}</td>" for a in range(0, len(words), size))
        return f"<table><tr>{cells}</tr></table>"
    if kind < 0.18:
        return f"<pre>{body}</pre>"
    tag = tag if tag in ("h1", "h2", "h3") else r.choice(("p", "p", "p", "p", "div"))
    heading = ""
    if kind < 0.3:
        name = r.choice(("h2", "h3"))
        heading = f"<{name}>{' '.join(body.split(' ')[: r.randint(1, 7)])}</{name}>"
    return f"{heading}<{tag}>{body}</{tag}>"


def _variant(r: random.Random, blocks: list[tuple[str, str]], pool: list[str]) -> str:
    """A page with these blocks as main text, in a random frame; marks say what is what."""
    inside = []
    for tag, text in blocks:
        if r.random() < 0.04:
            kind = r.choice(("advert", "share", "sidebar", "form", "notice"))
            inside.append(_marked(_boilerplate(r, kind, pool)))
        inside.append(_content(r, tag, text))
    if r.random() < 0.25:
        inside.append(_marked(_boilerplate(r, r.choice(("comments", "share", "sidebar")), pool)))
    tag = r.choice(("article", "main", "div", "div", "section"))
    name = r.choice(_CONTENT_NAMES)
    attribute = f' {r.choice(("class", "id"))}="{name}"' if name else ""
    main = f'<{tag}{attribute} x-train="yes">{"".join(inside)}</{tag}>'
    first = [k for k in _KINDS if k not in ("footer", "share", "comments") and r.random() < 0.45]
    last = ("comments", "sidebar", "advert", "form", "share", "notice", "menu")
    before = [_boilerplate(r, k, pool) for k in first]
    after = [_boilerplate(r, k, pool) for k in last if r.random() < 0.35]
    after += [_boilerplate(r, "footer", pool)] if r.random() < 0.8 else []
    r.shuffle(before)
    if r.random() < 0.3:
        name = r.choice(("wrapper", "container", "row", "layout"))
        main = f'<div class="{name}">{main}{"".join(after[:1])}</div>'
        after = after[1:]
    body = "".join([*before, main, *after])
    return f"<html><head><title>t</title></head><body>{body}</body></html>"


def _marked(piece: str) -> str:
    """The piece with its first tag marked as no main text."""
    at = min(i for i in (piece.find(" "), piece.find(">")) if i > 0)
    return piece[:at] + ' x-train="no"' + piece[at:]


def _labels(page: Page, marked: bool) -> np.ndarray:
    """1 for nodes that hold main text in their subtree."""
    n = len(page.tag)
    state = [False] * n
    for i in range(1, n):
        state[i] = state[page.parent[i]]
        if marked:
            if page.marks[i]:
                state[i] = page.marks[i] == "yes"
        elif page.tag[i] in ("article", "main"):
            state[i] = True
        elif page.tag[i] in ("nav", "aside", "form", "footer"):
            state[i] = False
    texts = page.blocks()
    y = [float(s and bool(t)) for s, t in zip(state, texts)]
    for i in range(n - 1, 0, -1):
        y[page.parent[i]] = max(y[page.parent[i]], y[i])
    return np.array(y)


def fit(pages: DataFrame, html_col: str = "html", max_pages: int = MAX_PAGES, variants: int = 4) -> Model:
    """Learn from at most ``max_pages`` unlike pages with an article or main element, chosen by a hash.

    Without any such page they are chosen from all pages.
    """
    source = F.col(f"`{html_col}`").cast("string")
    short = pages.select(source.alias("html")).where(F.length("html") <= MAX_PAGE_CHARS)
    marked = _sampled(short.where(F.col("html").rlike("(?i)<(article|main)[ >]")), max_pages)
    return learn(marked or _sampled(short, max_pages), variants)


def _sampled(pages: DataFrame, max_pages: int) -> list[str]:
    hashed = pages.withColumn("hash", F.xxhash64("html"))
    # the hashes alone are ordered, so tasks send numbers; then the few pages up to the last hash
    last = hashed.select("hash").distinct().orderBy("hash").limit(max_pages).agg(F.max("hash")).first()[0]
    few = hashed.where(F.col("hash") <= F.lit(last)).distinct().orderBy("hash", "html").limit(max_pages)
    return [row.html for row in few.collect()]


def learn(sources: list[str], variants: int = 4) -> Model:
    """A model from pages that mark their main text with article or main.

    If none does, every page lends its paragraphs and headings to generated frames, which alone are taught.
    """
    r = random.Random(7)
    originals = [Page(s) for s in sources]
    taught: list[tuple[Page, np.ndarray]] = []
    texts: list[list[tuple[str, str]]] = []
    for page in originals:
        y = _labels(page, False)
        blocks = [(t, b) for t, b, k in zip(page.tag, page.blocks(), y) if k and b]
        if blocks:
            taught.append((page, y))
            texts.append(blocks)
    if not texts:
        for page in originals:
            blocks = [(t, b) for t, b in zip(page.tag, page.blocks()) if b and t in ("p", "h1", "h2", "h3")]
            if blocks:
                texts.append(blocks)
    if not texts:
        return Model({}, None)
    for number, blocks in enumerate(texts):
        pool = [t for _, t in r.choice(texts)] + [t for _, t in texts[(number + 1) % len(texts)]]
        for _ in range(variants):
            at = r.randrange(len(blocks))
            some = blocks if r.random() < 0.5 else blocks[at : at + r.randint(1, 12)]
            page = Page(_variant(r, some, pool))
            taught.append((page, _labels(page, True)))
    known: dict[str, int] = {}
    for page, _ in taught:
        for tag, names in zip(page.tag, page.names):
            for name in (f"<{tag}", *names):
                known[name] = known.get(name, 0) + 1
    vocabulary = {w: i for i, w in enumerate(sorted(w for w, c in known.items() if c >= 5))}
    x = np.concatenate([features(p, vocabulary) for p, _ in taught])
    y = np.concatenate([y for _, y in taught])
    weight = np.concatenate([np.full(len(y), 1 / max(1, len(y)) ** 0.5) for _, y in taught])
    return Model(vocabulary, boost(x, y, weight, trees=120, depth=4))


def main_text(
    pages: DataFrame, model: Model, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """page_id, url, text, n_chars of every page."""

    def run(batch: pa.RecordBatch) -> dict:
        texts = extract(batch.column(2).to_pylist(), model)
        return {
            "page_id": batch.column(0), "url": batch.column(1), "text": texts,
            "n_chars": [len(t) for t in texts],
        }

    rows = pages.select(F.col(f"`{id_col}`"), F.col(f"`{url_col}`"), F.col(f"`{html_col}`").cast("string"))
    kinds = [f.dataType.simpleString() for f in rows.schema.fields]
    return arrow_map(rows, run, f"page_id {kinds[0]}, url {kinds[1]}, text string, n_chars bigint")

