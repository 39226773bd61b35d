"""A page's block elements in document order, as parallel lists, and features of each.

Only what extraction needs of HTML: comments, declarations and raw text elements are skipped, inline
elements belong to the block around them, block elements close an open paragraph, list items and cells
close their like. Text directly in an element that also has blocks gets a node of its own (``#text``). Any
input gives a tree; unclosed elements end with their parent or the page.

Time grows with the page's length, however it is broken: no stretch of it is searched twice for the same thing, and
open elements are known by name, so nothing walks the stack of them.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np

_MARKUP = re.compile(r"<(?:(!--)|([!?])|(/?)([a-zA-Z][^\s/>]*))")
_STOP = re.compile(r"[>\"']")
_BODY = re.compile(r"<body[\s>]", re.IGNORECASE)
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")
_WORDS_OF_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

BLOCKS = (
    "html body div section article main header footer nav aside p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table "
    "thead tbody tfoot tr td th caption blockquote pre form fieldset figure figcaption address details "
    "summary dialog center hr select option button label textarea menu hgroup iframe"
).split()
_BLOCK = frozenset(BLOCKS)
_RAW = frozenset("script style template noscript svg math object head title textarea select".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_CLOSES = {  # an opening tag ends the nearest of these, unless one of the stops is nearer
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
_HOLDS_PARAGRAPHS = ("td", "th", "table", "button")
_BREAKS_PARAGRAPH = _BLOCK - {"button", "label", "option", "select", "textarea", "iframe"}
#: Features that are not tags or names, in order.
FIGURES = (
    "depth", "chars", "words", "own_chars", "link_share", "tag_density", "stops_per_word", "capital_share",
    "share_of_page", "share_of_parent", "place", "index", "siblings", "same_siblings", "blocks", "paragraphs",
    "words_per_block", "links", "inputs", "parent_words_per_block", "largest_sibling_share", "children",
)


class _Next:
    """The next match of a pattern from a place on; a stretch without one is searched once."""

    def __init__(self, pattern: re.Pattern, source: str) -> None:
        self.pattern, self.source = pattern, source
        self.asked, self.found = -1, None

    def __call__(self, at: int) -> re.Match | None:
        if not (0 <= self.asked <= at and (self.found is None or at <= self.found.start())):
            self.asked, self.found = at, self.pattern.search(self.source, at)
        return self.found


class _TagEnds:
    """Where tags end: at the next ``>`` outside quotes or, if there is none, at the next one at all.

    Stops that a vain search met outside quotes are remembered: another search that meets one is vain as well.
    """

    def __init__(self, source: str) -> None:
        self.source = source
        self.next_stop, self.next_end = _Next(_STOP, source), _Next(re.compile(">"), source)
        self.vain: set[int] = set()

    def __call__(self, at: int) -> int:
        met = []
        place = at
        while (stop := self.next_stop(place)) is not None and stop.start() not in self.vain:
            if stop[0] == ">":
                return stop.start()
            met.append(stop.start())
            closing = self.source.find(stop[0], stop.end())
            if closing < 0:
                break
            place = closing + 1
        self.vain.update(met)
        end = self.next_end(at)
        return -1 if end is None else end.start()


class _Open:
    """The open elements: (name, nearest block), and where the last of each name stands."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, int]] = [("#root", 0)]
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []

    def add(self, name: str, block: int) -> None:
        self.places.setdefault(name, []).append(len(self.stack))
        if name in _BLOCK:
            self.blocks.append(len(self.stack))
        self.stack.append((name, block))

    def last(self, *names: str) -> int:
        """The highest place of any of the names, 0 without one."""
        return max((p[-1] for n in names if (p := self.places.get(n))), default=0)

    def end(self, place: int) -> None:
        while len(self.stack) > place:
            name, _ = self.stack.pop()
            self.places[name].pop()
        while self.blocks and self.blocks[-1] >= place:
            self.blocks.pop()

    @property
    def block(self) -> int:
        return self.stack[-1][1]


class Page:
    """Block nodes: tag, parent, names, text runs and sums over their subtrees."""

    def __init__(self, source: str) -> None:
        self.tag: list[str] = ["#root"]
        self.parent: list[int] = [-1]
        self.names: list[tuple[str, ...]] = [()]
        self.marks: list[str] = [""]  # training marks, no features
        self.text: list[list[str]] = [[]]
        self.link_chars: list[int] = [0]
        self.links: list[int] = [0]
        self.inputs: list[int] = [0]
        self.inline: list[int] = [0]
        self._parse(source)

    def _node(self, tag: str, parent: int, names: tuple[str, ...] = (), mark: str = "") -> int:
        for values, value in (
            (self.tag, tag), (self.parent, parent), (self.names, names), (self.marks, mark),
            (self.link_chars, 0), (self.links, 0), (self.inputs, 0), (self.inline, 0),
        ):
            values.append(value)
        self.text.append([])
        return len(self.tag) - 1

    def _parse(self, source: str) -> None:
        opened = _Open()
        run = -1  # node that takes text now; -1 after a block ended
        in_link = 0
        tag_end = _TagEnds(source)
        closing: dict[str, _Next] = {}
        next_body = _Next(_BODY, source)

        def say(text: str) -> None:
            nonlocal run
            if run < 0:
                if not text.strip():
                    return
                block = opened.block
                # first text of a block without children is its own
                run = block if block == len(self.tag) - 1 and block else self._node("#text", block)
            self.text[run].append(text)
            if in_link:
                self.link_chars[run] += len(text.strip())

        at, said, n = 0, 0, len(source)
        while at < n:
            m = _MARKUP.search(source, at)
            if not m:
                break
            if m[1] or m[2]:  # comments and declarations
                end = source.find("-->" if m[1] else ">", m.end())
                after = n if end < 0 else end + (3 if m[1] else 1)
            else:
                end = tag_end(m.end())
                if end < 0:  # no tag, and none behind it
                    later = (source.find(mark, m.start() + 1) for mark in ("<!", "<?"))
                    at = min((i for i in later if i >= 0), default=n)
                    continue
                after = end + 1
            if m.start() > said:
                say(html.unescape(source[said : m.start()]))
            at = said = after
            if m[1] or m[2]:
                continue
            name, attributes = m[4].lower(), source[m.end() : end]
            if m[3]:  # an end tag
                if name == "a":
                    in_link = max(0, in_link - 1)
                place = opened.last(name)
                # an inline end tag does not end blocks
                if place and (name in _BLOCK or not opened.blocks or opened.blocks[-1] < place):
                    if name in _BLOCK:
                        run = -1
                    opened.end(place)
                continue
            if name == "br":
                say(" ")
                continue
            if name in ("input", "button", "textarea", "select"):
                self.inputs[opened.block] += 1
            if name in _RAW:
                if name not in closing:
                    closing[name] = _Next(re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.IGNORECASE), source)
                ended = closing[name](at)
                body = next_body(at) if name == "head" else None
                if body and (not ended or body.start() < ended.start()):
                    at = body.start()
                else:
                    at = ended.end() if ended else (at if name == "head" else n)
                said = at
                continue
            if name in _VOID and name != "hr":
                continue
            if name not in _BLOCK:
                self.inline[opened.block] += 1
                if name == "a":
                    in_link += 1
                    self.links[opened.block] += 1
                if not attributes.endswith("/"):
                    opened.add(name, opened.block)
                continue
            run, in_link = -1, 0
            if name in _BREAKS_PARAGRAPH:
                place = opened.last("p")
                if place > opened.last(*_HOLDS_PARAGRAPHS):
                    opened.end(place)
            if name in _CLOSES:
                likes, stops = _CLOSES[name]
                place = opened.last(*likes)
                if place > opened.last(*stops):
                    opened.end(place)
            if name == "hr":
                continue
            names, mark = _names(attributes)
            opened.add(name, self._node(name, opened.block, names, mark))
        if said < n:
            say(html.unescape(source[said:]))

    def blocks(self) -> list[str]:
        """The text of each node itself, white space as one blank."""
        return [" ".join("".join(t).split()) if t else "" for t in self.text]


_ASCII_CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _names(attributes: str) -> tuple[tuple[str, ...], str]:
    """Words of class, id, role and itemprop, lower-cased; the training mark."""
    if not attributes or "=" not in attributes:
        return (), ""
    words: list[str] = []
    mark = ""
    for key, a, b, c in _ATTRIBUTE.findall(attributes):
        key = key.lower()
        if key in ("class", "id", "role", "itemprop"):
            words += [w.lower() for w in _WORDS_OF_NAME.findall(a or b or c)]
        elif key == "x-train":
            mark = a
    return tuple(dict.fromkeys(words)), mark


def _capitals(text: str) -> int:
    if text.isascii():
        return len(text) - len(text.encode().translate(None, _ASCII_CAPITALS))
    return sum(map(str.isupper, text))


def features(page: Page, vocabulary: dict[str, int]) -> np.ndarray:
    """One row for each node: figures, own tag, own names, names and tags of its ancestors.

    ``vocabulary`` numbers the tags (``<p``) and names known to a model.
    """
    return np.concatenate(list(features_in_slices(page, vocabulary)))


def features_in_slices(page: Page, vocabulary: dict[str, int], size: int = 20_000) -> Iterator[np.ndarray]:
    """The rows of ``features``, so many nodes at a time. Names are held as bits of one number for each node."""
    figures = _figures(page)
    n, v = len(page.tag), len(vocabulary)
    own, above = [0] * n, [0] * n
    for i in range(1, n):
        bits = 0
        for name in (f"<{page.tag[i]}", *page.names[i]):
            if name in vocabulary:
                bits |= 1 << vocabulary[name]
        own[i], p = bits, page.parent[i]
        above[i] = above[p] | own[p]
    width = (v + 7) // 8

    def spread(numbers: list[int]) -> np.ndarray:
        raw = np.frombuffer(b"".join(x.to_bytes(width, "little") for x in numbers), np.uint8)
        return np.unpackbits(raw.reshape(len(numbers), width), axis=1, bitorder="little")[:, :v]

    for at in range(0, n, size):
        part = slice(at, at + size)
        out = np.zeros((len(figures[part]), len(FIGURES) + 2 * v), np.float32)
        out[:, : len(FIGURES)] = figures[part]
        if v:
            out[:, len(FIGURES) : len(FIGURES) + v] = spread(own[part])
            out[:, len(FIGURES) + v :] = spread(above[part])
        yield out


def _figures(page: Page) -> np.ndarray:
    n = len(page.tag)
    texts = page.blocks()
    own = np.array([len(t) for t in texts], float)
    words = np.array([t.count(" ") + 1 if t else 0 for t in texts], float)
    stops = np.array([t.count(".") + t.count(",") + t.count("!") + t.count("?") for t in texts], float)
    capitals = np.array([_capitals(t) / max(1, len(t)) for t in texts])
    out = np.zeros((n, len(FIGURES)), np.float32)
    chars, total_words, total_stops = own.copy(), words.copy(), stops.copy()
    link = np.array(page.link_chars, float)
    links = np.array(page.links, float)
    inputs = np.array(page.inputs, float)
    tags = np.array(page.inline, float)
    blocks = (own > 0).astype(float)
    paragraphs = np.array([t == "p" for t in page.tag], float)
    parent = page.parent
    children: list[list[int]] = [[] for _ in range(n)]
    for i in range(n - 1, 0, -1):  # children come after their parents
        p = parent[i]
        children[p].append(i)
        for sums in (chars, total_words, total_stops, link, links, inputs, blocks, paragraphs):
            sums[p] += sums[i]
        tags[p] += tags[i] + 1
    page_chars = max(1.0, chars[0])
    before = np.concatenate([[0.0], np.cumsum(own)[:-1]]) / page_chars
    depth = [0] * n
    figure = {name: k for k, name in enumerate(FIGURES)}
    out[:, figure["chars"]] = np.log1p(chars)
    out[:, figure["words"]] = np.log1p(total_words)
    out[:, figure["own_chars"]] = np.log1p(own)
    out[:, figure["link_share"]] = np.minimum(1, link / np.maximum(1, chars))
    out[:, figure["tag_density"]] = tags / np.maximum(1, total_words)
    out[:, figure["stops_per_word"]] = total_stops / np.maximum(1, total_words)
    out[:, figure["capital_share"]] = capitals
    out[:, figure["share_of_page"]] = chars / page_chars
    out[:, figure["place"]] = before
    out[:, figure["blocks"]] = np.log1p(blocks)
    out[:, figure["paragraphs"]] = np.log1p(paragraphs)
    per_block = total_words / np.maximum(1, blocks)
    out[:, figure["words_per_block"]] = np.log1p(per_block)
    out[:, figure["links"]] = np.log1p(links)
    out[:, figure["inputs"]] = inputs
    for p in range(n):
        kids = children[p][::-1]
        out[p, figure["children"]] = math.log1p(len(kids))
        same = Counter(page.tag[i] for i in kids)
        most = max((chars[i] for i in kids), default=0.0)
        for k, i in enumerate(kids):
            depth[i] = depth[p] + 1
            out[i, figure["depth"]] = depth[i]
            out[i, figure["share_of_parent"]] = chars[i] / max(1.0, chars[p])
            out[i, figure["index"]] = k
            out[i, figure["siblings"]] = math.log1p(len(kids))
            out[i, figure["same_siblings"]] = math.log1p(same[page.tag[i]])
            out[i, figure["parent_words_per_block"]] = math.log1p(per_block[p])
            out[i, figure["largest_sibling_share"]] = most / max(1.0, chars[p])
    return out
