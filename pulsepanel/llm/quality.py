"""Document quality by histogram gradient-boosted trees over statistics of the text.

Statistics come from bytes, words, runs of words and lines of the whole text (``FEATURES``); id, language, source
and labels are none of them. Learning takes the labelled rows outside the held-out quarter, at most
``max_labelled`` of them, chosen by a hash of the id; only their statistics go to the driver. Values are cut into
at most 255 bins by quantiles; trees grow level by level, all nodes of a level from one histogram of gradients
and curvatures, and a node splits where the loss falls most (ties: lowest feature, then lowest bin).

The trees are flattened into arrays over all nodes: feature, threshold, left, right, value. A leaf leads to
itself, so a block of rows walks all trees together, as many steps as the deepest one has levels.

Defined cases: null and empty texts have statistics 0 and get a score like any other; a long text is read in
blocks, of which only the words' hashes are kept; repeated rows are scored each; an id with two labels counts
as the lower; other labels than 0 and 1 are not used. Without labels of both classes every score is their share
(one half without any). An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsepanel.llm.common import arrow_map
from pulsepanel.llm.words import gram_hashes, spaced_hashes

#: Labelled rows that trees are learned from at most.
MAX_LABELLED = 20_000
#: Bytes of a text that are hashed at once, and rows that walk the trees at once.
BLOCK_BYTES, BLOCK_ROWS = 1 << 20, 4096

_SPACES = b" \t\n\r\x0b\x0c"
_KINDS = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "digit": b"0123456789",
    "stop": b".!?",
    "comma": b",;:",
    "symbol": b"#*$%&|<>{}[]@^~_=+\\/",
    "quote": b"'\"()-",
    "vowel": b"aeiouAEIOU",
    "space": _SPACES,
    "line": b"\n",
    "other": bytes(range(128, 256)),
    "control": bytes(b for b in range(32) if b not in _SPACES),
}
FEATURES = [
    "log_bytes", "log_words", *(f"{k}_share" for k in _KINDS), "byte_entropy", "commonest_byte",
    "word_bytes", "word_bytes_spread", "capital_words", "upper_words", "stopped_words", "symbol_words", "digit_words",
    "distinct_words", "top_word", "top_ten_words", "single_words", "repeated_2", "repeated_3", "repeated_5", "repeated_10",
    "distinct_lines", "line_words", "stopped_lines", "short_lines", "longest_line", "words_per_stop",
]
_MEMBERS = np.array([[b in chars for b in range(256)] for chars in _KINDS.values()], float)


def _flags(chars: bytes) -> np.ndarray:
    return np.isin(np.arange(256), list(chars))


_IS_SPACE, _IS_UPPER, _IS_LOWER = _flags(_SPACES), _flags(_KINDS["upper"]), _flags(_KINDS["lower"])
_IS_STOP, _IS_SYMBOL, _IS_DIGIT = _flags(_KINDS["stop"]), _flags(_KINDS["symbol"]), _flags(_KINDS["digit"])


def _blocks(text: bytes, size: int = BLOCK_BYTES) -> Iterator[bytes]:
    """The text in blocks that end at white space."""
    begin = 0
    while len(text) - begin > size:
        ends = [at for s in (b" ", b"\n", b"\t") if (at := text.find(s, begin + size)) >= 0]
        if not ends:
            break
        yield text[begin : min(ends)]
        begin = min(ends)
    yield text[begin:]


def _word_sums(block: bytes) -> np.ndarray:
    """Words, their bytes, squares of bytes, and words that begin upper, are upper, end with a stop, hold symbols, digits."""
    raw = np.frombuffer(block, np.uint8)
    inside = ~_IS_SPACE[raw]
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(8)

    def held(flags: np.ndarray) -> np.ndarray:
        # spaces have no flag, so a sum runs up to the next word
        return np.add.reduceat(flags[raw].astype(np.int32), starts) > 0

    length = (ends - starts).astype(float)
    upper = _IS_UPPER[raw[starts]]
    return np.array([
        len(starts), length.sum(), (length**2).sum(), upper.sum(), (held(_IS_UPPER) & ~held(_IS_LOWER)).sum(),
        _IS_STOP[raw[ends - 1]].sum(), held(_IS_SYMBOL).sum(), held(_IS_DIGIT).sum(),
    ])


def _repeated(hashes: np.ndarray, k: int) -> float:
    """Share of runs of k words that occur more than once in the text."""
    grams = gram_hashes(hashes, k)
    if not len(grams):
        return 0.0
    grams.sort()
    same = grams[1:] == grams[:-1]
    return float((np.append(same, False) | np.append(False, same)).sum()) / len(grams)


def statistics(text: bytes) -> list[float]:
    """The statistics named in ``FEATURES``."""
    if not text:
        return [0.0] * len(FEATURES)
    size = len(text)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    share = counts / size
    used = share[share > 0]
    sums, hashed = np.zeros(8), []
    for block in _blocks(text):
        sums += _word_sums(block)
        hashed.append(spaced_hashes(block))
    hashes = np.concatenate(hashed)
    n, length, squares, *kinds = sums
    words = max(1.0, n)
    mean = length / words
    uses = np.sort(np.unique(hashes, return_counts=True)[1])[::-1] if len(hashes) else np.zeros(1)
    lines = [line for line in text.split(b"\n") if line.strip()]
    n_lines = max(1, len(lines))
    stops = float(counts[list(_KINDS["stop"])].sum())
    return [
        float(np.log1p(size)), float(np.log1p(n)), *(_MEMBERS @ share).tolist(),
        float(-(used * np.log(used)).sum()), float(share.max()),
        mean, max(0.0, squares / words - mean**2) ** 0.5, *(k / words for k in kinds),
        len(uses) / words, uses[0] / words, uses[:10].sum() / words, (uses == 1).sum() / words,
        *(_repeated(hashes, k) for k in (2, 3, 5, 10)),
        len(set(lines)) / n_lines, n / n_lines, sum(x.rstrip()[-1:] in (b".", b"!", b"?") for x in lines) / n_lines,
        sum(len(x) < 30 for x in lines) / n_lines, float(np.log1p(max(map(len, lines), default=0))), n / (1 + stops),
    ]


# --- trees ----------------------------------------------------------------------------------


@dataclass(frozen=True)
class Forest:
    """All trees in one set of arrays; a row goes right where its value is above the threshold."""

    start: float
    roots: np.ndarray = field(default_factory=lambda: np.empty(0, np.int32))
    feature: np.ndarray = field(default_factory=lambda: np.empty(0, np.int32))
    threshold: np.ndarray = field(default_factory=lambda: np.empty(0))
    left: np.ndarray = field(default_factory=lambda: np.empty(0, np.int32))
    right: np.ndarray = field(default_factory=lambda: np.empty(0, np.int32))
    value: np.ndarray = field(default_factory=lambda: np.empty(0))
    levels: int = 0

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        for begin in range(0, len(x) if len(self.roots) else 0, BLOCK_ROWS):
            block = x[begin : begin + BLOCK_ROWS]
            rows = np.arange(len(block))[:, None]
            node = np.broadcast_to(self.roots, (len(block), len(self.roots)))
            for _ in range(self.levels):
                above = block[rows, self.feature[node]] > self.threshold[node]
                node = np.where(above, self.right[node], self.left[node])
            out[begin : begin + BLOCK_ROWS] += self.value[node].sum(axis=1)
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.log_odds(x)))


def _cuts(column: np.ndarray, most: int) -> np.ndarray:
    """Bin edges: between all values of few, between quantiles of many."""
    values = np.unique(column)
    if len(values) > most:
        values = np.unique(np.quantile(column, np.linspace(0, 1, most + 1), method="nearest"))
    return (values[1:] + values[:-1]) / 2


def grow(
    x: np.ndarray,
    y: np.ndarray,
    trees: int = 150,
    levels: int = 4,
    rate: float = 0.1,
    bins: int = 255,
    ridge: float = 1.0,
    least_curvature: float = 2.0,
) -> Forest:
    """Trees for the log-odds of y (0 or 1), each from the gradient and curvature that those before it leave."""
    n, width = x.shape
    share = float(y.mean()) if n else 0.5
    if not 0 < share < 1:
        return Forest(float(np.log((share + 1e-3) / (1 - share + 1e-3))))
    cuts = [_cuts(column, bins) for column in x.T]
    binned = np.stack([np.searchsorted(c, column) for c, column in zip(cuts, x.T)], axis=1)
    size = max(len(c) for c in cuts) + 1
    cell = binned + np.arange(width) * size
    margin = np.full(n, np.log(share / (1 - share)))
    roots, feature, threshold, left, right, value = [], [], [], [], [], []

    def leaf(weight: float) -> int:
        node = len(value)
        feature.append(0)
        threshold.append(np.inf)
        left.append(node)
        right.append(node)
        value.append(weight)
        return node

    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        grad, curve = y - p, p * (1 - p)
        root = leaf(rate * grad.sum() / (curve.sum() + ridge))
        roots.append(root)
        at = np.full(n, root)
        alive = [root]
        for _ in range(levels):
            slot = np.full(len(value), -1)
            slot[alive] = np.arange(len(alive))
            rows = np.flatnonzero(slot[at] >= 0)
            if not len(rows):
                break
            cells = (slot[at[rows]][:, None] * (width * size) + cell[rows]).ravel()
            shape = (len(alive), width, size)
            g = np.bincount(cells, np.repeat(grad[rows], width), np.prod(shape)).reshape(shape).cumsum(2)
            h = np.bincount(cells, np.repeat(curve[rows], width), np.prod(shape)).reshape(shape).cumsum(2)
            all_g, all_h = g[:, :, -1:], h[:, :, -1:]
            gain = g**2 / (h + ridge) + (all_g - g) ** 2 / (all_h - h + ridge) - all_g**2 / (all_h + ridge)
            gain[(h < least_curvature) | (all_h - h < least_curvature)] = -np.inf
            flat = gain.reshape(len(alive), -1)
            best = flat.argmax(axis=1)
            grown = []
            for i, node in enumerate(alive):
                if not flat[i, best[i]] > 1e-6:
                    continue
                f, b = divmod(int(best[i]), size)
                sums = g[i, f, b], h[i, f, b], all_g[i, f, 0], all_h[i, f, 0]
                feature[node], threshold[node] = f, cuts[f][b]
                left[node] = leaf(rate * sums[0] / (sums[1] + ridge))
                right[node] = leaf(rate * (sums[2] - sums[0]) / (sums[3] - sums[1] + ridge))
                grown += [left[node], right[node]]
            goes = np.array(right)[at[rows]], np.array(left)[at[rows]]
            at[rows] = np.where(x[rows, np.array(feature)[at[rows]]] > np.array(threshold)[at[rows]], *goes)
            alive = grown
            if not alive:
                break
        margin += np.array(value)[at]
    ints = (np.array(v, np.int32) for v in (roots, feature))
    return Forest(
        float(np.log(share / (1 - share))), *ints, np.array(threshold), np.array(left, np.int32),
        np.array(right, np.int32), np.array(value), levels,
    )


# --- documents ------------------------------------------------------------------------------


def held_out(doc_id: Column) -> Column:
    """Rows whose labels nobody learns from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def _table(batch: pa.RecordBatch, column: int) -> np.ndarray:
    """Statistics of a batch of texts, one row each; texts become Python objects one by one."""
    rows = [statistics(text.as_py() or b"") for text in batch.column(column)]
    return np.array(rows, float).reshape(-1, len(FEATURES))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    max_labelled: int = MAX_LABELLED,
    label_col: str = "quality",
    id_col: str = "doc_id",
    text_col: str = "text",
    **options,
) -> Forest:
    """Trees from the labelled rows; ``options`` are those of ``grow``."""
    label = F.col(f"`{label_col}`").cast("int").alias("label")
    rows = (
        labels.select(F.col(f"`{id_col}`").alias("doc_id"), label)
        .where(F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_labelled)
    )
    text = F.col(f"`{text_col}`").cast("string").cast("binary").alias("text")
    found = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text).join(F.broadcast(rows), "doc_id")
    # equal texts with one label count once
    distinct = found.select("text", "label").distinct()

    def run(batch: pa.RecordBatch) -> dict:
        return {"x": list(_table(batch, 0)), "y": batch.column(1)}

    # statistics of at most so many distinct labelled texts
    learned = arrow_map(distinct, run, "x array<double>, y int").orderBy("y", "x").toPandas()
    x = np.array(learned.x.tolist(), float).reshape(-1, len(FEATURES))
    return grow(x, learned.y.to_numpy(float), **options)


def score(docs: DataFrame, forest: Forest, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score of every row: the probability that its label is 1."""

    def run(batch: pa.RecordBatch) -> dict:
        return {"doc_id": batch.column(0), "score": forest.probability(_table(batch, 1))}

    kind = docs.select(F.col(f"`{id_col}`")).schema[0].dataType.simpleString()
    rows = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`").cast("string").cast("binary"))
    return arrow_map(rows, run, f"doc_id {kind}, score double")
