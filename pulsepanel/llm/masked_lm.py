"""LM scoring by masked pseudo-likelihood.

A network sees a window of tokens on both sides of a masked token and predicts it. A document's score is the
sum over its tokens of log p(token | both sides).

Vocabulary: words are counted over all documents. The ``words`` most frequent have a token each. Any other
word, with a space before it, is cut into pieces, longest first from the left: one of the ``rare`` runs of 2 to
``piece`` bytes that save most tokens in the rare words of all documents, or a single byte. So no word shares
its tokens with another, and each piece is predicted from both sides, within its word and beyond it. Tokens
are dealt to ``classes`` round robin, and

    p(token | context) = p(class | context) p(token | class, context)

Network: each neighbour adds a vector of its token and place; the sum passes tanh and a softmax over the
classes; the second factor blends the token's corpus share in its class with its score by the same hidden
layer, normalised over the class, so every token is predicted from both sides at a cost of classes + class size.

Training: one pass over all documents, each task an epoch of minibatch gradient steps on every word of its
documents (a ``stride`` above 1 takes every so-manieth, from another offset in each round) from the same
start, then the mean of the tasks' weights, weighted by their words. The mean is a grouped sum over
parameters, so nothing but the final weights, of fixed size, reaches the driver. More rounds repeat this
from the mean.

Null, empty and wordless texts have no words and score 0, with a null mean. Words are runs between ASCII white
space, A-Z in lower case. Repeated rows are scored each. An empty table gives the untrained network.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsepanel.llm.common import arrow_map, sliced, written

#: Bytes of texts whose tokens are looked up at once.
ENCODED_BYTES = 1 << 23
#: Words cut at once.
CUT_WORDS = 1 << 13
#: Tokens scored at once.
SCORED = 4096
#: Uses of a token on one side within a batch from which on they are summed by themselves.
OFTEN = 16
#: Scores within this bound need no shift before their exponentials are summed in 32 bits.
EXP_SAFE = 80


@dataclass(frozen=True)
class Options:
    words: int = 1920
    rare: int = 1919
    classes: int = 64
    window: int = 3
    hidden: int = 24
    stride: int = 1
    batch: int = 2048
    rate: float = 0.1
    rounds: int = 1
    piece: int = 6

    @property
    def tokens(self) -> int:
        # the mask, which also stands beyond the ends, words, runs of bytes, and single bytes
        return 1 + self.words + self.rare + 256


@dataclass
class Model:
    options: Options
    index: dict[bytes, int]
    log_share: np.ndarray  # of each token within its class
    letter_cost: np.ndarray  # log-share of each byte in rare words; no score depends on it
    weights: dict[str, np.ndarray] = field(default_factory=dict)
    runs: dict[bytes, int] = field(default_factory=dict)  # tokens of runs of bytes

    @property
    def class_size(self) -> int:
        return -(-self.options.tokens // self.options.classes)


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts, one after another, and how many each text has."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.cast(pa.binary()).view(pa.string())))
    words = lists.flatten().view(pa.binary())
    counts = pc.list_value_length(lists).fill_null(0).to_numpy().astype(np.int64)
    # white space at an end of a text gives an empty word
    sizes = pc.binary_length(words).to_numpy()
    if not sizes.all():
        counts -= np.bincount(np.repeat(np.arange(len(counts)), counts)[sizes == 0], minlength=len(counts))
        words = words.filter(pa.array(sizes > 0))
    return words, counts


def _spaced(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all words with a space before each, and where each begins; the end is the last."""
    joined = pc.binary_join_element_wise(pa.scalar(b" "), words, pa.scalar(b""))
    _, offsets, data = joined.buffers()
    ends = np.frombuffer(offsets, np.int32)[joined.offset : joined.offset + len(joined) + 1].astype(np.int64)
    held = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None else np.empty(0, np.uint8)
    return held, ends - ends[0]


class Pieces:
    """Cuts words: longest runs first from the left, single bytes where none fits.

    The runs are a trie, one row of followers for each prefix. It is walked from all bytes of all words at
    once; then all words jump from piece to piece together.
    """

    def __init__(self, runs: dict[bytes, int], options: Options) -> None:
        self.options = options
        nodes: dict[bytes, int] = {b"": 0}
        for run in runs:
            for size in range(1, len(run) + 1):
                nodes.setdefault(run[:size], len(nodes) + 1)  # 1 is the node of no run
        # bytes of runs are numbered, so that the table is small; the others, and those of no run, are 0
        used = sorted(set(b"".join(runs)))
        self.number = np.zeros(256, np.uint8 if len(used) < 256 else np.uint16)
        self.number[used] = np.arange(1, len(used) + 1)
        self.width = len(used) + 1
        self.next = np.ones((len(nodes) + 1, self.width), np.min_scalar_type(len(nodes)))
        self.token = np.full(len(nodes) + 1, -1, np.int32)
        for prefix, node in nodes.items():
            if prefix:
                self.next[nodes[prefix[:-1]], self.number[prefix[-1]]] = node
            self.token[node] = runs.get(prefix, -1)
        self.next = self.next.ravel()

    def cut(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of all words, one word after another, and how many each has."""
        parts = [self._cut(words.slice(at, CUT_WORDS)) for at in range(0, max(1, len(words)), CUT_WORDS)]
        return np.concatenate([t for t, _ in parts]), np.concatenate([n for _, n in parts])

    def _cut(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        o = self.options
        held, ends = _spaced(words)
        # a space begins the next word and no run has one within, so that no run goes beyond its word
        numbers = self.number[np.concatenate([held, np.full(o.piece, 0x20, np.uint8)])]
        token = held.astype(np.int32) + (1 + o.words + o.rare)
        size = np.ones(len(held), np.int32)
        at = np.arange(len(held))
        node = self.next.take(numbers[: len(held)])
        for k in range(1, o.piece):
            alive = np.flatnonzero(node != 1)
            at = at.take(alive)
            node = self.next.take(node.take(alive).astype(np.intp) * self.width + numbers.take(at + k))
            found = self.token.take(node)
            hit = np.flatnonzero(found >= 0)
            where = at.take(hit)
            token[where], size[where] = found.take(hit), k + 1
        first = np.zeros(len(held), bool)
        at, end = ends[:-1], ends[1:]
        while len(at):
            first[at] = True
            at = at + size[at]
            left = at < end
            at, end = at[left], end[left]
        return token[first], np.diff(np.concatenate([[0], np.cumsum(first)])[ends])


class Tokens:
    """The tokens of words and texts: a word's own, or those of its pieces."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.pieces = Pieces(model.runs, model.options)
        self.words = pa.array(list(model.index), pa.binary())
        self.own = np.array(list(model.index.values()), np.int32)

    def __getitem__(self, word: bytes) -> tuple[int, ...]:
        return tuple(self.of_words(pa.array([word], pa.binary()))[0].tolist())

    def of_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of all words, one word after another, and how many each has."""
        at = pc.index_in(words, value_set=self.words).fill_null(-1).to_numpy()
        known = at >= 0
        cut, sizes = self.pieces.cut(words.filter(pa.array(~known)))
        counts = np.ones(len(words), np.int64)
        counts[~known] = sizes
        whole = np.repeat(known, counts)
        tokens = np.empty(len(whole), np.int32)
        tokens[whole], tokens[~whole] = self.own[at[known]], cut
        return tokens, counts

    def of_texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The tokens of all texts, one text after another, and how many tokens and words each has."""
        words, n_words = words_of(texts)
        coded = words.dictionary_encode()
        tokens, counts = self.of_words(coded.dictionary)
        which = coded.indices.to_numpy()
        mine = counts[which]
        ends = np.concatenate([[0], np.cumsum(mine)])
        begins = (np.cumsum(counts) - counts)[which] - ends[:-1]
        out = tokens[np.repeat(begins, mine) + np.arange(ends[-1])]
        return out, np.diff(ends[np.concatenate([[0], np.cumsum(n_words)])]), n_words


def start(model: Model) -> dict[str, np.ndarray]:
    """Weights before training: small and the same everywhere; class scores at the corpus shares."""
    o = model.options
    r = np.random.default_rng(11)
    return {
        "place": r.normal(0, 0.3, (2 * o.window, o.tokens, o.hidden)).astype(np.float32),
        "out": r.normal(0, 0.1, (o.hidden, o.classes)).astype(np.float32),
        "bias": np.zeros(o.classes, np.float32),
        "within": np.zeros((o.classes, o.hidden, model.class_size), np.float32),
    }


class Row:
    """Texts in a row with the mask between them."""

    def __init__(self, texts: list[np.ndarray], window: int) -> None:
        gap = np.zeros(window, np.int32)
        self.padded = np.concatenate([part for t in texts for part in (gap, t)] + [gap])
        lengths = np.array([len(t) for t in texts])
        self.at = np.arange(lengths.sum()) + np.repeat(window * np.arange(1, len(texts) + 1), lengths)
        self.sides = np.array([k for k in range(-window, window + 1) if k])

    def taken(self, which: np.ndarray | slice) -> tuple[np.ndarray, np.ndarray]:
        """Tokens, and those around each, left to right without it; the mask beyond the ends of its text."""
        at = self.at[which]
        return self.padded.take(at), self.padded.take(at[:, None] + self.sides)


def contexts(texts: list[np.ndarray], window: int) -> np.ndarray:
    """The tokens around each word of each text."""
    return Row(texts, window).taken(slice(None))[1]


def _exponentials(scores: np.ndarray) -> tuple[np.ndarray, np.ndarray | int]:
    """Of each row: the sum of exp(scores - shift), which replace the scores, and the shift."""
    shift = 0
    if not -EXP_SAFE < scores.min() <= scores.max() < EXP_SAFE:
        shift = scores.max(axis=1)
        scores -= shift[:, None]
    np.exp(scores, out=scores)
    return scores @ np.ones(scores.shape[1], scores.dtype), shift


def _places(scores: np.ndarray, own: np.ndarray) -> np.ndarray:
    return np.arange(0, scores.size, scores.shape[1]) + own


def _own_logs(scores: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Of each row: the log-softmax at its own column. The scores are used up."""
    mine = scores.ravel().take(_places(scores, own))
    total, shift = _exponentials(scores)
    return mine - np.log(total) - shift


def _own_gains(scores: np.ndarray, own: np.ndarray) -> np.ndarray:
    """The gradient of each row's log-softmax at its own column, in place of the scores."""
    total, _ = _exponentials(scores)
    scores *= (-1 / total)[:, None]
    scores.ravel()[_places(scores, own)] += 1
    return scores


class Network:
    """The weights laid out for batches of rows in the order of their classes.

    The hidden layer has a last value of 1, whose weights are the bias of a class and the share of a token, so
    each class is one product of its rows.
    ``place`` is trained where the weights hold it. Large arrays of a batch are kept for the next one.
    """

    def __init__(self, model: Model, weights: dict[str, np.ndarray]) -> None:
        o = self.options = model.options
        kind = weights["place"].dtype
        self.place = weights["place"].reshape(-1, o.hidden)
        self.out = np.vstack([weights["out"], weights["bias"]]).astype(kind)
        shares = model.log_share.reshape(model.class_size, o.classes).T  # class x place in class
        self.within = np.concatenate([weights["within"], shares[:, None]], axis=1).astype(kind)
        self.sides = np.arange(2 * o.window)[:, None] * o.tokens
        # of each class: its weights, those without the shares, and these turned
        self.by_class = [(w, w[:-1], w[:-1].T) for w in self.within]
        self.room: dict[str, np.ndarray] = {}

    def _array(self, name: str, rows: int, columns: int) -> np.ndarray:
        """Room for an array, with any values."""
        if name not in self.room or self.room[name].size < rows * columns:
            self.room[name] = np.empty(rows * columns, self.place.dtype)
        return self.room[name][: rows * columns].reshape(rows, columns)

    def weights(self) -> dict[str, np.ndarray]:
        o = self.options
        return {
            "place": self.place.reshape(-1, o.tokens, o.hidden),
            "out": self.out[:-1],
            "bias": self.out[-1],
            "within": self.within[:, :-1],
        }

    def _dealt(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int, int]]]:
        """The rows by class, their classes, and the (class, begin, end) of those that have rows."""
        o = self.options
        which = (tokens % o.classes).astype(np.min_scalar_type(o.classes))
        order = np.argsort(which, kind="stable")
        ends = np.cumsum(np.bincount(which, minlength=o.classes)).tolist()
        return order, which[order], [(c, a, b) for c, (a, b) in enumerate(zip([0, *ends], ends)) if a < b]

    def _hidden(self, seen: np.ndarray) -> np.ndarray:
        n, size = seen.shape[1], self.options.hidden
        total, more = self._array("total", n, size), self._array("more", n, size)
        # every token is within the table: ``clip`` only spares a copy
        self.place.take(seen[0], axis=0, out=total, mode="clip")
        for side in seen[1:]:
            total += self.place.take(side, axis=0, out=more, mode="clip")
        hidden = self._array("hidden", n, size + 1)
        np.tanh(total, out=hidden[:, :-1])
        hidden[:, -1] = 1
        return hidden

    def _class_scores(self, hidden: np.ndarray) -> np.ndarray:
        """The scores of the classes for each row."""
        return np.dot(hidden, self.out, out=self._array("scores", len(hidden), self.out.shape[1]))

    def _token_scores(self, hidden: np.ndarray, parts: list[tuple[int, int, int]]) -> np.ndarray:
        """The scores of the tokens of its class for each row, where those of the classes were."""
        scores = self._array("scores", len(hidden), self.within.shape[2])
        for c, a, b in parts:
            np.dot(hidden[a:b], self.by_class[c][0], out=scores[a:b])
        return scores

    def _seen(self, around: np.ndarray, order: np.ndarray) -> np.ndarray:
        """The rows of ``place`` that each row adds up, a line for each side."""
        return around.take(order, axis=0).T + self.sides

    def log_likelihood(self, tokens: np.ndarray, around: np.ndarray) -> np.ndarray:
        """log p(token | context) of each token."""
        order, which, parts = self._dealt(tokens)
        hidden = self._hidden(self._seen(around, order))
        own = tokens[order] // self.options.classes
        out = np.empty(len(tokens), hidden.dtype)
        out[order] = _own_logs(self._class_scores(hidden), which) + _own_logs(self._token_scores(hidden, parts), own)
        return out

    def step(self, tokens: np.ndarray, around: np.ndarray, rate: float) -> None:
        """One gradient step up the mean log-likelihood of a batch."""
        n = len(tokens)
        order, which, parts = self._dealt(tokens)
        seen = self._seen(around, order)
        hidden = self._hidden(seen)
        d_hidden, through = self._array("total", n, hidden.shape[1] - 1), self._array("more", n, hidden.shape[1] - 1)
        d_class = _own_gains(self._class_scores(hidden), which)
        np.dot(d_class, self.out[:-1].T, out=d_hidden)
        self.out += rate / n * (hidden.T @ d_class)
        d_token = _own_gains(self._token_scores(hidden, parts), tokens[order] // self.options.classes)
        rated = rate * 4 / n * hidden[:, :-1]
        change = np.empty_like(self.within[0, :-1])
        for c, a, b in parts:
            _, weights, turned = self.by_class[c]
            mine = d_token[a:b]
            np.dot(mine, turned, out=through[a:b])
            np.dot(rated[a:b].T, mine, out=change)
            weights += change
        d_hidden += through
        np.multiply(hidden[:, :-1], hidden[:, :-1], out=through)
        through -= 1
        through *= -rate * 8 / n
        d_hidden *= through
        self._add(seen, d_hidden)

    def _add(self, seen: np.ndarray, d_hidden: np.ndarray) -> None:
        """Adds each row of ``d_hidden`` to those of ``place`` that it was summed from."""
        keys = seen.ravel().astype(np.min_scalar_type(len(self.place)))
        order = np.argsort(keys, kind="stable")  # one sort of all sides
        keys, rows = keys.take(order), np.tile(np.arange(len(d_hidden)), len(seen)).take(order)
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        uses = np.diff(np.concatenate([first, [len(keys)]]))
        few = np.minimum(uses, OFTEN + 1)
        most = np.argsort((OFTEN + 1 - few).astype(np.uint8), kind="stable")
        which = keys[first].astype(np.intp)[most]
        moved = self.place.take(which, axis=0)
        # ends[k]: so many have more than k uses
        ends = (len(few) - np.cumsum(np.bincount(few, minlength=OFTEN + 2))).tolist()
        often = ends[OFTEN]
        # of most rows a few uses each: the first use of all, the second of those that have one, and so on
        at = first[most[often:]]
        for k in range(OFTEN):
            mine = ends[k] - often
            moved[often : ends[k]] += d_hidden.take(rows[at[:mine] + k], axis=0)
        if often:
            spans = [rows[a : a + n] for a, n in zip(first[most[:often]].tolist(), uses[most[:often]].tolist())]
            begins = np.cumsum([0, *(len(x) for x in spans[:-1])])
            moved[:often] += np.add.reduceat(d_hidden.take(np.concatenate(spans), axis=0), begins, axis=0)
        # a row as one value, which is copied faster
        row = np.dtype((np.void, moved.strides[0]))
        self.place.view(row).ravel()[which] = moved.view(row).ravel()


def log_likelihood(model: Model, weights: dict, tokens: np.ndarray, around: np.ndarray) -> np.ndarray:
    """log p(token | context) of each token."""
    return Network(model, weights).log_likelihood(tokens, around)


def step(model: Model, weights: dict, tokens: np.ndarray, around: np.ndarray, rate: float) -> None:
    """One gradient step up the mean log-likelihood of a batch, in place."""
    network = Network(model, weights)
    network.step(tokens, around, rate)
    weights.update(network.weights())


# --- counting and training over the corpus ----------------------------------------------------


def _word_counts(rows: DataFrame) -> DataFrame:
    """word, uses over all documents; summed in each batch first."""

    def run(batch: pa.RecordBatch) -> dict:
        words, n = words_of(batch.column(0))[0].value_counts().flatten()
        return {"word": words, "n": n}

    return arrow_map(rows, run, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def _run_counts(words: pa.Array, uses: np.ndarray, longest: int) -> dict:
    """run, n: uses of the runs of 2 to so many bytes of words with a space before each."""
    held, ends = _spaced(words)
    padded = np.concatenate([held, np.zeros(8 + longest, np.uint8)])
    # places in the order of the bytes that follow: the same runs of any size stand together
    keys = []
    for begin in range(0, longest, 8):
        keys.append(np.zeros(len(held), np.uint64))
        for k in range(min(8, longest - begin)):
            keys[-1] |= padded[begin + k : begin + k + len(held)].astype(np.uint64) << np.uint64(56 - 8 * k)
    order = np.argsort(keys[0]) if len(keys) == 1 else np.lexsort(keys[::-1])
    left = (np.repeat(ends[1:], np.diff(ends)) - np.arange(len(held)))[order]  # bytes of the word from there on
    weight = np.repeat(uses, np.diff(ends))[order]
    runs, counts = [pa.array([], pa.binary())], [np.empty(0, np.int64)]
    new = np.arange(len(held)) == 0
    for size in range(1, longest + 1) if len(held) else ():
        last = padded[order + (size - 1)]
        new[1:] |= last[1:] != last[:-1]
        if size > 1:
            first = np.flatnonzero(new)
            # the bytes reach into the next word, but places with fewer bytes left in theirs count nothing
            n = np.add.reduceat(np.where(left >= size, weight, 0), first)
            used = np.flatnonzero(n)
            found = padded[order[first[used]][:, None] + np.arange(size)]
            offsets = pa.py_buffer(np.arange(len(used) + 1, dtype=np.int32) * np.int32(size))
            runs.append(pa.Array.from_buffers(pa.binary(), len(used), [None, offsets, pa.py_buffer(found.tobytes())]))
            counts.append(n[used])
    return {"run": pa.concat_arrays(runs), "n": np.concatenate(counts)}


def _vocabulary(rows: DataFrame, options: Options) -> Model:
    counts = written(_word_counts(rows), "word_counts")
    # options.words rows at most
    top = counts.orderBy(F.col("n").desc(), "word").limit(options.words).collect()
    index = {bytes(r.word): i + 1 for i, r in enumerate(top)}
    n = np.zeros(options.tokens, float)
    n[1 : 1 + len(top)] = [r.n for r in top]
    context = rows.sparkSession.sparkContext
    shared = context.broadcast(list(index))

    def rare(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = batch.column(0).cast(pa.binary())
        known = pc.is_in(words, value_set=pa.array(shared.value, pa.binary()))
        return pa.RecordBatch.from_arrays([words, batch.column(1)], names=["word", "n"]).filter(pc.invert(known))

    def substrings(batch: pa.RecordBatch) -> dict:
        batch = rare(batch)
        return _run_counts(batch.column(0), batch.column(1).to_numpy(), options.piece)

    # options.rare rows at most: those that save most tokens
    best = (
        arrow_map(counts, substrings, "run binary, n bigint")
        .groupBy("run")
        .agg(F.sum("n").alias("n"))
        .orderBy((F.col("n") * (F.length("run") - 1)).desc(), "run")
        .limit(options.rare)
        .collect()
    )
    first = 1 + options.words
    runs = {bytes(r.run): first + i for i, r in enumerate(best)}
    known = context.broadcast(runs)

    def uses(batch: pa.RecordBatch) -> dict:
        mine, bytes_used = np.zeros(options.rare + 256, np.int64), np.zeros(257, np.int64)
        batch = rare(batch)
        k = batch.column(1).to_numpy()
        tokens, sizes = Pieces(known.value, options).cut(batch.column(0))
        np.add.at(mine, tokens - first, np.repeat(k, sizes))
        held, ends = _spaced(batch.column(0))
        np.add.at(bytes_used, held, np.repeat(k, np.diff(ends)))
        bytes_used[0x20] = 0  # no word has one within
        bytes_used[256] = k.sum()
        n_uses = np.concatenate([mine, bytes_used])
        return {"what": np.arange(len(n_uses)), "n": n_uses}

    # options.rare + 513 sums
    sums = arrow_map(counts, uses, "what int, n bigint").groupBy("what").agg(F.sum("n").alias("n"))
    used = np.zeros(options.rare + 513)
    for row in sums.collect():
        used[row.what] = row.n
    n[first:] = used[: options.rare + 256]
    bytes_used = used[options.rare + 256 :] + 0.5
    size = -(-options.tokens // options.classes)
    share = np.full(size * options.classes, 1e-9)
    share[: len(n)] = n + 0.5
    share = share.reshape(size, options.classes)
    log_share = np.log(share / share.sum(axis=0)).ravel().astype(np.float32)
    model = Model(options, index, log_share, np.log(bytes_used / bytes_used.sum()))
    model.weights, model.runs = start(model), runs
    by_class = share.sum(axis=0)
    model.weights["bias"] = np.log(by_class / by_class.sum()).astype(np.float32)
    return model


def _packed(weights: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([weights[k].ravel() for k in sorted(weights)])


def _unpacked(flat: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k in sorted(like):
        out[k] = flat[at : at + like[k].size].reshape(like[k].shape).astype(np.float32)
        at += like[k].size
    return out


def _round(rows: DataFrame, model: Model, number: int, chunk: int = 64) -> np.ndarray | None:
    """The weighted mean of the weights after an epoch in each task."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = shared.value
        o = m.options
        network = Network(m, {k: v.copy() for k, v in m.weights.items()})
        memo, trained = _memo(m), 0

        def learn(texts: list[np.ndarray]) -> int:
            # another offset in each round, all of them in ``stride`` rounds; every document has words in each
            taken = [np.arange(len(t)) % o.stride == number % min(o.stride, len(t)) for t in texts]
            mine = np.flatnonzero(np.concatenate(taken))
            row = Row(texts, o.window)
            mix = mine[np.random.default_rng(len(mine)).permutation(len(mine))]
            for at in range(0, len(mix), o.batch):
                some = mix[at : at + o.batch]
                network.step(*row.taken(some), o.rate * len(some) / 16)
            return len(mine)

        for batch in batches:
            for texts in _in_lots(batch.column(0), memo, 1 << 17):
                trained += learn(held) if (held := [t for t, _ in texts if len(t)]) else 0
        if trained:
            flat = _packed(network.weights()).astype(np.float64) * trained
            pad = -len(flat) % chunk
            parts = np.concatenate([flat, np.zeros(pad)]).reshape(-1, chunk)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(len(parts)), pa.int32()),
                    pa.array(np.full(len(parts), trained), pa.int64()),
                    pa.array(list(parts), pa.list_(pa.float64())),
                ],
                names=["part", "n", "sums"],
            )

    parts = rows.mapInArrow(run, "part int, n bigint, sums array<double>")
    # one row for each chunk of weights: sums by position, partial in each task
    sums = [F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(chunk)]
    mean = parts.groupBy("part").agg(F.sum("n").alias("n"), *sums).toPandas().sort_values("part")
    if not len(mean):
        return None
    flat = mean[[f"s{i}" for i in range(chunk)]].to_numpy() / mean[["n"]].to_numpy()
    return flat.ravel()


def fit(docs: DataFrame, options: Options = Options(), text_col: str = "text") -> Model:
    """Count the corpus, then train on it."""
    rows = docs.select(F.col(f"`{text_col}`").cast("string").cast("binary").alias("text"))
    model = _vocabulary(rows, options)
    for number in range(options.rounds):
        flat = _round(rows, model, number)
        if flat is None:
            break
        model.weights = _unpacked(flat[: _packed(model.weights).size], model.weights)
    return model


def _in_lots(texts: pa.Array, memo: Tokens, words: int) -> Iterator[list[tuple]]:
    """(tokens, words) of texts, in lists of at least so many tokens."""
    lot, size = [], 0
    for part in sliced(pa.RecordBatch.from_arrays([texts], names=["text"]), ENCODED_BYTES):
        tokens, n_tokens, n_words = memo.of_texts(part.column(0))
        for mine, n in zip(np.split(tokens, np.cumsum(n_tokens)[:-1]), n_words.tolist()):
            lot.append((mine, n))
            size += len(mine)
            if size >= words:
                yield lot
                lot, size = [], 0
    if lot:
        yield lot


def text_scores(model: Model, texts: list[bytes | None] | pa.Array, memo: Tokens) -> tuple[list[int], list[float]]:
    """Words and summed conditional log-probabilities of each text."""
    counts: list[int] = []
    scores: list[float] = []
    network = Network(model, model.weights)
    texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.binary())
    for lot in _in_lots(texts, memo, 1 << 16):
        held = [t for t, _ in lot if len(t)]
        values = np.empty(0)
        if held:
            row = Row(held, model.options.window)
            pieces = [
                network.log_likelihood(*row.taken(slice(at, at + SCORED))) for at in range(0, len(row.at), SCORED)
            ]
            values = np.concatenate(pieces).astype(float)
        ends = np.cumsum([0, *(len(t) for t, _ in lot)])
        sums = np.concatenate([[0.0], np.cumsum(values)])[ends]
        counts += [n for _, n in lot]
        scores += np.diff(sums).tolist()
    return counts, scores


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, log_likelihood, mean_log_likelihood of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> dict:
        counts, scores = text_scores(shared.value, batch.column(1), _memo(shared.value))
        means = [s / n if n else None for s, n in zip(scores, counts)]
        return {
            "doc_id": batch.column(0), "n_words": counts,
            "log_likelihood": scores, "mean_log_likelihood": means,
        }

    kind = docs.select(F.col(f"`{id_col}`")).schema[0].dataType.simpleString()
    rows = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`").cast("string").cast("binary"))
    return arrow_map(
        rows,
        run,
        f"doc_id {kind}, n_words bigint, log_likelihood double, mean_log_likelihood double",
    )


_MEMO: list[Tokens] = []


def _memo(model: Model) -> Tokens:
    """The worker's memo for this model."""
    if not _MEMO or _MEMO[0].model is not model:
        _MEMO[:] = [Tokens(model)]
    return _MEMO[0]
