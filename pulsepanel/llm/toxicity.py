"""Toxicity by maximum-scoring segments over token log-odds.

Learning, from labelled rows outside the held-out fifth (at most ``max_labelled`` of them, chosen by a hash
of the id; of equal texts with one label one counts):

1. For each token the number of toxic and of clean texts that hold it. Log-odds with an informative
   Dirichlet prior: each class gets pseudo-texts that follow the token's overall share, so rare tokens
   shrink to 0. Tokens whose log-odds are above ``min_odds`` and ``min_z`` standard errors form the lexicon;
   then the same for prefixes of the tokens that are not in it, which reaches inflected forms.
2. A token's score is its log-odds, or those of its longest known prefix; every other token scores a small
   negative constant, chosen so that the expected score of clean text is negative.
3. Best segments of clean texts follow an extreme-value law. ``lam`` solves sum p(s) e^(lam s) = 1
   over clean tokens; a segment of score S in a text of n tokens is expected n K e^(-lam S) times by
   chance, with K set by the clean texts' best segments. The evidence of a text is the sum over its
   significant segments of lam S - ln(n K); one logistic curve turns it into a probability.

Scoring: one linear scan finds all maximal segments of a text (runs between lexicon tokens are summed at
once). The model holds at most ``max_terms`` tokens and travels with the tasks.

Tokens are runs of ASCII letters, digits and non-ASCII characters, lower-cased in A-Z. Null and empty
texts have no segment and get the score of a text without evidence. Repeated rows are scored each; an id
with two labels counts as toxic. Without labels, or with one class only, every score is 0.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from pulsepanel.llm.common import SLICE_BYTES, arrow_map, sliced, written
from pulsepanel.llm.words import MEMO_ENTRIES, alnum_words

#: Labelled rows that a model is learned from at most.
MAX_LABELLED = 20_000
#: Tokens in a model at most: those with the largest log-odds in standard errors.
MAX_TERMS = 50_000
#: Lengths of the beginnings of tokens that are features of their own.
PREFIXES = (6, 5, 4)


@dataclass(frozen=True)
class Model:
    scores: dict[bytes, float] = field(default_factory=dict)
    other: float = -0.1
    lam: float = 1.0
    log_k: float = 0.0
    slope: float = 0.0
    offset: float = -math.inf
    significance: float = 0.05


def segments(scores: list[tuple[int, float]], other: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score) of a sequence, in one linear scan.

    ``scores``: position and score of the tokens that do not score ``other`` (< 0). A segment is maximal
    when no longer or shorter one that overlaps it scores more. Each candidate carries the sums before and
    behind it; a new one swallows earlier candidates as long as that raises its score.
    """
    found: list[tuple[int, int, float, float]] = []  # start, end, sum before it, sum behind it
    total, at = 0.0, 0
    for position, score in scores:
        total += other * (position - at)
        at = position + 1
        if score <= 0:
            total += score
            continue
        start, before = position, total
        total += score
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= before:
                j -= 1
            if j < 0 or found[j][3] >= total:
                found.append((start, position + 1, before, total))
                break
            start, before = found[j][0], found[j][2]
            del found[j:]
    return [(a, b, behind - before) for a, b, before, behind in found]


def prefixes(token: bytes) -> list[bytes]:
    """The token's beginnings that are features of their own, marked by ``*``, longest first."""
    letters = token.decode("utf-8", "replace")
    return [letters[:n].encode() + b"*" for n in PREFIXES if len(letters) > n]


class TokenScores(dict):
    """token -> its score, 0 if it is in no way known; a bounded memo over a lexicon."""

    def __init__(self, lexicon: dict[bytes, float]) -> None:
        super().__init__()
        self.lexicon = lexicon

    def __missing__(self, token: bytes) -> float:
        known = [token, *prefixes(token)]
        score = next((self.lexicon[k] for k in known if k in self.lexicon), 0.0)
        if len(self) >= MEMO_ENTRIES:
            self.clear()
        self[token] = score
        return score

    def hits(self, words: list[bytes]) -> list[tuple[int, float]]:
        return [(i, s) for i, s in enumerate(map(self.__getitem__, words)) if s]


def evidence(
    words: list[bytes], model: Model, scores: TokenScores
) -> tuple[float, list[tuple[int, int, float]]]:
    """Summed evidence of the significant segments of a text, and these segments."""
    hits = scores.hits(words)
    if not hits:
        return 0.0, []
    expected = math.log(len(words)) + model.log_k
    floor = -math.log(model.significance)
    good, total = [], 0.0
    for a, b, s in segments(hits, model.other):
        value = model.lam * s - expected
        if value > floor:
            good.append((a, b, value))
            total += value
    if not good:  # the best one, so that weak evidence still ranks
        best = max((s for _, _, s in segments(hits, model.other)), default=0.0)
        total = max(0.0, min(floor, model.lam * best - expected))
    return total, good


def probability(value: float, model: Model) -> float:
    x = model.offset + model.slope * math.log1p(value)
    return 0.0 if x < -700 else 1.0 / (1.0 + math.exp(-x))


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve, by Newton's method with a small ridge."""
    a = np.column_stack([x, np.ones_like(x)])
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        hess = (a * (p * (1 - p))[:, None]).T @ a + 1e-3 * np.eye(2)
        step = np.linalg.solve(hess, a.T @ (y - p) - 1e-3 * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def _root(scores: np.ndarray, share: np.ndarray) -> float:
    """The positive solution of sum share * e^(lam * scores) = 1."""
    low, high = 0.0, 1.0
    f = lambda lam: float(np.sum(share * np.exp(np.minimum(lam * scores, 500)))) - 1
    while f(high) < 0 and high < 64:
        high *= 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if f(mid) < 0 else (low, mid)
    return max(low, 1e-3)


def held_out(doc_id: Column) -> Column:
    """Rows whose labels nobody learns from: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def _labelled(docs: DataFrame, labels: DataFrame, max_labelled: int) -> DataFrame:
    """text (binary), toxic of the rows to learn from; at most max_labelled ids are broadcast."""
    rows = (
        labels.select(F.col("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_labelled)
    )
    text = F.col("text").cast("string").cast("binary").alias("text")
    found = docs.select("doc_id", text).join(F.broadcast(rows), "doc_id").select("text", "toxic")

    # equal texts with one label count once
    return written(found.distinct(), "toxicity_labelled")


def _token_counts(labelled: DataFrame, lexicon: dict[bytes, float] | None = None) -> DataFrame:
    """token, number of toxic and clean texts that hold it, and its uses in clean texts.

    With a lexicon: of the prefixes of tokens outside it. The empty token counts texts and words.
    """

    def run(batch: pa.RecordBatch) -> dict:
        texts: tuple[Counter, Counter] = (Counter(), Counter())
        uses: Counter = Counter()
        for blob, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = Counter(alnum_words(blob or b""))
            n = words.total()
            if lexicon is not None:
                begun: Counter = Counter()
                for word, k in words.items():
                    for prefix in prefixes(word) if word not in lexicon else ():
                        begun[prefix] += k
                words = begun
            texts[toxic].update(words.keys())
            texts[toxic][b""] += 1
            if not toxic:
                uses.update(words)
                uses[b""] += n
        tokens = list(texts[0].keys() | texts[1].keys())
        return {
            "token": tokens,
            "toxic": [texts[1][t] for t in tokens],
            "clean": [texts[0][t] for t in tokens],
            "uses": [uses[t] for t in tokens],
        }

    parts = arrow_map(labelled, run, "token binary, toxic bigint, clean bigint, uses bigint")
    return parts.groupBy("token").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"), F.sum("uses").alias("uses")
    )


def _terms(
    counts: DataFrame, texts: tuple[int, int], prior_share: float, min_z: float, min_odds: float, most: int
) -> list[Row]:
    """token, odds, uses of the significant tokens, at most ``most``; texts: toxic and clean ones."""
    n_toxic, n_clean = (float(n) for n in texts)
    prior = prior_share * (n_toxic + n_clean)
    share = (F.col("toxic") + F.col("clean")) / (n_toxic + n_clean)
    a, b = F.col("toxic") + share * prior, F.col("clean") + share * prior
    odds = F.log(a / (n_toxic + prior - a + 0.5)) - F.log(b / (n_clean + prior - b + 0.5))
    error = F.sqrt(1 / a + 1 / b)
    return (
        counts.where((F.col("token") != b"") & (F.col("toxic") >= 3))
        .select("token", "uses", odds.alias("odds"), (odds / error).alias("z"))
        .where((F.col("z") >= min_z) & (F.col("odds") >= min_odds))
        .orderBy(F.col("z").desc(), "token")
        .limit(most)
        .collect()
    )


def fit(
    docs: DataFrame,
    labels: DataFrame,
    max_labelled: int = MAX_LABELLED,
    max_terms: int = MAX_TERMS,
    prior_share: float = 0.02,
    min_z: float = 3.5,
    min_odds: float = 2.0,
) -> Model:
    """Learn a model. ``prior_share``: pseudo-texts of a class as a share of the labelled texts."""
    labelled = _labelled(docs, labels, max_labelled)
    counts = written(_token_counts(labelled), "toxicity_tokens")
    totals = counts.where(F.col("token") == b"").collect()
    if not totals or not totals[0].toxic or not totals[0].clean:
        return Model()
    texts, n_uses = (totals[0].toxic, totals[0].clean), max(1, totals[0].uses)
    terms = _terms(counts, texts, prior_share, min_z, min_odds, max_terms // 2)
    scores = {bytes(t.token): float(t.odds) for t in terms}
    begun = written(_token_counts(labelled, scores), "toxicity_prefixes")
    terms += _terms(begun, texts, prior_share, min_z, min_odds, max_terms // 2)
    scores |= {bytes(t.token): float(t.odds) for t in terms if bytes(t.token) not in scores}
    if not scores:
        return Model()
    # clean text: shares of the lexicon, all others score `other`; twice what makes the mean 0
    used = np.array([t.uses for t in terms] + [0.5], float) / n_uses
    values = np.array([t.odds for t in terms] + [max(scores.values())])
    other = -max(0.05, 2.0 * float(np.sum(used * values)))
    share = np.append(used, max(1e-9, 1.0 - float(used.sum())))
    lam = min(4.0, _root(np.append(values, other), share / share.sum()))

    def best(batch: pa.RecordBatch) -> dict:
        memo = TokenScores(scores)
        tops, sizes = [], []
        for blob in batch.column(0).to_pylist():
            words = alnum_words(blob or b"")
            tops.append(lam * max((s for *_, s in segments(memo.hits(words), other)), default=0.0))
            sizes.append(len(words))
        return {"top": tops, "n": sizes, "toxic": batch.column(1)}

    # figures of at most max_labelled rows
    tops = arrow_map(labelled, best, "top double, n bigint, toxic int").toPandas()
    clean = tops[(tops.toxic == 0) & (tops.n > 0)]
    # Gumbel: the mean of lam S - ln n over clean texts is ln K + Euler's constant
    log_k = float(np.mean(clean.top - np.log(clean.n))) - 0.5772 if len(clean) else 0.0
    model = Model(scores, other, lam, log_k)

    def values_of(batch: pa.RecordBatch) -> dict:
        memo = TokenScores(scores)
        texts = batch.column(0).to_pylist()
        return {
            "value": [evidence(alnum_words(b or b""), model, memo)[0] for b in texts],
            "toxic": batch.column(1),
        }

    learned = arrow_map(labelled, values_of, "value double, toxic int").toPandas()
    slope, offset = _logistic(np.log1p(learned.value.to_numpy()), learned.toxic.to_numpy(float))
    return Model(scores, other, lam, log_k, slope, offset)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score, and the significant passages of each text.

    ``passages`` are (start, end, evidence) in tokens.
    """

    def run(batch: pa.RecordBatch) -> dict:
        scores, passages = [], []
        memo = TokenScores(model.scores)
        for blob in batch.column(1).to_pylist():
            value, good = evidence(alnum_words(blob or b""), model, memo)
            scores.append(probability(value, model))
            passages.append([{"start": a, "end": b, "evidence": v} for a, b, v in good])
        return {"doc_id": batch.column(0), "score": scores, "passages": passages}

    kind = docs.select(F.col(f"`{id_col}`")).schema[0].dataType.simpleString()
    rows = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`").cast("string").cast("binary"))
    return arrow_map(
        rows,
        run,
        f"doc_id {kind}, score double, "
        "passages array<struct<start: bigint, end: bigint, evidence: double>>",
    )


def keep_clean(docs: DataFrame, model: Model, limit: float = 0.5) -> DataFrame:
    """The rows of a table whose text scores below the limit, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = TokenScores(model.scores)
        for batch in (part for whole in batches for part in sliced(whole, SLICE_BYTES)):
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            keep = [
                probability(evidence(alnum_words((t or "").encode()), model, memo)[0], model) < limit
                for t in texts
            ]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
