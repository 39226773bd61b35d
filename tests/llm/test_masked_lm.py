"""The network is a distribution, its steps follow the gradient, and order matters to its scores."""

import random
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from pulsepanel.llm import masked_lm as lm
from pulsepanel.llm import registry

SMALL = lm.Options(words=20, rare=3, classes=4, window=2, hidden=5, stride=1, batch=64)


def small_model():
    size = -(-SMALL.tokens // SMALL.classes)
    r = np.random.default_rng(1)
    share = r.random((size, SMALL.classes)) + 0.1
    share.ravel()[SMALL.tokens :] = 1e-9
    log_share = np.log(share / share.sum(axis=0)).ravel().astype(np.float32)
    model = lm.Model(SMALL, {f"w{i}".encode(): i + 1 for i in range(20)}, log_share, np.full(257, -5.0))
    model.weights = {k: r.normal(0, 0.5, v.shape).astype(np.float64) for k, v in lm.start(model).items()}
    return model


def test_probabilities_of_all_tokens_sum_to_one():
    model = small_model()
    around = np.array([[1, 2, 3, 4]])
    every = np.arange(SMALL.classes * model.class_size)
    values = lm.log_likelihood(model, model.weights, every, np.repeat(around, len(every), axis=0))
    assert np.exp(values).sum() == pytest.approx(1, abs=1e-5)


def test_steps_follow_the_gradient():
    model = small_model()
    r = np.random.default_rng(2)
    tokens, around = r.integers(1, 24, 30), r.integers(0, 24, (30, 4))
    before = lm.log_likelihood(model, model.weights, tokens, around).mean()
    moved = {k: v.copy() for k, v in model.weights.items()}
    lm.step(model, moved, tokens, around, 1e-3)
    after = lm.log_likelihood(model, moved, tokens, around).mean()
    assert after > before
    # the step's own prediction of its gain: squared gradients over the rates of the parts
    rates = {"place": 8e-3, "out": 1e-3, "bias": 1e-3, "within": 4e-3}
    gain = sum(float(((moved[k] - model.weights[k]) ** 2).sum()) / rates[k] for k in rates)
    assert after - before == pytest.approx(gain, rel=0.1)


def test_contexts_do_not_cross_texts():
    around = lm.contexts([np.array([5, 6, 7], np.int32), np.array([8], np.int32)], 2)
    assert around.tolist() == [[0, 0, 6, 7], [0, 5, 7, 0], [5, 6, 0, 0], [0, 0, 0, 0]]


def test_order_matters(spark):
    r = random.Random(4)
    def text():
        return " ".join(f"{r.choice('abcd')} is {r.choice('xyz')} of {r.choice('mn')} ." for _ in range(30))
    docs = spark.createDataFrame([(i, text()) for i in range(400)], "doc_id long, text string")
    model = lm.fit(docs, lm.Options(words=30, rare=5, classes=8, stride=1, batch=128, rounds=2))
    fresh = [text() for _ in range(20)]
    mixed = [" ".join(r.sample(t.split(), len(t.split()))) for t in fresh]
    _, good = lm.text_scores(model, [t.encode() for t in fresh], lm.Tokens(model))
    _, bad = lm.text_scores(model, [t.encode() for t in mixed], lm.Tokens(model))
    assert all(g > b for g, b in zip(good, bad))


def test_every_word_is_trained_by_default(spark):
    rows = [(i, "go on p then q" if i % 2 else "go on r then s") for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = lm.fit(docs, lm.Options(words=30, rare=5, classes=8, batch=128))
    texts = [b"go on p then q", b"go on r then s", b"go on p then s", b"go on r then q"]
    a, b, c, d = lm.text_scores(model, texts, lm.Tokens(model))[1]
    # the third and fifth word tell each other, though none of them stands first in a text
    assert a + b > c + d + 2


def test_rare_words_are_predicted_from_both_sides(spark):
    # 'stone' and 'notes' are beyond the vocabulary, have the same letters, and share the only rare run
    rows = [(i, "aa bb stone bb aa" if i % 2 else "cc bb notes bb cc") for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = lm.fit(docs, lm.Options(words=3, rare=1, classes=8, batch=128, rounds=2, stride=1))
    texts = [b"aa bb stone bb aa", b"cc bb notes bb cc", b"cc bb stone bb cc", b"aa bb notes bb aa"]
    counts, (a, b, c, d) = lm.text_scores(model, texts, lm.Tokens(model))
    assert counts == [5] * 4 and a + b > c + d + 2
    assert lm.Tokens(model)[b"stone"] != lm.Tokens(model)[b"notes"]


def test_a_text_scores_the_same_in_any_company():
    model = small_model()
    texts = [b"w1 w2 w3 odd", b"", b"w4", None, b"w5 w5 w5 w6 strange words"]
    counts, scores = lm.text_scores(model, texts, lm.Tokens(model))
    assert counts == [4, 0, 1, 0, 6] and scores[1] == scores[3] == 0
    for t, s in zip(texts, scores):
        assert lm.text_scores(model, [t], lm.Tokens(model))[1][0] == pytest.approx(s, abs=1e-4)


def test_odd_rows_and_query(spark, sf_dir, odd_documents, no_documents):
    model = lm.fit(odd_documents, SMALL)
    rows = lm.score(odd_documents, model).collect()
    assert len(rows) == odd_documents.count()
    assert all((r.log_likelihood, r.mean_log_likelihood) == (0, None) for r in rows if r.doc_id in (2, 3, 4))
    assert lm.score(no_documents, lm.fit(no_documents, SMALL)).count() == 0
    scored = registry.QUERIES["op2_masked_scores"](spark, sf_dir).collect()
    assert all(r.log_likelihood < 0 for r in scored if r.n_words)


def plain_step(model, weights, tokens, around, rate):
    """The step as it is written down, without a thought of its cost."""
    o, n, rows = model.options, len(tokens), np.arange(len(tokens))
    which, place = tokens % o.classes, tokens // o.classes
    hidden = np.tanh(sum(weights["place"][k][around[:, k]] for k in range(around.shape[1])))

    def missed(scores, own):
        p = np.exp(scores - scores.max(axis=1, keepdims=True))
        p /= -p.sum(axis=1, keepdims=True)
        p[rows, own] += 1
        return p

    d_class = missed(hidden @ weights["out"] + weights["bias"], which)
    shares = model.log_share.reshape(-1, o.classes).T[which]
    d_token = missed(np.einsum("nh,nhs->ns", hidden, weights["within"][which]) + shares, place)
    d_hidden = d_class @ weights["out"].T + np.einsum("ns,nhs->nh", d_token, weights["within"][which])
    out = {k: v.copy() for k, v in weights.items()}
    np.add.at(out["within"], which, 4 * rate / n * hidden[:, :, None] * d_token[:, None, :])
    out["out"] += rate / n * hidden.T @ d_class
    out["bias"] += rate / n * d_class.sum(axis=0)
    for k in range(around.shape[1]):
        np.add.at(out["place"][k], around[:, k], 8 * rate / n * d_hidden * (1 - hidden**2))
    return out


@pytest.mark.parametrize("scale", [1, 300])
def test_a_step_is_the_plain_one(scale):
    # with 300 the scores are beyond what exp takes
    model = small_model()
    model.weights["out"] *= scale
    r = np.random.default_rng(3)
    tokens = r.integers(0, SMALL.tokens, 500)
    around = np.minimum(r.geometric(0.03, (500, 4)), SMALL.tokens - 1).astype(np.int32)
    around[:400, 1] //= 4
    uses = np.bincount(around[:, 1])
    assert uses.max() > lm.OFTEN and np.count_nonzero(uses == 1) > 5
    want = plain_step(model, model.weights, tokens, around, 0.5)
    got = {k: v.copy() for k, v in model.weights.items()}
    assert scale == 1 or abs(got["out"]).sum(axis=0).max() > 2 * lm.EXP_SAFE
    lm.step(model, got, tokens, around, 0.5)
    for k, v in want.items():
        np.testing.assert_allclose(got[k], v, rtol=1e-9, atol=1e-9, err_msg=k)


def test_a_step_costs_little_more_than_its_products():
    # the step before took 31 times as long as one product with its exponentials
    model = lm.Model(lm.Options(), {}, np.zeros(4096, np.float32), np.zeros(257))
    model.weights = lm.start(model)
    r = np.random.default_rng(5)
    tokens = np.minimum(r.zipf(1.3, 2048), 4095)
    around = np.minimum(r.zipf(1.3, (2048, 6)), 4095).astype(np.int32)
    a, b = (r.normal(size=s).astype(np.float32) for s in ((2048, 24), (24, 64)))

    def least(function, times):
        found = []
        for _ in range(times):
            begun = time.perf_counter()
            function()
            found.append(time.perf_counter() - begun)
        return min(found)

    network = lm.Network(model, model.weights)
    mine = least(lambda: network.step(tokens, around, 0.1), 30)
    products = least(lambda: np.exp(np.exp(a @ b) * 0), 60)
    assert mine < 20 * products


def plain_cut(word, runs):
    out = []
    while word:
        size = next((k for k in range(min(6, len(word)), 1, -1) if word[:k] in runs), 1)
        out.append(runs.get(word[:size], 1 + 1920 + 1919 + word[0]))
        word = word[size:]
    return out


def test_words_pieces_and_runs_as_by_hand():
    r = random.Random(6)
    words = sorted({bytes(r.choices(b"ab\x00\xc3c", k=r.randint(1, 12))) for _ in range(3000)})
    assert len(words) > lm.Options().piece
    uses = np.array([r.randint(1, 9) for _ in words])
    for piece in (6, 11):
        want = Counter()
        for word, n in zip(words, uses.tolist()):
            spaced = b" " + word
            for size in range(2, piece + 1):
                for at in range(len(spaced) - size + 1):
                    want[spaced[at : at + size]] += n
        got = lm._run_counts(pa.array(words, pa.binary()), uses, piece)
        assert dict(zip(got["run"].to_pylist(), got["n"].tolist())) == want
        assert len(got["run"]) == len(want)
    runs = {run: 1921 + i for i, run in enumerate(r.sample(sorted(k for k in want if len(k) <= 6), 400))}
    index = {word: i + 1 for i, word in enumerate(words[::7])}
    model = lm.Model(lm.Options(), index, np.zeros(4096), np.zeros(257), {}, runs)
    texts = [b"", None, b" \x0b", b"A\x1cb\tC\n", "\u00c9 \u2003x\u00a0y".encode(), b"\xff AB "]
    texts += [b" ".join(r.choices(words, k=r.randint(1, 400))) for _ in range(60)]
    tokens, n_tokens, n_words = lm.Tokens(model).of_texts(pa.array(texts, pa.binary()))
    held = [(t or b"").lower().split() for t in texts]
    cut = [[x for w in ws for x in ([index[w]] if w in index else plain_cut(b" " + w, runs))] for ws in held]
    assert n_words.tolist() == [len(ws) for ws in held] and n_tokens.tolist() == [len(c) for c in cut]
    assert tokens.tolist() == [x for c in cut for x in c]
