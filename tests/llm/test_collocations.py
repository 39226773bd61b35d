"""Phrase counts and scores against brute force, the index against counting."""

import random
import re
from collections import Counter

import compare
import numpy as np
import pytest

from pulsepanel.llm import collocations, registry


def counted(texts, longest=5):
    """Uses of every phrase and the number of words."""
    found = Counter()
    for text in texts:
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\n-\r]", lower):
            words = re.findall(r"[^ \t]+", piece)
            for k in range(1, longest + 1):
                found.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    return found, sum(f for g, f in found.items() if len(g) == 1)


def brute(rows, least, top):
    """Rows as the operator returns them, from (lang, text)."""
    out = []
    for lang in {x or "und" for x, _ in rows}:
        f, n = counted([t for x, t in rows if (x or "und") == lang])
        candidates = {g: a for g, a in f.items() if len(g) > 1 and a >= least}
        scored = []
        for g, a in candidates.items():
            if any(
                len(h) > len(g) and 100 * b >= 100 * a and any(h[i : i + len(g)] == g for i in range(len(h)))
                for h, b in candidates.items()
            ):
                continue
            cuts = [(1000 * a * n // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g))]
            score, k = min(cuts)
            scored.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def rows_of(df):
    names = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r[c] for c in names) for r in df.collect())


def test_index_counts_every_phrase():
    r = np.random.default_rng(3)
    for _ in range(60):
        symbols = np.append(r.integers(0, r.integers(2, 6), r.integers(1, 80)), 0).astype(np.int32)
        longest = int(r.integers(2, 7))
        want = Counter()
        for k in range(2, longest + 1):
            for i in range(len(symbols) - k + 1):
                if all(symbols[i : i + k]):
                    want[tuple(symbols[i : i + k].tolist())] += 1
        got = {
            tuple(ids): int(n)
            for p in collocations.phrases_of(symbols, longest)
            for ids, n in zip(p.ids.tolist(), p.uses)
        }
        assert got == want


def test_intervals_hold_the_phrase_in_both_indexes():
    symbols = np.array([1, 2, 1, 2, 3, 0, 2, 1, 2, 3, 3, 0], np.int32)
    index = collocations.BiIndex(symbols, 4)
    phrases = index.extend(index.extend(index.words(), right=True), right=False)
    for text, starts, flip in ((symbols, phrases.front, 1), (np.append(symbols[-2::-1], 0), phrases.back, -1)):
        order = sorted(range(len(text)), key=lambda i: (text[i : i + 4].tolist(), i))
        for ids, n, start in zip(phrases.ids.tolist(), phrases.uses, starts):
            assert all(text[i : i + 3].tolist() == ids[::flip] for i in order[start : start + n])


def test_packed_tables_come_back():
    r = np.random.default_rng(4)
    for shape in ((1, 1), (5, 2), (300, 6)):
        table = r.integers(-(1 << 60), 1 << 60, shape)
        table = table[table[:, 0].argsort()]
        before = table.copy()
        for ordered in (False, True):
            assert (collocations.unpack(collocations.pack(table, ordered)) == before).all()
    one = np.arange(5)
    assert collocations.unpack(collocations.pack(one[:, None], True))[:, 0].tolist() == one.tolist() == [0, 1, 2, 3, 4]


@pytest.fixture(scope="module")
def corpus():
    r = random.Random(5)
    words = ["a", "B", "the", "é", "x\x00y", "of", " ", "rare"]
    rows = []
    for i in range(300):
        size = r.choice([0, 1, 4, 30])
        text = "".join(r.choice(words) + r.choice([" ", " ", "\t", "  ", ". ", "\r\n", ","]) for _ in range(size))
        rows.append((r.choice(["en", "de", None, "und"]), r.choice([text, text, text + " The Same Five Words again"])))
    rows += [("en", None), (None, ""), ("fr", " ,,, \n")] + [("en", "only one copied passage here of words")] * 40
    return rows


@pytest.mark.parametrize("least,top,shard", [(3, 2000, 1 << 21), (12, 7, 50), (1, 5, 3)])
def test_against_brute_force(spark, corpus, least, top, shard):
    docs = spark.createDataFrame(corpus, "lang string, text string").repartition(3)
    docs = docs.selectExpr("*", "'clash' AS word", "1 AS shard", "2 AS uses")
    got = collocations.collocations(docs, least=least, top=top, shard_words=shard)
    assert rows_of(got) == brute(corpus, least, top)


def test_nothing_to_find(spark, no_documents, odd_documents):
    assert collocations.collocations(no_documents).collect() == []
    assert collocations.collocations(no_documents.select("lang", "text"), least=1).collect() == []
    want = brute([(r.lang, r.text) for r in odd_documents.collect()], 100, 2000)
    assert rows_of(collocations.collocations(odd_documents)) == want


def test_counts_are_not_broadcast_by_the_size_of_their_files(spark, corpus):
    # the files are far below the threshold: only the totals, one row for each language, may go to the driver
    docs = spark.createDataFrame(corpus, "lang string, text string")
    plan = collocations.collocations(docs, least=1)._jdf.queryExecution().executedPlan().toString()
    keys = re.findall(r"(\w+Join) \[(w1#\d+L, w2#|word_id#|lang#)\S*.*?(Build\w+|$)", plan, re.M)
    assert {(join, key.partition("#")[0], side) for join, key, side in keys} == {
        ("SortMergeJoin", "w1", ""), ("SortMergeJoin", "word_id", ""), ("BroadcastHashJoin", "lang", "BuildRight")
    }


def test_query_equals_sql(spark, sf_dir):
    name = "op13_phrase_index"
    for sf in (sf_dir, "/root/testdata/sf0.01"):
        duck = compare.connect(sf)
        assert compare.differences(spark, duck, registry.QUERIES[name], registry.SQL[name], sf)[0] == []
