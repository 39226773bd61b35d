"""Segments against brute force, held-out accuracy, and labels that never reach a score."""

import random
import zlib

import pytest

from pulsepanel.llm import registry, toxicity


def brute(values):
    """The best segment (shortest, leftmost of equals), then the same left and right of it."""

    def best(low, high):
        top = None
        for i in range(low, high):
            total = 0.0
            for j in range(i, high):
                total += values[j]
                if total > 1e-12 and (top is None or total > top[2] + 1e-9):
                    top = (i, j + 1, total)
        return [] if top is None else best(low, top[0]) + [top] + best(top[1], high)

    return best(0, len(values))


def test_segments_are_all_maximal_ones():
    r = random.Random(1)
    for _ in range(800):
        n = r.randint(0, 14)
        scores = {i: r.choice([2.03, -3.7, 1.11, 0.53, -0.41, 4.17]) for i in range(n) if r.random() < 0.5}
        values = [scores.get(i, -0.301) for i in range(n)]
        got = toxicity.segments(sorted(scores.items()), -0.301)
        assert [g[:2] for g in got] == [b[:2] for b in brute(values)]
        assert [g[2] for g in got] == pytest.approx([b[2] for b in brute(values)])


@pytest.fixture(scope="module")
def learned(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    return docs, labels, toxicity.fit(docs, labels)


def test_only_equal_texts_count_once(spark):
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 5]
    # unlike texts with a passage in common, short ones of equal length, and one text under two ids
    passage = "the same three words and more of them stand here in all"
    rows = [(i, f"{passage} {' '.join(f'w{i}x{j}' for j in range(4))}" if i % 2 else f"ab {i:04}") for i in ids]
    rows += [(100 + i, rows[0][1]) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 0) for i, _ in rows], "doc_id long, toxic int")
    kept = toxicity._labelled(docs, labels, 1000).collect()
    assert sorted(bytes(r.text).decode() for r in kept) == sorted({t for _, t in rows})


def test_held_out_accuracy(learned):
    docs, labels, model = learned
    rows = (
        toxicity.score(docs, model)
        .join(labels.where(toxicity.held_out(labels.doc_id)), "doc_id")
        .select("score", "toxic")
        .toPandas()
    )
    said = rows.score >= 0.5
    assert len(rows) > 500 and (said == (rows.toxic == 1)).mean() > 0.97
    assert (said & (rows.toxic == 0)).sum() <= 3


def test_held_out_labels_are_not_used(learned):
    docs, labels, model = learned
    flipped = labels.withColumn(
        "toxic", toxicity.F.when(toxicity.held_out(labels.doc_id), 1 - labels.toxic).otherwise(labels.toxic)
    )
    assert toxicity.fit(docs, flipped) == model


def test_query_columns(spark, sf_dir, documents):
    rows = registry.QUERIES["op10_toxic_segments"](spark, sf_dir).collect()
    assert len(rows) == documents.count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)


def test_passages_are_where_the_words_are():
    model = toxicity.Model({b"awful": 5.0}, -0.1, 1.5, -3.0, 1.0, 0.0)
    words = [b"fine"] * 40 + [b"awful", b"and", b"awful"] + [b"fine"] * 40
    value, passages = toxicity.evidence(words, model, toxicity.TokenScores(model.scores))
    assert [(a, b) for a, b, _ in passages] == [(40, 43)] and value > 0


def test_odd_rows(spark, odd_documents, no_documents):
    labels = spark.createDataFrame(
        [(1, 1, 1), (1, 1, 0), (None, 0, 1), (5, None, None), (9, 1, 0), (10, 0, 7)],
        "doc_id long, quality int, toxic int",
    )
    for docs, known in ((odd_documents, labels), (no_documents, labels), (odd_documents, labels.where("false"))):
        model = toxicity.fit(docs, known)
        rows = toxicity.score(odd_documents, model).collect()
        assert len(rows) == odd_documents.count() and all(0 <= r.score <= 1 for r in rows)
        assert toxicity.score(no_documents, model).count() == 0
        assert toxicity.keep_clean(odd_documents, model).columns == odd_documents.columns
