"""Winnowing against SQL and its guarantee."""

import compare
import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from pulsepanel.llm import decontaminate, registry
from pulsepanel.llm.words import word_hashes


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"c"]), min_size=10, max_size=10), st.data())
def test_every_shared_window_is_found(span, data):
    word = st.lists(st.sampled_from([b"a", b"b", b"c", b"d"]), max_size=12)
    sides = [data.draw(word) + span + data.draw(word) for _ in range(2)]
    kept = []
    for words in sides:
        hashes = word_hashes(words)
        kept.append({(words[p], *words[p + 1 : p + 5]) for p in decontaminate.winnow(hashes, 5, 10).tolist()})
    assert kept[0] & kept[1]


def test_query_equals_sql(spark, sf_dir):
    name = "op8_winnowing"
    duck = compare.connect(sf_dir)
    assert compare.differences(spark, duck, registry.QUERIES[name], registry.SQL[name], sf_dir)[0] == []


def test_short_items_and_edges(spark):
    words = [f"w{i}" for i in range(30)]
    docs = spark.createDataFrame(
        [(1, " ".join(words)), (2, "x w3 W4, w5 y"), (3, " ".join(words[:9])), (4, "W3-w4 w6"), (5, None)],
        "doc_id long, text string",
    )
    items = spark.createDataFrame(
        [(10, " ".join(["q", *words[10:22], "r"])), (11, "w3 w4 w5"), (12, None), (13, ""), (None, "w3"),
         (2, "w3 w4 w5")],
        "item_id long, text string",
    )
    got = {r.doc_id: r for r in decontaminate.contamination(docs, items).collect()}
    assert (got[1].n_hit, got[1].n_items) == (15, 3)
    assert (got[2].n_hit, got[2].n_items) == (3, 2)
    assert [got[d].contaminated for d in (3, 4, 5)] == [True, False, False]


def test_odd_rows(odd_documents, no_documents):
    items = odd_documents.selectExpr("doc_id AS item_id", "text", "'x' AS print")
    rows = decontaminate.contamination(odd_documents, items).collect()
    assert len(rows) == odd_documents.count()
    for r in rows:
        assert r.contaminated == (r.n_hit > 0) == (r.n_items > 0)
        assert r.n_words or not r.contaminated
    whole = [r for r in rows if r.doc_id == 5]
    assert whole[0].n_hit == whole[0].n_words == 12000
    assert decontaminate.contamination(no_documents, items).count() == 0
    assert not any(r.n_hit for r in decontaminate.contamination(odd_documents, items.where("false")).collect())
    left = decontaminate.keep_clean(odd_documents, items.where("item_id = 5"))
    assert left.columns == odd_documents.columns
    assert sorted(r.doc_id for r in left.where("doc_id > 3").collect()) == [4, 7, 8, 9, 10]


def test_bloom_filter_has_no_false_negatives(spark):
    rows = spark.range(1, 2000).selectExpr("xxhash64(id) AS v")
    filled = decontaminate.bloom_bits(rows, "v", bits=1 << 16)
    values = np.array([r.v for r in rows.collect()], np.int64).view(np.uint64)
    assert decontaminate.in_bloom(values, filled).all() and filled.nbytes == (1 << 16) // 8
