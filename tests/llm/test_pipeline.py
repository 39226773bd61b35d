"""Each stage's decisions against brute force, and the rows of the whole."""

import re

import numpy as np
import pytest
from test_jaccard_join import brute

import corpus_pipeline
from pulsepanel.llm import registry, toxicity
from pulsepanel.llm.bpe import codec
from pulsepanel.llm.common import written


@pytest.fixture(scope="module")
def staged(spark, sf_dir, documents):
    out = [documents]
    for name, stage in corpus_pipeline.STAGES:
        out.append(written(stage(spark, out[-1], sf_dir), name))
    return out


def ids(df):
    return {r.doc_id for r in df.collect()}


def test_stages_keep_the_columns(staged, documents):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "near_copies", "benchmark", "personal_data", "token_ids",
    ]
    for df in staged[:-1]:
        assert df.dtypes == documents.dtypes


def test_toxic_documents_go(spark, sf_dir, staged):
    docs, kept = staged[:2]
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    low = toxicity.score(docs, model).where("score < 0.5")
    assert ids(kept) == ids(low)


def test_one_of_each_group_stays(staged):
    rows = [(r.doc_id, r.text) for r in staged[1].collect()]
    expected = {component for _, size, component in brute(rows, 5, 80)}
    assert ids(staged[2]) == expected


def test_contaminated_documents_go(spark, sf_dir, staged):
    def windows(text):
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
        size = min(10, len(words))
        return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()

    items = set().union(*(windows(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()))
    assert min(map(len, items)) == 10
    clean = {r.doc_id for r in staged[2].collect() if not (windows(r.text) & items)}
    assert ids(staged[3]) == clean


def test_personal_data_is_gone(staged):
    before = {r.doc_id: r.text for r in staged[3].collect()}
    after = {r.doc_id: r for r in staged[4].collect()}
    assert before.keys() == after.keys()
    for doc_id, row in after.items():
        assert not re.search(r"[\w.]+@[\w-]+\.[\w.-]+", row.text) and row.n_chars == len(row.text)
        if not re.search(r"[0-9@]", before[doc_id]):
            assert row.text == before[doc_id]


def test_run_gives_the_ids_of_what_is_left(spark, sf_dir, staged):
    library = codec(registry.tokenizer_path()).vocab.library
    expected = {r.doc_id: library.encode(r.text, add_special_tokens=False).ids for r in staged[4].collect()}
    got = {r.doc_id: list(np.array(r.ids)) for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert got == expected


def through(spark, docs, sf_dir):
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(written(stage(spark, out[-1], sf_dir), name))
    return out


def test_odd_rows_pass_all_stages(spark, sf_dir, odd_documents):
    out = through(spark, odd_documents, sf_dir)
    for df in out[1:-1]:
        assert df.dtypes == odd_documents.dtypes
    rows = {(r.doc_id, r.text) for r in out[2].collect()}
    # one of the repeated and of the near copies, all texts without words, both texts of one id
    assert {(1, "a short text"), (1, "another text under the same id"), (2, ""), (3, None), (None, None)} <= rows
    assert sum(d in (9, 10) for d, _ in rows) == 1 == sum(d in (5, 6) for d, _ in rows)
    assert len(rows) == out[2].count() == odd_documents.distinct().count() - 2 - 1
    last = {(r.doc_id, r.text, r.n_chars) for r in out[4].collect()}
    assert (3, None, None) in last and len(last) == len(rows)
    assert any(d == 8 and "[EMAIL]" in t and "me@example" not in t and n == len(t) for d, t, n in last)
    ids_of = [(r.doc_id, len(r.ids)) for r in out[5].collect()]
    assert len(ids_of) == len(rows) and {(2, 0), (3, 0), (None, 0)} <= set(ids_of)
    assert corpus_pipeline.without_personal_data(spark, out[3].drop("n_chars"), sf_dir).count() == len(rows)


def test_an_empty_table_passes_all_stages(spark, sf_dir, no_documents):
    out = through(spark, no_documents, sf_dir)
    assert [df.count() for df in out] == [0] * 6
    assert all(df.dtypes == no_documents.dtypes for df in out[1:-1])
