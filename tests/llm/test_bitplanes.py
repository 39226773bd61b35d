"""Exact round trips through the file format."""

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pulsepanel.llm import bitplanes, registry
from pulsepanel.llm.bpe import codec
from pulsepanel.session import shared_table_path

PATH = registry.tokenizer_path()


@pytest.mark.parametrize("kind", ["byte", "bit"])
@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), min_size=1, max_size=70))
def test_planes_round_trip(kind, ids):
    ids = np.array(ids, "<u4")
    planes, sizes = bitplanes.to_planes(ids, kind)
    assert len(sizes) == (4 if kind == "byte" else 32)
    assert bitplanes.from_planes(planes, sizes, len(ids), kind).tolist() == ids.tolist()


@settings(max_examples=100, deadline=None)
@given(st.binary(max_size=50), st.binary(max_size=50))
def test_crc_of_joined_pieces(a, b):
    assert bitplanes.crc32_joined(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


def expected(rows):
    at, out = 0, []
    for doc_id, text in rows:
        ids = codec(PATH).vocab.library.encode(text or "", add_special_tokens=False).ids + [1]
        out.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_query_equals_the_library(spark, sf_dir, documents):
    got = registry.QUERIES["op7_bitplane_ids"](spark, sf_dir).orderBy("start").collect()
    rows = [(r.doc_id, r.text) for r in documents.orderBy("doc_id").collect()]
    assert [tuple(r) for r in got] == expected(rows)


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_documents_over_many_blocks(spark, odd_documents, kind):
    path = shared_table_path(spark, "odd_ids")
    bitplanes.write(odd_documents, path, PATH, kind=kind, block_ids=64)
    got = bitplanes.doc_digests(spark, path).orderBy("start").collect()
    key = lambda r: (r.doc_id is not None, r.doc_id or 0, r.text is not None, r.text or "")
    rows = [(r.doc_id, r.text) for r in sorted(odd_documents.collect(), key=key)]
    assert [tuple(r) for r in got] == expected(rows)


def test_no_documents(spark, no_documents):
    path = shared_table_path(spark, "no_ids")
    bitplanes.write(no_documents, path, PATH)
    assert bitplanes.doc_digests(spark, path).count() == 0
