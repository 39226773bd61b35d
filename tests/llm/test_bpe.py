"""The transducer against plain merging and against the library."""

import hashlib
import random
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pulsepanel.llm import bpe, registry
from pulsepanel.llm.bpe import ByteDecoder, Transducer, codec

PATH = registry.tokenizer_path()


def plain(merges, word):
    """Merge rank by rank over the whole word."""
    parts = list(word)
    for x, y in merges:
        i, out = 0, []
        while i < len(parts):
            if i + 1 < len(parts) and (parts[i], parts[i + 1]) == (x, y):
                out.append(x + y)
                i += 2
            else:
                out.append(parts[i])
                i += 1
        parts = out
    return parts


@st.composite
def merge_lists(draw):
    pieces, merges = ["a", "b", "c"], []
    for _ in range(draw(st.integers(0, 12))):
        pair = (draw(st.sampled_from(pieces)), draw(st.sampled_from(pieces)))
        if pair not in merges and len(pair[0] + pair[1]) < 9:
            merges.append(pair)
            pieces.append(pair[0] + pair[1])
    return merges


@settings(max_examples=150, deadline=None)
@given(merge_lists(), st.text("abc", max_size=400))
def test_stream_equals_merging_the_whole_word(merges, word):
    transducer = Transducer(merges)
    # an iterator is streamed through the window, however short it is
    assert list(transducer.encode(iter(word))) == plain(merges, word)


@settings(max_examples=200, deadline=None)
@given(merge_lists(), st.text("abc", min_size=1, max_size=300))
def test_heap_equals_merging_step_by_step(merges, word):
    assert bpe.Transducer(merges)._merge_long(list(word)) == plain(merges, word)


def test_parts_of_a_text_are_its_ids_and_words():
    c = bpe.codec(registry.tokenizer_path())
    r = random.Random(3)
    words = ["the", "Zürich", "x" * 90, "</s>", "don't", "\u2003wide", "1234", "é" * 30, "日本語"]
    for _ in range(40):
        text = "".join(r.choice(words) + r.choice([" ", "  ", "\n", "\t", "\x1c", ""]) for _ in range(60))
        whole = c.encode(text)
        for size in (1, 7, 100, 10_000):
            parts = list(c.memo.parts(text, size))
            assert b"".join(parts) == whole
            decoded = "".join(c.decoder.push(np.frombuffer(p, "<u4").tolist()) for p in parts) + c.decoder.finish()
            assert decoded == c.decode(whole)
    assert len(list(c.memo.parts("ab " * 1000, 30))) > 50


def test_long_words_take_little_time():
    c = bpe.codec(registry.tokenizer_path())
    word = "".join(random.Random(4).choice("abcdefghij") for _ in range(200_000))
    start = time.process_time()
    ids = c.encode(word)
    assert time.process_time() - start < 10
    assert np.frombuffer(ids, "<u4").tolist() == c.vocab.library.encode(word, add_special_tokens=False).ids


def test_memory_is_bounded():
    transducer = Transducer([("a", "b"), ("ab", "c")])
    held = 0

    def symbols():
        for i in range(5000):
            yield "abc"[i % 3]

    seen = []
    original = transducer.merge
    transducer.merge = lambda parts: seen.append(len(parts)) or original(parts)
    held = list(transducer.encode(symbols()))
    assert max(seen) <= 4 * transducer.lookahead and "".join(held) == "".join(symbols())


def test_refuses_a_merge_before_its_parts():
    with pytest.raises(ValueError):
        Transducer([("ab", "c"), ("a", "b")])


def library_ids(text):
    return codec(PATH).vocab.library.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=40))
def test_ids_equal_the_library(text):
    text = text.encode("utf-8", "ignore").decode()
    assert np.frombuffer(codec(PATH).encode(text), "<u4").tolist() == library_ids(text)


@pytest.mark.parametrize(
    "text",
    ["<|endoftext|>", "x<|startoftext|>y <|endoftext|", "A\x1cb c\x85d", "ΣΑΣ Σ", "don't I'LL", "", "  ", "a" * 9000,
     "theateou" * 1500, "中文 İ Å é"],
)
def test_hard_texts_equal_the_library(text):
    ids = codec(PATH).encode(text)
    assert np.frombuffer(ids, "<u4").tolist() == library_ids(text)
    expected = codec(PATH).vocab.library.decode(library_ids(text), skip_special_tokens=False)
    assert codec(PATH).decode(ids) == expected


def test_byte_level_decoding_is_incremental():
    class Vocab:
        pieces = ["Ã", "©", "a"]
        decoder = {"type": "ByteLevel"}

    d = ByteDecoder(Vocab())
    assert [d.push([0]), d.push([1]), d.push([2])] == ["", "é", "a"]
    assert d.push([0]) + d.finish() == "�"


def test_query_equals_the_library(spark, sf_dir, documents):
    rows = {r.doc_id: r for r in registry.QUERIES["op5_bpe_transducer"](spark, sf_dir).collect()}
    library = codec(PATH).vocab.library
    texts = documents.collect()
    assert len(rows) == len(texts)
    for t in texts:
        ids = library_ids(t.text or "")
        text = library.decode(ids, skip_special_tokens=False)
        assert rows[t.doc_id].n_tokens == len(ids)
        assert rows[t.doc_id].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert rows[t.doc_id].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_odd_rows(odd_documents, no_documents):
    rows = bpe.round_trip_digests(odd_documents, PATH).collect()
    assert len(rows) == odd_documents.count()
    assert {r.n_tokens for r in rows if r.doc_id in (2, 3, 4)} == {0}
    assert bpe.encode(no_documents, PATH).count() == 0
