"""Folding against known answers, formatting by reading it back."""

import hashlib

import compare
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pulsepanel.llm import chat, registry

PARTS = ["a", "<", ">", "[", "]", "/", "\\", "s", "\n", "é", " ", "l", "o", "c", "</s>\n", "<s>[", "[INST]", "[/INST]"]
TEXTS = st.lists(st.sampled_from(PARTS), max_size=20).map("".join)


@settings(max_examples=300, deadline=None)
@given(TEXTS, TEXTS)
def test_rendering_is_reversible(role, text):
    piece, start, end = chat.render(role, text)
    assert chat.parse(piece) == (role, text)
    assert chat.unescape(piece[start:end]) == (text if role == "assistant" else "")
    # no control string inside, so messages in a row can be told apart
    assert piece.count("</s>") == 1 and piece.count("<s>[") == 1


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(TEXTS, TEXTS), max_size=6), st.integers(1, 40))
def test_conversations_are_read_from_their_whole_text(turns, step):
    whole = "".join(chat.render(*turn)[0] for turn in turns)
    cut = [whole[i : i + step] for i in range(0, len(whole), step)]
    assert list(chat.read_turns(cut)) == turns
    assert whole.count("</s>") == whole.count("<s>[") == len(turns)
    # control strings of other templates cannot stand in a text either
    assert not any(mark in chat.escape(text) for _, text in turns for mark in ("[INST]", "</s>", "<"))


def test_order_of_pieces_is_checked(spark):
    row = (1, 1, chat.render("user", "x")[0], 0, 0)
    with pytest.raises(Exception, match="piece 1 where 0 should be"):
        chat.digests(spark.createDataFrame([row], chat.PIECES)).collect()


def test_what_is_no_conversation_is_refused():
    for text in ("x", "<s>[user]\nopen", "[user]\nx</s>\n", "<s>[user x</s>\n"):
        with pytest.raises(ValueError):
            list(chat.read_turns([text]))


def test_fold_of_deltas_edits_and_regenerations():
    events = [
        ("start", "1", "user", ""),
        ("delta", "1", "", "Hel"),
        ("delta", "1", "", "lo"),
        ("delta", "2", "assistant", "wrong"),
        ("regenerate", "2", "assistant", ""),
        ("delta", "2", "", "right"),
        ("edit", "1", "", "Hello?"),
        ("message", "3", "user", "gone"),
        ("delete", "3", "", ""),
        ("delta", "3", "", "ignored"),
    ]
    assert list(chat.fold(iter(events))) == [(0, "user", "Hello?"), (1, "assistant", "right")]


def test_unknown_kind_is_refused():
    with pytest.raises(ValueError):
        list(chat.fold(iter([("say", "1", "user", "x")])))


def test_log_out_of_order(spark):
    log = spark.createDataFrame(
        [(1, 3, "delta", "b", "assistant", "!"), (1, 1, "message", "a", "user", "q"),
         (1, 2, "start", "b", "assistant", None), (None, 1, "message", None, None, None)],
        "conv_id long, seq long, kind string, message string, role string, text string",
    )
    pieces = chat.format_conversations(log).collect()
    assert [chat.parse(p.piece) for p in pieces if p.conv_id == 1] == [("user", "q"), ("assistant", "!")]
    assert [chat.parse(p.piece) for p in pieces if p.conv_id is None] == [("", "")]


def test_late_events_reach_their_message(spark):
    rows = [(1, i, "message", f"m{i}", "user", f"t{i}") for i in range(150)]
    rows += [(1, 1000, "edit", "m0", None, "late"), (1, 1001, "delete", "m1", None, None)]
    rows += [(1, 1002, "delta", "m2", None, " more"), (1, 1003, "regenerate", "m3", "assistant", None)]
    rows += [(1, 1004, "delta", "m3", None, "again")]
    schema = "conv_id long, seq long, kind string, message string, role string, text string"
    pieces = chat.format_conversations(spark.createDataFrame(rows, schema)).orderBy("place").collect()
    assert [p.place for p in pieces] == list(range(149))
    start = [("user", "late"), ("user", "t2 more"), ("assistant", "again"), ("user", "t4")]
    assert [chat.parse(p.piece) for p in pieces][:4] == start
    assert chat.parse(pieces[-1].piece) == ("user", "t149")


def test_query_equals_sql(spark, sf_dir):
    name = "op6_chat_event_log"
    duck = compare.connect(sf_dir)
    assert compare.differences(spark, duck, registry.QUERIES[name], registry.SQL[name], sf_dir)[0] == []


def test_odd_turns(spark):
    rows = [(1, 0, "user", None), (1, 0, "user", None), (1, None, None, "x"), (2, 5, "assistant", "")]
    rows += [(None, 0, "assistant", "y" * 9)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    events = chat.conversation_events(turns.selectExpr("*", "'k' AS kind", "1 AS seq", "2 AS message"))
    got = {r.conv_id: r for r in chat.digests(chat.format_conversations(events)).collect()}
    assert {k: r.n_turns for k, r in got.items()} == {1: 3, None: 1, 2: 1}
    assert got[None].loss_chars == 9 and got[2].loss_sha256 == hashlib.sha256(b"").hexdigest()
    assert got[1].turns_sha256 == hashlib.sha256(b"\nx\nuser\n\nuser\n\n").hexdigest()
    assert chat.digests(chat.format_conversations(chat.conversation_events(turns.where("false")))).count() == 0
