"""Chat formatting by event sourcing: logs of edits become final messages, then a training text.

An event is ``conv_id, seq, kind, message, role, text``. Kinds:

* ``message``: a whole message, ``start``: an empty one; ``delta``: text to add to it
* ``edit``: replaces the text; ``regenerate``: forgets it, deltas follow; ``delete``: drops the message

``message`` names the message within its conversation; its place is that of its first event. An event of a
message that has none yet counts as its start. Events are sorted by ``seq``, ties by message, kind, role and
text, and may come however late. Nulls: role '', text '', message = seq.

The events of a message lie in one partition and are folded and rendered there, so a task holds one message,
and a long conversation is spread over tasks. The messages are then dealt by conversation and streamed in the
order of their first events. Output is one row for each message with its piece of the rendered text; the
pieces of a conversation in order are its text.

Template: ``<s>[role]\\n`` text ``</s>\\n`` for each turn. In texts and roles ``\\``, ``<``, ``[`` and ``]``
become ``\\\\``, ``\\l``, ``\\o`` and ``\\c``, so none of the characters that begin or end a control string is
left, and ``unescape`` gives the text back. The loss mask covers the text of assistant turns.
"""

from __future__ import annotations

import hashlib
import re
from collections import OrderedDict
from collections.abc import Iterable, Iterator
from itertools import chain, groupby, repeat

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

PIECES = "conv_id bigint, place bigint, piece string, loss_from bigint, loss_to bigint"
DIGESTS = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
    "formatted_chars bigint"
)
_BEGIN, _AFTER_ROLE, _END = "<s>[", "]\n", "</s>\n"
_LETTERS = {"\\": "\\", "<": "l", "[": "o", "]": "c"}
_CONTROL = re.compile(r"[\\<\[\]]")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_PLAIN = {letter: control for control, letter in _LETTERS.items()}


def escape(text: str) -> str:
    """The text without any ``<``, ``[`` or ``]``."""
    return _CONTROL.sub(lambda found: "\\" + _LETTERS[found[0]], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda found: _PLAIN[found[1]], text)


def fold(events: Iterator[tuple]) -> Iterator[tuple[int, str, str]]:
    """(place, role, text) of the final messages, from their events in order."""
    live: OrderedDict = OrderedDict()  # message -> [role, parts or None when deleted]
    for kind, message, role, text in events:
        if message not in live:
            live[message] = [role, []]
        state = live[message]
        if kind in ("message", "edit"):
            state[1] = [text]
            state[0] = role or state[0]
        elif kind in ("start", "regenerate"):
            state[1] = []
            state[0] = role or state[0]
        elif kind == "delete":
            state[1] = None
        elif kind == "delta":
            if state[1] is not None:
                state[1].append(text)
        else:
            raise ValueError(f"Unknown kind of event: {kind!r}")
    kept = ((role, parts) for role, parts in live.values() if parts is not None)
    for place, (role, parts) in enumerate(kept):
        yield place, role, "".join(parts)


def render(role: str, text: str) -> tuple[str, int, int]:
    """The piece of a message, and the part of it under the loss mask (empty unless assistant)."""
    head = _BEGIN + escape(role) + _AFTER_ROLE
    body = escape(text)
    to = len(head) + len(body) if role == "assistant" else len(head)
    return head + body + _END, len(head), to


def read_turns(parts: Iterable[str]) -> Iterator[tuple[str, str]]:
    """(role, text) of each turn of a formatted conversation, given in parts cut anywhere.

    Only control strings tell turns apart; no more than one turn and one part are held.
    """
    held = ""
    for part in parts:
        searched = max(0, len(held) - len(_END))
        held += part
        begin = 0
        while (end := held.find(_END, max(begin, searched))) >= 0:
            yield _turn(held[begin:end])
            begin = end + len(_END)
        held = held[begin:]
    if held:
        raise ValueError("The text ends within a turn.")


def _turn(turn: str) -> tuple[str, str]:
    after_role = turn.find(_AFTER_ROLE)
    if not turn.startswith(_BEGIN) or after_role < 0:
        raise ValueError("No turn of this template.")
    return unescape(turn[len(_BEGIN) : after_role]), unescape(turn[after_role + len(_AFTER_ROLE) :])


def parse(piece: str) -> tuple[str, str]:
    """(role, text) of a piece."""
    (turn,) = read_turns([piece])
    return turn


def _events(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """conv_id, message, kind, role, text, and where seq is: its column and place."""
    for batch in batches:
        *columns, seq = batch.columns
        yield from zip(*(c.to_pylist() for c in columns), zip(repeat(seq), range(len(seq))))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def _in_batches(
    rows: Iterator[tuple], schema: pa.Schema, chars: int = 1 << 22
) -> Iterator[pa.RecordBatch]:
    """Rows in batches of about so many characters."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 100 + sum(len(x) for x in row if isinstance(x, str))
        if size >= chars:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _by_conversation(rows: Iterator[tuple]) -> Iterator[tuple]:
    """(conv_id, rows of it) for rows in conversation order; nothing is held."""
    return groupby(rows, key=lambda row: row[0])


def conversation_events(conversations: DataFrame) -> DataFrame:
    """The event log of a table of turns: each row is a started message and one delta of its text."""
    turns = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.col("role").cast("string").alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    event = F.inline(
        F.array(
            F.struct(F.lit(0).alias("step"), F.lit("start").alias("kind"), F.lit("").alias("part")),
            F.struct(F.lit(1).alias("step"), F.lit("delta").alias("kind"), F.col("text").alias("part")),
        )
    )
    # repeated turns stay messages of their own: the message is the row, not the turn
    message = F.concat_ws("\0", F.col("turn").cast("string"), F.monotonically_increasing_id())
    each = turns.withColumn("message", message).select(
        "conv_id", "turn", "role", "text", "message", event
    )
    return each.select(
        "conv_id",
        F.struct("turn", "role", "text", "message", "step").alias("seq"),
        "kind",
        "message",
        "role",
        F.col("part").alias("text"),
    )


def format_conversations(events: DataFrame) -> DataFrame:
    """conv_id, place, piece, loss_from, loss_to: the rendered messages, each conversation in order."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    log = events.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        "seq",
        "kind",
        F.coalesce(F.col("message").cast("string"), F.col("seq").cast("string")).alias("message"),
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        text.alias("text"),
    )
    by_message = (
        log.repartition("conv_id", "message")
        .sortWithinPartitions("conv_id", "message", "seq", "kind", "role", "text")
        .select("conv_id", "message", "kind", "role", "text", "seq")
    )
    kinds = {f.name: f.dataType for f in log.schema.fields}
    folded = StructType([StructField(c, kinds[c]) for c in ("conv_id", "seq", "message")])
    for field in _parse_datatype_string(PIECES).fields[2:]:
        folded.add(field)
    schema = to_arrow_schema(folded)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pieces() -> Iterator[tuple]:
            for (conv_id, message), rows in groupby(_events(batches), key=lambda row: row[:2]):
                first = next(rows)
                column, at = first[5]
                each = ((row[2], message, row[3], row[4]) for row in chain([first], rows))
                for _, role, body in fold(each):
                    yield conv_id, column[at].as_py(), message, *render(role, body)

        yield from _in_batches(pieces(), schema)

    in_order = Window.partitionBy("conv_id").orderBy("seq", "message")
    return by_message.mapInArrow(run, folded).select(
        "conv_id",
        (F.row_number().over(in_order) - 1).cast("bigint").alias("place"),
        "piece",
        "loss_from",
        "loss_to",
    )


def _in_place(conv_id: int | None, rows: Iterator[tuple]) -> Iterator[tuple]:
    for expected, row in enumerate(rows):
        if row[1] != expected:
            raise ValueError(f"Conversation {conv_id}: piece {row[1]} where {expected} should be.")
        yield row


def digests(pieces: DataFrame) -> DataFrame:
    """What can be read back from the formatted text, for each conversation.

    Turns are parsed from the conversation's pieces joined, the loss mask is laid over the same text. Reads the
    pieces in the order in which ``format_conversations`` makes them, without a shuffle; another order is an error.
    """
    schema = to_arrow_schema(_parse_datatype_string(DIGESTS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            for conv_id, rows in _by_conversation(_rows(batches)):
                turns, loss = hashlib.sha256(), hashlib.sha256()
                n = loss_chars = chars = 0

                def text() -> Iterator[str]:
                    nonlocal loss_chars, chars
                    for _, _, piece, loss_from, loss_to in _in_place(conv_id, rows):
                        masked = unescape(piece[loss_from:loss_to])
                        loss.update(masked.encode("utf-8", "replace"))
                        loss_chars, chars = loss_chars + len(masked), chars + len(piece)
                        yield piece

                for role, body in read_turns(text()):
                    turns.update(f"{role}\n{body}\n".encode("utf-8", "replace"))
                    n += 1
                yield conv_id, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars

        yield from _in_batches(found(), schema)

    return pieces.mapInArrow(run, DIGESTS)
