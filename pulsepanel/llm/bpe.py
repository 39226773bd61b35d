"""BPE encoding as a bounded-lookahead transducer, decoding as a byte-to-text state machine.

How far can text to the right change a token to the left? A merge ``s = (x, y)`` is spoiled from the
right only when the last part of ``y`` is taken by an earlier merge ``r = (u, v)`` in which ``u`` is a
part at the right edge of ``y`` (or ``y`` itself). ``r`` in turn depends on what is right of it in the
same way, always by merges of lower rank, so influence runs along chains of falling rank. The longest
chain, measured in symbols, is the sufficient lookahead (``lookahead``): one pass over the merge list.

The encoder keeps a buffer of a few lookaheads of symbols, merges it, emits the tokens that end a full
lookahead before the buffer's end, and goes on from the last emitted boundary: a boundary is never
crossed by a merge, so both sides are independent. Memory is constant for words of any length.

A text is read in parts that end before white space; ids and decoded text of a part go into the digests and are
dropped, so a row's memory does not grow with its ids. Empty and null texts have no tokens. Symbols or ids outside the vocabulary raise an error: the
public files hold every byte.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsepanel.llm.common import SLICE_BYTES, arrow_map
from pulsepanel.llm.word_bpe import ChunkMemo, Vocabulary, byte_alphabet, vocabulary

#: Symbols beyond which a list is merged with a heap.
LONG_WORD = 64
#: Characters of a text that are encoded and decoded at once; a run without white space is one.
PART_CHARS = 1 << 16
#: Entries of a worker's memos before they start again.
CODEC_MEMO = 300_000


class Transducer:
    """Streaming encoder for one merge list.

    ``merges`` are (left, right) pairs in rank order; ``end`` is the suffix that marks the last symbol
    of a word. A merge list in which a merge precedes the merges of its own parts is refused.
    """

    def __init__(self, merges: list[tuple[str, str]], end: str = "") -> None:
        self.end = end
        self.rank: dict[tuple[str, str], int] = {}
        for i, pair in enumerate(merges):
            self.rank.setdefault(pair, i)
        self.made: dict[str, set[str]] = {}  # piece -> right parts of the merges that make it
        for (x, y), i in self.rank.items():
            for part in (x, y):
                if len(self._symbols(part)) > 1 and part not in self.made:
                    raise ValueError(f"Merge {i} uses {part!r} before it is made.")
            self.made.setdefault(x + y, set()).add(y)
        self.lookahead = self._lookahead()

    def _symbols(self, piece: str) -> str:
        """A piece without its word end: as many characters as symbols."""
        return piece.removesuffix(self.end) if self.end else piece

    def _right_edge(self, piece: str) -> Iterator[str]:
        """The piece and every part of it that reaches its right edge."""
        yield piece
        for right in self.made.get(piece, ()):
            yield from self._right_edge(right)

    def _lookahead(self) -> int:
        longest: dict[str, int] = {}  # by left part: symbols to the right that can matter
        most = 1
        for x, y in self.rank:
            reach = len(self._symbols(y)) + max(
                (longest.get(u, 0) for u in self._right_edge(y)), default=0
            )
            longest[x] = max(longest.get(x, 0), reach)
            most = max(most, reach)
        longest_piece = max((len(self._symbols(p)) for p in self.made), default=1)
        return most + longest_piece

    def merge(self, parts: list[str]) -> list[str]:
        """The merges applied to a list of symbols: lowest rank first, leftmost of equals first."""
        if len(parts) > LONG_WORD:
            return self._merge_long(parts)
        rank, never = self.rank.get, len(self.rank)
        ranks = [rank(p, never) for p in zip(parts, parts[1:])]
        while ranks and (best := min(ranks)) != never:
            i = ranks.index(best)
            parts[i] += parts.pop(i + 1)
            del ranks[i]
            if i:
                ranks[i - 1] = rank((parts[i - 1], parts[i]), never)
            if i < len(ranks):
                ranks[i] = rank((parts[i], parts[i + 1]), never)
        return parts

    def _merge_long(self, parts: list[str]) -> list[str]:
        """The same with a heap of pairs and linked places, for lists too long to be searched for each merge."""
        rank = self.rank.get
        after = list(range(1, len(parts) + 1))
        before = list(range(-1, len(parts) - 1))
        heap = [(r, i, x, y) for i, (x, y) in enumerate(zip(parts, parts[1:])) if (r := rank((x, y))) is not None]
        heapq.heapify(heap)
        end = len(parts)
        while heap:
            _, i, x, y = heapq.heappop(heap)
            j = after[i]
            # a pair is stale when either of its parts has been merged since
            if j >= end or parts[i] != x or parts[j] != y:
                continue
            parts[i], parts[j] = x + y, ""
            k = after[i] = after[j]
            if k < end:
                before[k] = i
                if (r := rank((parts[i], parts[k]))) is not None:
                    heapq.heappush(heap, (r, i, parts[i], parts[k]))
            h = before[i]
            if h >= 0 and (r := rank((parts[h], parts[i]))) is not None:
                heapq.heappush(heap, (r, h, parts[h], parts[i]))
        return [p for p in parts if p]

    def encode(self, word: Iterable[str]) -> Iterator[str]:
        """Pieces of a stream of symbols, each as soon as nothing to come can change it.

        Holds at most four lookaheads of symbols.
        """
        window = 4 * self.lookahead
        if isinstance(word, str) and 0 < len(word) <= window:
            yield from self.merge([*word[:-1], word[-1] + self.end])
            return
        buffer: list[str] = []
        for symbol in word:
            if len(buffer) >= window:
                stable, at = len(buffer) - self.lookahead, 0
                for piece in self.merge(buffer[:]):
                    if at + len(piece) > stable:
                        break
                    yield piece
                    at += len(piece)
                buffer = buffer[at:]
            buffer.append(symbol)
        if buffer:
            buffer[-1] += self.end
            yield from self.merge(buffer)


class ByteDecoder:
    """Ids to text, one id at a time; state: the bytes of an unfinished character.

    A file without decoder joins pieces with one space, as the library does. With a byte-level decoder
    a piece's characters stand for bytes; incomplete or wrong UTF-8 becomes U+FFFD.
    """

    def __init__(self, vocab: Vocabulary) -> None:
        self.pieces = vocab.pieces
        self.bytewise = (vocab.decoder or {}).get("type") == "ByteLevel"
        self.byte = {c: b for b, c in enumerate(byte_alphabet())}
        self.reset()

    def reset(self) -> None:
        self.first = True
        self.utf8 = codecs.getincrementaldecoder("utf-8")("replace")

    def push(self, ids: Iterable[int]) -> str:
        """Text that is certain after these ids."""
        pieces = list(map(self.pieces.__getitem__, ids))
        if self.bytewise:
            return self.utf8.decode(bytes(self.byte[c] for p in pieces for c in p))
        out = " ".join(pieces)
        if pieces and not self.first:
            out = " " + out
        self.first = self.first and not pieces
        return out

    def finish(self) -> str:
        out = self.utf8.decode(b"", True) if self.bytewise else ""
        self.reset()
        return out

    def text(self, ids: Iterable[int]) -> str:
        return self.push(ids) + self.finish()


class Codec:
    """Encoder and decoder of a vocabulary file."""

    def __init__(self, path: str) -> None:
        self.vocab = vocabulary(path)
        self.transducer = Transducer(self.vocab.merges, self.vocab.end)
        self.id_of = {
            p: i.to_bytes(self.vocab.id_bytes, "little") for p, i in self.vocab.ids.items()
        }
        self.memo = ChunkMemo(self.vocab, self._word_ids, CODEC_MEMO)
        self.decoder = ByteDecoder(self.vocab)

    def _word_ids(self, word: str) -> bytes:
        return b"".join(map(self.id_of.__getitem__, self.transducer.encode(word)))

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids of a whole text."""
        return self.memo.text(text)

    def decode(self, ids: bytes) -> str:
        return self.decoder.text(np.frombuffer(ids, "<u4").tolist())


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """One codec for each worker process and file."""
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids array<int> for every row; null texts are empty."""

    def run(batch: pa.RecordBatch) -> dict:
        c = codec(path)
        blobs = [c.encode(t or "") for t in batch.column(1).to_pylist()]
        ends = np.cumsum([0, *(len(b) // 4 for b in blobs)], dtype="int32")
        values = np.frombuffer(b"".join(blobs), "<i4")
        return {
            "doc_id": batch.column(0),
            "ids": pa.ListArray.from_arrays(pa.array(ends), pa.array(values, pa.int32())),
        }

    kind = docs.select(F.col(f"`{id_col}`")).schema[0].dataType.simpleString()
    rows = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))
    return arrow_map(rows, run, f"doc_id {kind}, ids array<int>", SLICE_BYTES)


def round_trip_digests(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_tokens, digests of the ids and of the text decoded from them, for every row."""

    def run(batch: pa.RecordBatch) -> dict:
        c = codec(path)
        out: dict[str, list] = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
        for text in batch.column(1):
            n, digest, decoded = 0, hashlib.sha256(), hashlib.sha256()
            # neither all ids nor the decoded text of a row are held
            for ids in c.memo.parts(text.as_py() or "", PART_CHARS):
                n += len(ids) // 4
                digest.update(ids)
                decoded.update(c.decoder.push(np.frombuffer(ids, "<u4").tolist()).encode("utf-8", "replace"))
            decoded.update(c.decoder.finish().encode("utf-8", "replace"))
            out["n_tokens"].append(n)
            out["ids_sha256"].append(digest.hexdigest())
            out["decoded_sha256"].append(decoded.hexdigest())
        return {"doc_id": batch.column(0), **out}

    kind = docs.select(F.col(f"`{id_col}`")).schema[0].dataType.simpleString()
    rows = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))
    return arrow_map(
        rows, run, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string", SLICE_BYTES
    )
