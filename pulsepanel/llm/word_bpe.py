"""A vocabulary file of the tokenizers library: words of a text and the merge list.

A text is cut at white space into chunks. No match of the split pattern spans white space and
white space composes with nothing, so a text's ids are the ids of its chunks in order. Chunks
repeat, so workers keep a bounded memo from chunk to ids.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np

#: Entries of a memo before it starts again; bounds a worker's memory.
MEMO_ENTRIES = 500_000
#: Code points above this are split by the library itself, whose Unicode version then holds.
PLAIN_LIMIT = 0x0370
_SEPARATORS = re.compile(r"[\x1c-\x1f]")
_GAP = re.compile(r"[\x09-\x0d\x20]")
_SPACE = re.compile(
    r"[^\x09-\x0d\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"
)


def byte_alphabet() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies.

    Printable Latin-1 bytes stand for themselves, the others for U+0100 onwards in order.
    """
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def chunks(text: str) -> list[str]:
    """The runs of a text between white space."""
    if _SEPARATORS.search(text):  # white space to str.split, but not to the pattern
        return _SPACE.findall(text)
    return text.split()


def windows(text: str, size: int) -> Iterator[str]:
    """The text in parts of about so many characters, each ending before white space."""
    begin = 0
    while len(text) - begin > size and (gap := _GAP.search(text, begin + size)):
        yield text[begin : gap.start()]
        begin = gap.start()
    yield text[begin:] if begin else text


class Vocabulary:
    """Words, pieces and merges of one vocabulary file with word ends."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        if model["type"] != "BPE" or not model.get("end_of_word_suffix"):
            raise ValueError(f"{path} is no merge list with word ends.")
        self.path = path
        self.id_bytes = 4
        self.ids: dict[str, int] = model["vocab"]
        self.end: str = model["end_of_word_suffix"]
        self.merges = [
            tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]
        ]
        self.special: dict[str, int] = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.pieces = [""] * (max([*self.ids.values(), *self.special.values()]) + 1)
        for piece, i in [*self.ids.items(), *self.special.items()]:
            self.pieces[i] = piece
        self.decoder: dict | None = spec["decoder"]
        self._alphabet = {b: c for b, c in enumerate(byte_alphabet())}
        self._special = re.compile("|".join(map(re.escape, self.special)) or "(?!)")
        # the file's split pattern for plain code points: no other digits or letters there
        self._plain = re.compile(
            r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_²³¹¼½¾]+|[\d²³¹¼½¾]|(?:\W|_)+"
        )

    @property
    def library(self):
        from tokenizers import Tokenizer

        if not hasattr(self, "_library"):
            self._library = Tokenizer.from_file(self.path)
            self._library.no_truncation()
            self._library.no_padding()
        return self._library

    def words(self, chunk: str) -> list[str]:
        """The words of a chunk without special tokens, in the byte alphabet."""
        composed = unicodedata.normalize("NFC", chunk)
        if max(composed, default="") < chr(PLAIN_LIMIT) and max(chunk) < chr(PLAIN_LIMIT):
            found = self._plain.findall(composed.lower())
            return [
                w
                if w.isascii() and w.isprintable()
                else w.encode().decode("latin-1").translate(self._alphabet)
                for w in found
            ]
        library = self.library
        normal = library.normalizer.normalize_str(chunk)
        return [w for w, _ in library.pre_tokenizer.pre_tokenize_str(normal)]

    def chunk_ids(self, chunk: str, word_ids: Callable[[str], bytes]) -> bytes:
        """Ids of a chunk: special tokens as they stand, everything else by its words."""
        if chunk.isascii() and chunk.isalpha():
            return word_ids(chunk.lower())
        out: list[bytes] = []
        at = 0
        for m in self._special.finditer(chunk) if "<" in chunk else ():
            out += map(word_ids, self.words(chunk[at : m.start()]) if m.start() > at else ())
            out.append(self.special[m[0]].to_bytes(self.id_bytes, "little"))
            at = m.end()
        out += map(word_ids, self.words(chunk[at:]) if at < len(chunk) else ())
        return b"".join(out)


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class ChunkMemo(dict):
    """chunk -> its ids as little-endian bytes, filled on demand and bounded."""

    def __init__(
        self, vocab: Vocabulary, word_ids: Callable[[str], bytes], entries: int = MEMO_ENTRIES
    ) -> None:
        super().__init__()
        self.vocab, self.word_ids, self.entries = vocab, word_ids, entries
        self.word_memo: dict[str, bytes] = {}

    def _word(self, word: str) -> bytes:
        ids = self.word_memo.get(word)
        if ids is None:
            ids = self.word_ids(word)
            if len(word) <= 64:
                if len(self.word_memo) >= self.entries:
                    self.word_memo.clear()
                self.word_memo[word] = ids
        return ids

    def __missing__(self, chunk: str) -> bytes:
        ids = self.vocab.chunk_ids(chunk, self._word)
        if len(chunk) <= 64:
            if len(self) >= self.entries:
                self.clear()
            self[chunk] = ids
        return ids

    def text(self, text: str) -> bytes:
        """Ids of a whole text."""
        return b"".join(map(self.__getitem__, chunks(text)))

    def parts(self, text: str, size: int) -> Iterator[bytes]:
        """Ids of a text, part by part, from so many characters each."""
        return map(self.text, windows(text, size))
