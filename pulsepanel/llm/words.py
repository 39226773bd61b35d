"""Words of UTF-8 texts and their hashes, for tasks that read Arrow batches of binary columns.

A word's hash is the sum over its bytes of a random number for the byte times a power for its place in
the word, modulo 2^64, then mixed: a few array operations for a whole text.
"""

from __future__ import annotations

import numpy as np

#: Entries of a worker's memo by word before it starts again.
MEMO_ENTRIES = 400_000
_ALNUM = bytes(
    b | 0x20 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)
_SPACED = bytes(
    b | 0x20 if 0x41 <= b <= 0x5A else 0x20 if 0x09 <= b <= 0x0D else b for b in range(256)
)


def alnum_words(text: bytes) -> list[bytes]:
    """Runs of digits, letters and non-ASCII characters; A-Z in lower case."""
    return text.translate(_ALNUM).split()


def spaced_words(text: bytes) -> list[bytes]:
    """Runs between ASCII white space; A-Z in lower case."""
    return text.lower().split()


_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    values = values ^ (values >> np.uint64(30))
    values *= _MIX[0]
    values ^= values >> np.uint64(27)
    values *= _MIX[1]
    values ^= values >> np.uint64(31)
    return values


def _numbers(table: bytes) -> np.ndarray:
    """A random odd number for each byte, 0 for separators."""
    numbers = mixed(np.arange(1, 257, dtype=np.uint64) * _FACTOR) | np.uint64(1)
    numbers[0x20] = 0
    return numbers[np.frombuffer(table, np.uint8)]


_ALNUM_NUMBERS, _SPACED_NUMBERS = _numbers(_ALNUM), _numbers(_SPACED)
_POWERS = np.cumprod(np.full(64, _FACTOR))


def _hashes(text: bytes, numbers: np.ndarray) -> np.ndarray:
    values = numbers[np.frombuffer(text, np.uint8)]
    inside = values != 0
    starts = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
    if len(inside) and inside[0]:
        starts = np.concatenate([[0], starts])
    if not len(starts):
        return np.empty(0, np.uint64)
    ends = np.append(starts[1:], len(values))
    place = np.arange(starts[0], len(values)) - np.repeat(starts, ends - starts)
    longest = int(place.max()) + 1
    powers = _POWERS if longest <= len(_POWERS) else np.cumprod(np.full(longest, _FACTOR))
    # separators add nothing, so a word's sum runs to the next word
    return mixed(np.add.reduceat(values[starts[0] :] * powers[place], starts - starts[0]))


def alnum_hashes(text: bytes) -> np.ndarray:
    """Hashes of ``alnum_words``, in order."""
    return _hashes(text, _ALNUM_NUMBERS)


def spaced_hashes(text: bytes) -> np.ndarray:
    """Hashes of ``spaced_words``, in order."""
    return _hashes(text, _SPACED_NUMBERS)


def word_hashes(words: list[bytes]) -> np.ndarray:
    """Hashes of single words of either kind."""
    return spaced_hashes(b" ".join(words))


def gram_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of k words, from the words' hashes."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for i in range(k):
        total *= _FACTOR
        total += hashes[i : i + n]
    return mixed(total + np.uint64(k))
