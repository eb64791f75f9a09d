"""Sets of word shingles as sorted arrays of 64-bit hash values, for many texts at a time.

Words are runs of bytes other than space, tab, line feed, vertical tab, form feed and carriage
return, with A-Z in lower case. One hash function serves sets and sketches: the k smallest
values of a set are its bottom-k sketch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np

#: Bytes of text hashed at a time; a longer text is taken alone.
GROUP_BYTES = 1 << 19
LONG_WORD = 512
_STEP = 0x9E3779B97F4A7C15 | 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over the word."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = np.arange(256, dtype=np.uint8)
_LOWER = np.where((_BYTE >= 65) & (_BYTE <= 90), _BYTE + 32, _BYTE).astype(np.uint8)
_SPACE = np.isin(_BYTE, [9, 10, 11, 12, 13, 32])
_TAIL = np.array([(1 << (8 * n)) - 1 for n in range(9)], dtype=np.uint64)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word, and where the words of each text begin (with the total at the end).

    A word is taken in steps of eight bytes, each mixed into the hash before the next; one of more
    than ``LONG_WORD`` bytes is digested as a whole.
    """
    joined = np.frombuffer(b" " + b" ".join(texts) + b" " * 9, dtype=np.uint8)
    low = np.ascontiguousarray(_LOWER[joined])
    space = _SPACE[low]
    begin = np.flatnonzero(space[:-1] & ~space[1:]) + 1
    size = np.flatnonzero(~space[:-1] & space[1:]) + 1 - begin
    eight = np.ndarray((len(low) - 7,), dtype="<u8", buffer=low.data, strides=(1,))
    words = mix(size.astype(np.uint64) * np.uint64(_STEP))
    left = np.flatnonzero(size <= LONG_WORD)
    at = 0
    while len(left):
        rest = size[left] - at
        words[left] = mix((words[left] ^ (eight[begin[left] + at] & _TAIL[np.minimum(rest, 8)])) + np.uint64(_STEP))
        at += 8
        left = left[rest > 8]
    for i in np.flatnonzero(size > LONG_WORD).tolist():
        words[i] = int.from_bytes(hashlib.blake2b(low[begin[i] : begin[i] + size[i]].tobytes(), digest_size=8).digest(), "little")
    text_ends = np.cumsum([len(t) + 1 for t in texts])
    return words, np.concatenate([[0], np.searchsorted(begin, text_ends)])


def groups(texts: list[bytes]) -> Iterator[list[bytes]]:
    """The texts in order, in groups of at most ``GROUP_BYTES`` or of one text."""
    at = 0
    while at < len(texts):
        to, room = at + 1, GROUP_BYTES - len(texts[at])
        while to < len(texts) and room >= len(texts[to]):
            room -= len(texts[to])
            to += 1
        yield texts[at:to]
        at = to


def shingle_sets(texts: list[bytes], size: int) -> Iterator[np.ndarray]:
    """The sorted distinct values of each text's shingles of ``size`` words.

    A text with fewer words is one shingle, the whole sequence; one without words has none.
    """
    factors = [np.uint64(pow(0xD6E8FEB86659FD93, i + 1, 1 << 64)) for i in range(size)]
    for group in groups(texts):
        words, bounds = word_hashes(group)
        rolled = np.zeros(max(0, len(words) - size + 1), dtype=np.uint64)
        for i in range(size):
            rolled += words[i : i + len(rolled)] * factors[i]
        rolled = mix(rolled)
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            if b - a >= size:
                yield np.unique(rolled[a : b - size + 1])
            elif b > a:
                short = (words[a:b] * np.array(factors[: b - a])).sum(dtype=np.uint64) + np.uint64(b - a)
                yield mix(mix(np.array([short], dtype=np.uint64)))
            else:
                yield np.empty(0, dtype=np.uint64)
