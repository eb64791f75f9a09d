"""A table of distinct words and the ids each one is segmented into.

Every Python worker keeps one table for each tokenizer, through all tasks it runs. A word is
segmented once while it stays in the table; the ids of a text are joined back by position.
"""

from __future__ import annotations

import sys
from array import array
from collections.abc import Callable, Iterable

#: Words kept at most; a full table is emptied and filled again, which changes no result.
MAX_WORDS = 600_000
#: Words longer than this are segmented each time and not kept.
MAX_KEPT_CHARS = 64

_TABLES: dict[tuple, WordTable] = {}


def packed(ids: Iterable[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


class WordTable(dict):
    """Word to packed ids; ``segment`` turns a list of words into their lists of ids."""

    def __init__(self, segment: Callable[[list[str]], list[list[int]]], max_words: int = MAX_WORDS):
        super().__init__()
        self.segment = segment
        self.max_words = max_words

    def join(self, texts: list[list[str]]) -> list[bytes]:
        """The packed ids of each text, given as its words in order."""
        missing: set[str] = set()
        for words in texts:
            missing.update(words)
        missing.difference_update(self.keys() & missing)
        if len(self) + len(missing) > self.max_words:
            self.clear()
            missing = set().union(*texts)
        new = sorted(missing)
        for word, ids in zip(new, self.segment(new), strict=True):
            self[word] = packed(ids)
        look = self.__getitem__
        out = [b"".join(map(look, words)) for words in texts]
        for word in new:
            if len(word) > MAX_KEPT_CHARS:
                del self[word]
        return out


def table_for(key: tuple, make: Callable[[], WordTable]) -> WordTable:
    if key not in _TABLES:
        _TABLES[key] = make()
    return _TABLES[key]
