"""A word-level FM-index of one shard's passages, searched backwards for many streams at a time.

The index keeps the Burrows-Wheeler transform as a wavelet matrix of packed bits with rank counts,
the bounds of the classes of suffixes that share their first ``window`` words, and the smallest
document of each class. Suffixes are ordered by those words alone, which is all that patterns of
at most ``window`` words need.
"""

from __future__ import annotations

import numpy as np

#: Words of a stream searched in one piece; longer streams are cut with overlaps of a window less one.
PIECE = 256


class WaveletMatrix:
    """Rank of symbols in a sequence, by levels of packed bits from the highest bit down."""

    def __init__(self, seq: np.ndarray, n_symbols: int):
        self.levels = max(1, int(n_symbols - 1).bit_length())
        self.words, self.counts, self.zeros = [], [], []
        for level in range(self.levels - 1, -1, -1):
            bit = ((seq >> level) & 1).astype(bool)
            packed = np.packbits(np.append(bit, np.zeros(64 + -len(bit) % 64, dtype=bool)), bitorder="little").view("<u8")
            self.words.append(packed)
            self.counts.append(np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)]).astype(np.uint32))
            self.zeros.append(int(len(bit) - bit.sum()))
            seq = np.concatenate([seq[~bit], seq[bit]])
        self.first = np.zeros(n_symbols, dtype=np.int64)
        self.first = self.rank(np.arange(n_symbols), np.zeros(n_symbols, dtype=np.int64))

    def rank(self, symbol: np.ndarray, pos: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before its position."""
        at = pos
        for i in range(self.levels):
            word = at >> 6
            below = self.words[i][word] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1))
            ones = self.counts[i][word].astype(np.int64) + np.bitwise_count(below)
            at = np.where((symbol >> (self.levels - 1 - i)) & 1 == 1, self.zeros[i] + ones, at - ones)
        return at - self.first[symbol]


def _dense(keys: np.ndarray) -> np.ndarray:
    """Keys to their ranks among the distinct keys."""
    return np.unique(keys, return_inverse=True)[1].astype(np.int64)


class FmIndex:
    """``seq`` has the words of all passages as numbers from 1, a 0 behind each passage; ``owner`` their documents."""

    def __init__(self, seq: np.ndarray, owner: np.ndarray, window: int):
        n = len(seq)
        self.window = window
        rank, width = _dense(seq), 1
        while width < window:  # ranks by the first ``width`` words, widened to at most ``window``
            step = min(width, window - width)
            ahead = np.zeros(n, dtype=np.int64)
            ahead[: max(0, n - step)] = rank[step:] + 1
            rank, width = _dense(rank * (n + 1) + ahead), width + step
        order = np.argsort(rank, kind="stable")
        in_order = rank[order]
        starts = np.flatnonzero(np.concatenate([[True], in_order[1:] != in_order[:-1]]))
        self.bounds = np.append(starts, n)
        self.least = np.minimum.reduceat(owner[order], starts)
        n_symbols = int(seq.max()) + 1
        self.before = np.concatenate([[0], np.cumsum(np.bincount(seq, minlength=n_symbols))])
        self.wavelet = WaveletMatrix(seq[order - 1], n_symbols)

    def least_owner(self, ends: np.ndarray, lengths: np.ndarray, seq: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For streams seq[end - length:end]: places where a whole window starts, and the least document with that window.

        Every stream's words must occur in the index. The search goes back word by word, keeping the
        interval of the last ``window`` words: the matching statistic up to the threshold.
        """
        order = np.argsort(-lengths, kind="stable")
        ends, lengths = ends[order], lengths[order]
        low = np.zeros(len(ends), dtype=np.int64)
        high = np.full(len(ends), len(seq), dtype=np.int64)
        places, least = [], []
        for step in range(int(lengths[0]) if len(lengths) else 0):
            live = int(np.searchsorted(-lengths, -step, side="left"))  # streams longer than ``step``
            word = seq[ends[:live] - 1 - step]
            found = self.before[word][None] + self.wavelet.rank(
                np.concatenate([word, word]), np.concatenate([low[:live], high[:live]])
            ).reshape(2, live)
            low[:live], high[:live] = found
            if step + 1 >= self.window:
                kind = np.searchsorted(self.bounds, low[:live], side="right") - 1
                low[:live], high[:live] = self.bounds[kind], self.bounds[kind + 1]
                places.append(ends[:live] - 1 - step)
                least.append(self.least[kind])
        if not places:
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        return np.concatenate(places), np.concatenate(least)


def pieces(starts: np.ndarray, ends: np.ndarray, window: int, size: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """(ends, lengths) of pieces that cover every window of the streams once."""
    step = size - window + 1
    count = np.maximum(1, -(-(ends - starts - window + 1) // step))
    begin = np.repeat(starts, count) + step * (np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count))
    stop = np.minimum(begin + size, np.repeat(ends, count))
    return stop, stop - begin
