"""Compressed postings of a shard of documents, and their search by Block-Max MaxScore.

Documents are numbered within the shard. A term's postings come in blocks of ``BLOCK``: gaps and
frequencies as variable-length bytes, with the block's first and last document and its largest
impact outside, so a block can be passed over without reading its bytes.
"""

from __future__ import annotations

import numpy as np

BLOCK = 64
#: Documents looked at in the first range of a search, and at most; each range doubles.
FIRST_RANGE, LAST_RANGE = 1024, 32768
#: Fixed values of the score: a term's impact is (SCALE * tf) div (1000 * tf + 20 * m).
SCALE, TF_FACTOR, LENGTH_FACTOR = 10**9, 1000, 20


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (SCALE * tf) // (TF_FACTOR * tf + LENGTH_FACTOR * m)


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-negative integers as bytes of seven bits each, low ones first, and the place behind each value."""
    size = np.ones(len(values), dtype=np.int64)
    for bits in range(7, 63, 7):
        size += values >= (1 << bits)
    end = np.cumsum(size)
    out = np.zeros(int(end[-1]) if len(end) else 0, dtype=np.uint8)
    for k in range(int(size.max()) if len(size) else 0):
        has = size > k
        more = (size[has] > k + 1).astype(np.uint8) << 7
        out[end[has] - size[has] + k] = ((values[has] >> (7 * k)) & 127).astype(np.uint8) | more
    return out, end


def decode(data: np.ndarray) -> np.ndarray:
    last = np.flatnonzero(data < 128)
    if not len(last):
        return np.empty(0, dtype=np.int64)
    begin = np.concatenate([[0], last[:-1] + 1])
    within = np.arange(len(data)) - np.repeat(begin, last - begin + 1)
    return np.add.reduceat((data & 127).astype(np.int64) << (7 * within), begin)


class Postings:
    """``term``, ``doc``, ``tf`` of every posting, ``m`` of every document, ``weight`` of every term (all integers)."""

    def __init__(self, term: np.ndarray, doc: np.ndarray, tf: np.ndarray, m: np.ndarray, weight: np.ndarray):
        order = np.lexsort((doc, term))
        term, doc, tf = term[order], doc[order], tf[order]
        self.m, self.weight, self.n_docs = m, weight, len(m)
        edge = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]])) if len(term) else np.empty(0, dtype=np.int64)
        length = np.diff(np.append(edge, len(term)))
        blocks = -(-length // BLOCK)
        start = np.repeat(edge, blocks) + BLOCK * (np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks))
        stop = np.minimum(start + BLOCK, np.repeat(edge + length, blocks))
        self.first, self.last = doc[start], doc[stop - 1]
        gap = np.diff(doc, prepend=0)
        gap[start] = 0
        both = np.empty(2 * len(doc), dtype=np.int64)
        both[0::2], both[1::2] = gap, tf
        self.data, end = encode(both)
        behind = np.concatenate([[0], end])
        self.at, self.to, self.size = behind[2 * start], behind[2 * stop], stop - start
        impact = impacts(tf, m[doc])
        self.block_max = np.maximum.reduceat(impact, start) if len(start) else impact
        self.list_max = np.maximum.reduceat(impact, edge) if len(edge) else impact
        self.first_block = np.append(np.cumsum(blocks) - blocks, blocks.sum())
        self.row = {int(t): i for i, t in enumerate(term[edge])}

    def read(self, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents and impacts of some blocks of one list, in order."""
        width = self.to[blocks] - self.at[blocks]
        take = np.repeat(self.at[blocks] - (np.cumsum(width) - width), width) + np.arange(width.sum())
        values = decode(self.data[take])
        gap, tf = values[0::2], values[1::2]
        size = self.size[blocks]
        begin = np.cumsum(size) - size
        run = np.cumsum(gap)
        doc = run - np.repeat(run[begin] - self.first[blocks], size)
        return doc, impacts(tf, self.m[doc])

    def best(self, terms: list[int], k: int, ids: np.ndarray, kept: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(scores, ids) of the k best among ``kept`` and this shard's documents with a score above 0.

        ``ids`` names the shard's documents. Larger scores are better, then smaller ids.
        """
        lists = [(int(self.weight[t]), self.row[t]) for t in terms if t in self.row and self.weight[t] > 0]
        lists.sort(key=lambda x: x[0] * int(self.list_max[x[1]]))
        if not lists:
            return kept
        bound = np.concatenate([[0], np.cumsum([w * int(self.list_max[r]) for w, r in lists])])  # of the first i lists
        low, size = 0, FIRST_RANGE
        while low < self.n_docs:
            least = int(kept[0].min()) if len(kept[0]) >= k else 1
            essential = int(np.searchsorted(bound, least)) - 1  # lists before it cannot reach ``least`` by themselves
            if essential >= len(lists):
                break
            high = min(self.n_docs, low + size)
            docs, scores = self._range(lists, bound, essential, low, high, least)
            if len(docs):
                kept = _largest(np.concatenate([kept[0], scores]), np.concatenate([kept[1], ids[docs]]), k)
            low, size = high, min(2 * size, LAST_RANGE)
        return kept

    def _range(self, lists: list, bound: np.ndarray, essential: int, low: int, high: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents from ``low`` to ``high`` with scores of ``least`` and more."""
        total = np.zeros(high - low, dtype=np.int64)
        for weight, row in lists[essential:]:
            a, b = self.first_block[row], self.first_block[row + 1]
            use = np.arange(a + np.searchsorted(self.last[a:b], low), a + np.searchsorted(self.first[a:b], high))
            if len(use):
                doc, impact = self.read(use)
                inside = (doc >= low) & (doc < high)
                total[doc[inside] - low] += weight * impact[inside]
        docs = np.flatnonzero(total)
        scores = total[docs]
        docs = docs + low
        for i in range(essential - 1, -1, -1):
            possible = scores + bound[i + 1] >= least
            docs, scores = docs[possible], scores[possible]
            if not len(docs):
                break
            weight, row = lists[i]
            a, b = self.first_block[row], self.first_block[row + 1]
            block = np.minimum(a + np.searchsorted(self.last[a:b], docs), b - 1)
            holds = (self.first[block] <= docs) & (docs <= self.last[block])
            possible = scores + np.where(holds, weight * self.block_max[block], 0) + bound[i] >= least
            docs, scores, block, holds = docs[possible], scores[possible], block[possible], holds[possible]
            if holds.any():
                doc, impact = self.read(np.unique(block[holds]))
                place = np.minimum(np.searchsorted(doc, docs), len(doc) - 1)
                scores = scores + np.where(doc[place] == docs, weight * impact[place], 0)
        enough = scores >= least
        return docs[enough], scores[enough]


def _largest(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]
