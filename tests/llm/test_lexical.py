"""Ranked search against plain loops."""

from __future__ import annotations

import math
import random
import re

import numpy as np
import pytest

from tripweave.llm import lexical_search, postings

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(rows, items, k):
    docs = [(d, terms(t)) for d, t in rows]
    docs = [x for x in docs if x[1]]
    n_docs, total = len(docs), sum(len(t) for _, t in docs)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    out = []
    for i, wanted in asked.items():
        found = []
        for d, ts in docs:
            score, m = 0, 50 + (50 * len(ts) * n_docs) // total
            for t in wanted:
                tf, df = ts.count(t), sum(t in x for _, x in docs)
                if tf:
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) * ((10**9 * tf) // (1000 * tf + 20 * m))
            if score > 0:
                found.append((-score, d is None, d or 0))
        found.sort()
        out += [(i, r + 1, None if null else d, -s) for r, (s, null, d) in enumerate(found[:k])]
    return sorted(out, key=lambda x: (x[0] is None, x[0] or 0, x[1]))


def random_rows(seed, n, long=12):
    rnd = random.Random(seed)
    words = ["The", "the", "é", "É", "日本", "a1", "0", "x", "_", "--"] + [f"w{i}" for i in range(60)]
    pick = lambda: words[min(len(words) - 1, int(rnd.expovariate(0.08)))]
    return [(rnd.choice([d, d, d, 3, None]), " ".join(pick() for _ in range(rnd.randint(0, long)))) for d in range(n)]


@pytest.mark.parametrize("shard_docs", [65_536, 16])
@pytest.mark.parametrize("query_terms", [200_000, 20])
def test_equal_to_plain_loops(spark, docs_of, shard_docs, query_terms):
    rows = random_rows(1, 250) + [(900 + i, "the w1 w2") for i in range(30)]
    items = [(i, t) for i, (_, t) in enumerate(random_rows(2, 25, 8))] + [(3, "w5 again"), (None, "w7"), (77, None), (78, "nowhere"), (79, "")]
    asked = spark.createDataFrame(items, "item_id long, text string")
    for k in (1, 5, 300):
        found = lexical_search.ranked(docs_of(rows), asked, k=k, shard_docs=shard_docs, query_terms=query_terms)
        got = sorted(map(tuple, found.select("item_id", "rank", "doc_id", "score").collect()), key=lambda x: (x[0] is None, x[0] or 0, x[1]))
        assert got == brute(rows, items, k)


def test_bytes_of_postings_come_back():
    rng = np.random.default_rng(2)
    values = np.concatenate([rng.integers(0, 1 << int(b), 200) for b in rng.integers(1, 40, 40)] + [[0, 127, 128, 16383, 16384]])
    data, end = postings.encode(values)
    assert (postings.decode(data) == values).all() and end[-1] == len(data)


def test_search_of_a_shard_equals_all_scores(monkeypatch):
    """Many blocks and ranges, few winners: bounds must reject no winner, and must reject some blocks."""
    monkeypatch.setattr(postings, "FIRST_RANGE", 64)
    rng = np.random.default_rng(4)
    n_docs, n_terms = 5000, 30
    held = rng.random((n_docs, n_terms)) < np.linspace(0.01, 0.7, n_terms)
    doc, term = np.nonzero(held)
    tf = rng.geometric(0.5, len(doc))
    m = rng.integers(50, 400, n_docs)
    weights = np.array([lexical_search.weight(n_docs, int(c)) for c in held.sum(axis=0)], dtype=np.int64)
    shard = postings.Postings(term, doc, tf, m, weights)
    ids = rng.permutation(n_docs) // 2
    table = np.zeros((n_docs, n_terms), dtype=np.int64)
    table[doc, term] = postings.impacts(tf, m[doc]) * weights[term]
    read = []
    original = shard.read
    shard.read = lambda blocks: read.append(len(blocks)) or original(blocks)
    none = (np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64))
    for asked in ([0], [29], list(range(30)), [0, 3, 28, 29], [1, 40]):
        scores = table[:, [t for t in asked if t < n_terms]].sum(axis=1)
        order = np.lexsort((ids, -scores))[:10]
        got = shard.best(asked, 10, ids, none)
        assert got[0].tolist() == scores[order].tolist() and got[1].tolist() == ids[order].tolist()
    read.clear()
    shard.best([0, 1, 28, 29], 10, ids, none)
    rows = [shard.row[t] for t in (0, 1, 28, 29)]
    assert sum(read) < sum(int(shard.first_block[r + 1] - shard.first_block[r]) for r in rows)


def test_odd_documents_and_no_rows(spark, odd_docs):
    items = spark.createDataFrame([(1, "Word one 日本"), (2, "id here")], "item_id long, text string")
    rows = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    got = sorted(map(tuple, lexical_search.ranked(odd_docs, items).select("item_id", "rank", "doc_id", "score").collect()))
    assert got == brute(rows, [(1, "Word one 日本"), (2, "id here")], 50)
    assert lexical_search.ranked(odd_docs.limit(0), items).count() == 0
    assert lexical_search.ranked(odd_docs, items.limit(0)).count() == 0
