"""Repeated passages against plain loops."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from tripweave.llm import fm_index, substring_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window):
    """(doc_id, n_words, n_removed, kept text) by every window of every text."""
    split = [(d, WORD.findall(t or "")) for d, t in rows]
    least = {}
    far = 1 << 63
    for d, words in split:
        for i in range(len(words) - window + 1):
            key = tuple(words[i:i + window])
            least[key] = min(far if d is None else d, least.get(key, far))
    out = []
    for d, words in split:
        gone = set()
        for i in range(len(words) - window + 1):
            if least[tuple(words[i:i + window])] < (far if d is None else d):
                gone.update(range(i, i + window))
        kept = [w for i, w in enumerate(words) if i not in gone]
        out.append((d, len(words), len(gone), " ".join(kept)))
    return out


def by_id(rows):
    return sorted(((r[0] is None, r[0] or 0, *r[1:]) for r in rows))


def random_rows(seed, n, vocabulary, passages, longest=40):
    rnd = random.Random(seed)
    word = lambda: rnd.choice(vocabulary)
    common = [" ".join(word() for _ in range(rnd.randint(3, 15))) for _ in range(passages)]
    rows = []
    for d in range(n):
        parts = [rnd.choice(common) if rnd.random() < 0.5 else " ".join(word() for _ in range(rnd.randint(1, longest))) for _ in range(rnd.randint(0, 4))]
        rows.append((rnd.choice([d, d, d, d // 2, None]), rnd.choice([" ", "\n", "\t\t", "\r\n"]).join(parts)))
    return rows + rows[:5] + [(n + i, rows[7][1]) for i in range(6)]


def test_backward_search_finds_the_least_owner_of_every_window():
    rng = np.random.default_rng(3)
    for window in (1, 2, 5, 8):
        passages = [rng.integers(1, 4, rng.integers(window, 40)) for _ in range(40)]
        owners = rng.integers(0, 20, len(passages))
        seq = np.concatenate([np.append(p, 0) for p in passages]).astype(np.int64)
        owner = np.concatenate([np.full(len(p) + 1, o) for p, o in zip(passages, owners)])
        end = np.cumsum([len(p) + 1 for p in passages]) - 1
        begin = end - [len(p) for p in passages]
        least, want = {}, {}
        for p, o in zip(passages, owners):
            for i in range(len(p) - window + 1):
                key = tuple(p[i:i + window])
                least[key] = min(o, least.get(key, o))
        for p, b in zip(passages, begin):
            want |= {b + i: least[tuple(p[i:i + window])] for i in range(len(p) - window + 1)}
        place, found = fm_index.FmIndex(seq, owner, window).least_owner(*fm_index.pieces(begin, end, window, 2 * window + 1), seq)
        assert len(place) == len(want) and dict(zip(place.tolist(), found.tolist())) == want


@pytest.mark.parametrize("shard_passages", [8192, 40, 4])
@pytest.mark.parametrize("window", [4, 7])
def test_equal_to_plain_loops_with_and_without_hot_anchors(spark, docs_of, window, shard_passages):
    rows = random_rows(window, 120, ["a", "b", "the", "é", "日本", "A", "x" * 90], 6) + random_rows(9, 60, [f"w{i}" for i in range(80)], 3)
    found = substring_dedup.deduplicate(docs_of(rows), window=window, shard_passages=shard_passages)
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in found.collect()]
    assert by_id(got) == by_id(brute(rows, window))


def test_spans_are_the_removed_words(spark, docs_of):
    rows = [(1, "a b c d e f g"), (2, "x b c d e y d e f g z"), (3, "q")]
    found = {r.doc_id: r for r in substring_dedup.deduplicate(docs_of(rows), window=4).collect()}
    assert [(s.start, s.end) for s in found[2].removed] == [(1, 5), (6, 10)]
    assert found[1].removed == [] and found[3].kept_text == "q"


def test_odd_rows_and_no_rows(spark, odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in substring_dedup.deduplicate(odd_docs, window=5).collect()]
    assert by_id(got) == by_id(brute(rows, 5))
    assert substring_dedup.deduplicate(odd_docs.limit(0), window=5).count() == 0


def test_many_documents_share_a_passage_amid_their_own_words(spark, docs_of):
    licence = " ".join(f"l{i}" for i in range(60))
    rows = [(d, f"{' '.join(f'p{d}_{i}' for i in range(8))} {licence} {' '.join(f's{d % 7}_{i}' for i in range(9))}") for d in range(300)]
    found = substring_dedup.deduplicate(docs_of(rows), window=50, shard_passages=64)
    assert by_id([(r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in found.collect()]) == by_id(brute(rows, 50))
