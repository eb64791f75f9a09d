"""Tokenization against the libraries, and packing against its definition."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from tripweave.llm import bin_slack, queries, sentence_pieces
from tripweave.llm.word_table import WordTable, packed

PIECES = public_tokenizers.path("piece_bpe_32k.model")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PARTS = [
    "a", "b", "the", "é", "▁", " ", "  ", "   ", "\n", "\t", "\x00", "1", "23", ".", ",", "'s", "<s>", "</s>", "<|endoftext|>",
    "<0x41>", "日本", "🙂", "　", "\r\n", "İ", "ß", "ﬁ", "x" * 70, "﻿", "​", "́", "\x1c",
]


def _texts(n):
    rnd = random.Random(5)
    made = ["".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 25))) for _ in range(n)]
    return [*made, "", " ", "  ", "   a", " a", "a ", "a  ", "\n ", "\n  b", "ab " * 5000]


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=PIECES)


@pytest.fixture(scope="module")
def byte_bpe():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


@pytest.mark.parametrize("room", [50, 100_000])
def test_words_join_to_the_library_ids(library, room):
    sentence_pieces.check_model(PIECES)
    table = WordTable(sentence_pieces._segmenter(PIECES), room)
    texts = _texts(3000)
    for at in range(0, len(texts), 200):
        part = texts[at:at + 200]
        got = table.join([sentence_pieces.marked_words(t) for t in part])
        assert got == [packed(x) for x in library.encode(part)]
        assert len(table) <= max(room, 200 * 30)


def test_encode_and_decode_rows(spark, odd_docs, library):
    encoded = sentence_pieces.encode(odd_docs, PIECES, keep=["doc_id", "text"])
    rows = sentence_pieces.decode(encoded, PIECES, keep=["doc_id", "text", "ids", "n_tokens"]).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        ids = library.encode(r.text or "", add_bos=True, add_eos=True)
        assert bytes(r.ids) == packed(ids) and r.n_tokens == len(ids) and r.decoded == library.decode(ids)
    assert sentence_pieces.encode(odd_docs.limit(0), PIECES, keep=["doc_id"]).count() == 0


def test_registered_piece_query(spark, library):
    from tests.conftest import SF
    from tripweave.llm import queries

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in queries.op7_sentencepiece(spark, SF).collect():
        ids = library.encode(texts[r.doc_id], add_bos=True, add_eos=True)
        assert r.ids_sha256 == hashlib.sha256(packed(ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_rank_file_gives_the_ids_of_the_vocabulary(byte_bpe):
    encode = bin_slack.encoder(RANKS)
    for text in _texts(3000):
        assert encode(text) == byte_bpe.encode(text, add_special_tokens=False).ids


def test_added_tokens_give_the_ids_of_the_library(spark, docs_of):
    default = Tokenizer.from_file(VOCABULARY)
    encode = bin_slack.encoder(RANKS, VOCABULARY)
    marked = "a <|endoftext|> b"
    assert encode(marked) == [64, 220, 50256, 275]
    for text in [*_texts(3000), "<|endoftext|>", "x  <|endoftext|>\n\n<|endoftext|>", "<|endoftext|", "<<|endoftext|>>"]:
        assert encode(text) == default.encode(text, add_special_tokens=False).ids
    rows = queries.packed_documents(spark, docs_of([(1, marked), (2, "a b")])).collect()
    _check_packing(rows, lambda i: [*default.encode({1: marked, 2: "a b"}[i], add_special_tokens=False).ids, 2])


def test_long_blank_runs_give_the_ids_of_the_library(spark, docs_of, monkeypatch):
    default = Tokenizer.from_file(VOCABULARY)
    encode = bin_slack.encoder(RANKS, VOCABULARY)
    vast = "x" + " " * 1_000_000 + "y"
    for text in (vast, vast[:-1], " \n" * 600_000 + "<|endoftext|>" + "\u3000" * 20_000 + "b"):
        assert encode(text) == default.encode(text, add_special_tokens=False).ids
    rows = queries.packed_documents(spark, docs_of([(1, vast)])).collect()
    _check_packing(rows, lambda _: [*default.encode(vast, add_special_tokens=False).ids, 2])
    # the same cuts at short runs, for every blank of Unicode or of Python
    monkeypatch.setattr(bin_slack, "RUN", 2)
    monkeypatch.setattr(bin_slack, "_LONG_RUN", re.compile(f"[{bin_slack._BLANKS}]{{2,}}"))
    blanks = [c for c in map(chr, range(0x3001)) if c.isspace() or c in "\u180e\u200b\u200c\u2060"]
    rnd = random.Random(9)
    for text in [*_texts(1000), *("".join(rnd.choice([*blanks, *blanks, "a", "1", ".", "'s"]) for _ in range(20)) for _ in range(3000))]:
        assert encode(text) == default.encode(text, add_special_tokens=False).ids


def test_fullest_is_the_best_subset():
    rnd = random.Random(3)
    for _ in range(300):
        lengths = [rnd.randint(1, 12) for _ in range(rnd.randint(0, 7))]
        room = rnd.randint(0, 25)
        counts = {x: lengths.count(x) for x in lengths}
        best = max(sum(c) for n in range(len(lengths) + 1) for c in itertools.combinations(lengths, n) if sum(c) <= room)
        chosen = bin_slack.fullest(counts, room)
        assert sum(chosen) == best and all(chosen.count(x) <= counts[x] for x in chosen)


def test_plan_places_every_rank_once():
    rnd = random.Random(4)
    counts = {x: rnd.randint(0, 60) for x in range(1, 65)}
    places = bin_slack.plan(counts, 64)
    for length, n in counts.items():
        ranks = sorted(r for x, a, b, _, _ in places if x == length for r in range(a, b))
        assert ranks == list(range(n))
    used = 1 + max(s + b - a - 1 for _, a, b, s, _ in places)
    assert used <= 1.06 * -(-sum(x * n for x, n in counts.items()) // 64)
    assert bin_slack.plan({}, 64) == []
    with pytest.raises(ValueError):
        bin_slack.plan({65: 1}, 64)


def _check_packing(rows, ids_of, capacity=1024):
    sequences, texts = {}, {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        texts.setdefault(r.doc_id, []).append(r)
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    for doc_id, pieces in texts.items():
        ids = ids_of(doc_id)
        pieces = sorted(pieces, key=lambda r: r.piece)
        assert [p.piece for p in pieces] == list(range(len(pieces)))
        assert all(p.length == capacity for p in pieces[1:]) and sum(p.length for p in pieces) == len(ids)
        at = 0
        for p in pieces:
            assert p.start == at and p.ids_crc32 == zlib.crc32(packed(ids[at:at + p.length]))
            at += p.length
    return len(sequences)


def test_registered_packing_query(spark, byte_bpe):
    from tests.conftest import SF
    from tripweave.llm import queries

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op8_packing(spark, SF).collect()
    assert {r.doc_id for r in rows} == set(texts)
    used = _check_packing(rows, lambda i: [*byte_bpe.encode(texts[i], add_special_tokens=False).ids, 2])
    assert used <= 1.01 * -(-sum(r.length for r in rows) // 1024) + 1


def test_odd_rows_are_packed(spark, odd_docs):
    pieces = bin_slack.tokenize(odd_docs, RANKS, keep=["doc_id"], end_id=2)
    rows = bin_slack.pack(spark, pieces, parts=2).collect()
    assert len(rows) == pieces.count() and len({(r.sequence_id, r.offset) for r in rows}) == len(rows)
    assert {r.length for r in rows if r.doc_id in (2, 3)} == {1}  # the end id alone
    assert bin_slack.pack(spark, bin_slack.tokenize(odd_docs.limit(0), RANKS, keep=["doc_id"], end_id=2)).count() == 0
