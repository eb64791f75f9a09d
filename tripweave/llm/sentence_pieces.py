"""SentencePiece encoding and decoding through a table of distinct marked words.

No piece of the model has a whitespace marker after another character, so merges never cross
the start of a run of markers. A text is cut there, each distinct marked word is segmented once
(see word_table) and the ids are joined back by position. The table is kept by each Python
worker: a table for the whole corpus would have to shuffle every position of every text twice,
many times the input, while the distinct words of a worker fit in memory.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tripweave.llm.batches import map_slices
from tripweave.llm.word_table import WordTable, packed, table_for

MARK = "▁"
_MARKED = re.compile(" +[^ ]*")


def _processor(model_path: str):
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=model_path)


def check_model(model_path: str) -> None:
    """Raises if pieces of the model can cross the start of a run of whitespace markers."""
    model = _processor(model_path)
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if not model.is_control(i) and re.search(f"[^{MARK}]{MARK}", piece):
            raise ValueError(f"piece {piece!r} crosses a whitespace marker")


def marked_words(text: str) -> list[str]:
    """The text's words without their first marker: joined with spaces, the text again.

    A run of spaces belongs to the word after it. The marker itself counts as a space.
    """
    if MARK in text:
        text = text.replace(MARK, " ")
    if "  " not in text and text[:1] != " ":
        return text.split(" ") if text else []
    return [w[1:] for w in _MARKED.findall(" " + text)]


def _segmenter(model_path: str) -> Callable[[list[str]], list[list[int]]]:
    model = _processor(model_path)
    mark = [model.piece_to_id(MARK)]  # a marker with nothing behind it, at the end of a text

    def segment(words: list[str]) -> list[list[int]]:
        return [ids if word else mark for word, ids in zip(words, model.encode(words, num_threads=1), strict=True)]

    return segment


def encode(
    df: DataFrame, model_path: str, *, text: str = "text", keep: list[str], ends: bool = True
) -> DataFrame:
    """``keep`` plus ``ids`` (binary, little-endian unsigned 32-bit) and ``n_tokens``.

    ids equal the library's for the whole text, with begin and end ids if ``ends``. A null text
    counts as empty: its begin and end ids alone. Repeated rows stay; an empty table gives an
    empty one. Columns outside ``keep`` are not returned; a kept ``ids`` or ``n_tokens`` is replaced.
    """
    check_model(model_path)

    def start():
        model = _processor(model_path)
        table = table_for(("pieces", model_path), lambda: WordTable(_segmenter(model_path)))
        first, last = (packed([model.bos_id()]), packed([model.eos_id()])) if ends else (b"", b"")

        def work(texts: list[str | None]) -> list[list]:
            ids = [first + x + last for x in table.join([marked_words(t or "") for t in texts])]
            return [ids, [len(x) // 4 for x in ids]]

        return work

    added = [T.StructField("ids", T.BinaryType()), T.StructField("n_tokens", T.LongType())]
    return map_slices(df, [text], keep, added, start)


def decode(df: DataFrame, model_path: str, *, ids: str = "ids", keep: list[str]) -> DataFrame:
    """``keep`` plus ``decoded``, the library's text for packed ``ids``; null or no ids give ''."""

    def start():
        model = _processor(model_path)

        def work(packs: list[bytes | None]) -> list[list]:
            return [[model.decode(memoryview(p).cast("I").tolist()) if p else "" for p in packs]]

        return work

    return map_slices(df, [ids], keep, [T.StructField("decoded", T.StringType())], start)
