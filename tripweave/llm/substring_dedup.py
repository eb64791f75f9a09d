"""Removal of passages that repeat across documents, by FM-indexes of shards.

1. Every window of words has an anchor: the least hash among its runs of ``GRAM`` words. Equal
   windows have equal anchors, so only anchors in two documents or more are looked at. Copies of a
   whole text are looked at once, under their smallest doc_id.
2. Passages (the windows around a shared anchor) go to the shard of their anchor's hash. A shard
   has an FM-index of its passages and streams them through it by backward search. The statistic of
   a place is whether the window that starts there also starts in a smaller document.
3. An anchor in very many documents would fill a shard. Of its windows only those whose hash two
   documents share are kept, equal passages of them collapse to their smallest document, and what
   is left is indexed in parts, each searched by all of that anchor's passages.

Hashes only decide which words meet; windows are compared as words. No list is cut off.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripweave.llm.batches import map_slices
from tripweave.llm.fm_index import FmIndex, pieces
from tripweave.llm.shingles import groups, mix, word_hashes
from tripweave.session import cut

WINDOW = 50
#: Words of the runs that anchors are chosen among.
GRAM = 8
#: Passages of a shard on average; an anchor with more than half of that is a hot one.
SHARD_PASSAGES = 8192
#: Distinct passages of hot anchors that are sent to every task; beyond that rows are shuffled to them.
BROADCAST_ROWS = 200_000
#: Stands for a missing doc_id, which is larger than every other.
NO_ID = (1 << 63) - 1
SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
_MULTIPLIER = 0xD6E8FEB86659FD93


def _rolled(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of every run of ``size`` words."""
    out = np.zeros(max(0, len(words) - size + 1), dtype=np.uint64)
    for i in range(size):
        out += words[i : i + len(out)] * np.uint64(pow(_MULTIPLIER, i + 1, 1 << 64))
    return mix(out)


def anchors(words: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """For every window of a text's word hashes the place and the hash of its anchor."""
    gram = min(GRAM, window)
    grams = _rolled(words, gram)
    width = window - gram + 1
    if len(grams) < width:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    place = np.concatenate([
        np.lib.stride_tricks.sliding_window_view(grams[at : at + 65536 + width - 1], width).argmin(axis=1) + np.arange(at, min(at + 65536, len(grams) - width + 1))
        for at in range(0, len(grams) - width + 1, 65536)
    ])
    return place, grams[place].view(np.int64)


def _runs(key: np.ndarray, use: np.ndarray) -> Iterator[tuple[int, int]]:
    """(first, last + 1) of the stretches of used windows with one key."""
    if len(key):
        edge = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (use[1:] != use[:-1]), [True]]))
        for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
            if use[a]:
                yield a, b


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The union of spans, sorted and disjoint."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _covered(starts: np.ndarray, window: int) -> list[dict]:
    """The words covered by the windows that start there, as spans."""
    if not len(starts):
        return []
    starts = np.sort(starts)
    edge = np.flatnonzero(np.diff(starts) > window)
    begin = starts[np.concatenate([[0], edge + 1])]
    end = starts[np.concatenate([edge, [len(starts) - 1]])] + window
    return [{"start": a, "end": b} for a, b in zip(begin.tolist(), end.tolist(), strict=True)]


def _prepared(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    return df.select(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("d"), F.md5(F.col(text).cast("binary")).alias("th"),
        F.col(text).alias("text"),
    ).where(F.col("text").isNotNull())


def _anchored(docs: DataFrame, window: int) -> DataFrame:
    """d, th, n_words and the distinct anchors of every text."""

    def start():
        def work(texts: list[str]) -> list[list]:
            sizes, found = [], []
            for group in groups([t.encode() for t in texts]):
                words, bounds = word_hashes(group)
                for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                    sizes.append(int(b - a))
                    found.append(np.unique(anchors(words[a:b], window)[1]).tolist())
            return [sizes, found]

        return work

    added = [T.StructField("n_words", T.LongType()), T.StructField("anchors", T.ArrayType(T.LongType()))]
    return map_slices(docs, ["text"], ["d", "th"], added, start)


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of ``wanted`` (d, th and more) with their text, once each."""
    return docs.groupBy("d", "th").agg(F.first("text").alias("text")).join(wanted, ["d", "th"])


_PASSAGE = "shard long, anchor long, d long, th string, start long, passage binary, hot boolean"


def _passages(texts: DataFrame, window: int, shards: int) -> DataFrame:
    """Passages around the shared anchors (``cold``) and of the shared windows of hot anchors (``hot_starts``)."""
    names = [c.split()[0] for c in _PASSAGE.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                d, th, text, cold, hot_starts = (batch.column(c)[row].as_py() for c in ("d", "th", "text", "cold", "hot_starts"))
                raw = text.encode()
                plain = raw.split()
                place, key = anchors(word_hashes([raw])[0], window)
                out = []
                shard = key % shards  # windows of one shard side by side are one passage
                use = np.isin(key, np.array(cold, dtype=np.int64))
                for a, b in _runs(shard, use):
                    out.append((int(shard[a]), None, d, th, a, b" ".join(plain[a : b + window - 1]), False))
                if hot_starts:
                    use = np.zeros(len(key), dtype=bool)
                    use[hot_starts] = True
                    for a, b in _runs(place, use):
                        out.append((int(key[a]), int(key[a]), d, th, a, b" ".join(plain[a : b + window - 1]), True))
                if out:
                    yield pa.RecordBatch.from_pandas(pd.DataFrame(out, columns=names), schema=_SCHEMA, preserve_index=False)

    return texts.select("d", "th", "text", "cold", "hot_starts").mapInArrow(run, _PASSAGE)


_SCHEMA = pa.schema([
    ("shard", pa.int64()), ("anchor", pa.int64()), ("d", pa.int64()), ("th", pa.string()), ("start", pa.int64()),
    ("passage", pa.binary()), ("hot", pa.bool_()),
])


def _hot_windows(texts: DataFrame, window: int) -> DataFrame:
    """d, th, start and hash of every window whose anchor is in ``hot``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                d, th, text, hot = (batch.column(c)[row].as_py() for c in ("d", "th", "text", "hot"))
                words = word_hashes([text.encode()])[0]
                start = np.flatnonzero(np.isin(anchors(words, window)[1], np.array(hot, dtype=np.int64)))
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(start), d), pa.int64()), pa.array([th] * len(start), pa.string()),
                    pa.array(start, pa.int64()), pa.array(_rolled(words, window)[start].view(np.int64)),
                ], ["d", "th", "start", "w"])

    return texts.select("d", "th", "text", "hot").mapInArrow(run, "d long, th string, start long, w long")


def search_shard(indexed: list[tuple[int, bytes]], streamed: list[tuple[int, bytes]], window: int) -> list[np.ndarray]:
    """For each streamed (document, passage) the places whose window starts in a smaller document.

    Every streamed passage must have its words in the index if it is to be found there: passages
    that are not indexed are added under a document larger than all.
    """
    own = {p for _, p in indexed}
    owner_of: dict[bytes, int] = {}
    for d, p in indexed:
        owner_of[p] = min(d, owner_of.get(p, d))
    for _, p in streamed:
        if p not in own:
            owner_of.setdefault(p, NO_ID)
    passages = list(owner_of)
    parts = [p.split() for p in passages]
    sizes = np.array([len(x) for x in parts])
    flat: list[bytes] = []
    for x in parts:
        flat += x
        flat.append(b" ")
    codes = pd.factorize(np.array(flat, dtype=object))[0]
    end = np.cumsum(sizes + 1) - 1
    stop = codes[end[0]]
    seq = np.where(codes < stop, codes + 1, np.where(codes == stop, 0, codes)).astype(np.int64)
    owner = np.repeat(np.array([owner_of[p] for p in passages], dtype=np.int64), sizes + 1)
    begin = end - sizes
    place, least = FmIndex(seq, owner, window).least_owner(*pieces(begin, end, window), seq)
    order = np.argsort(place, kind="stable")
    place, least = place[order], least[order]
    number = {p: i for i, p in enumerate(passages)}
    out = []
    for d, p in streamed:
        i = number[p]
        a, b = np.searchsorted(place, [begin[i], end[i]])
        out.append(place[a:b][least[a:b] < d] - begin[i])
    return out


def _searched(rows: DataFrame, window: int) -> DataFrame:
    """Covered spans of rows (shard, part, d, th, start, passage, indexed, streamed), a shard at a time."""

    def search(table: pa.Table) -> pa.Table:
        d, th, start, passage, indexed, streamed = (
            table.column(c).to_pylist() for c in ("d", "th", "start", "passage", "indexed", "streamed")
        )
        asked = [i for i, s in enumerate(streamed) if s]
        found = search_shard(
            [(d[i], passage[i]) for i, x in enumerate(indexed) if x], [(d[i], passage[i]) for i in asked], window
        ) if asked else []
        spans = [_covered(f + start[i], window) for i, f in zip(asked, found, strict=True)]
        kept = [(i, s) for i, s in zip(asked, spans, strict=True) if s]
        return pa.table({
            "d": pa.array([d[i] for i, _ in kept], pa.int64()), "th": pa.array([th[i] for i, _ in kept], pa.string()),
            "spans": pa.array([s for _, s in kept], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
        })

    return rows.groupBy("shard", "part").applyInArrow(search, "d long, th string, spans array<struct<start:long,end:long>>")


def _hot_rows(hot: DataFrame, window: int, shard_passages: int) -> tuple[DataFrame, DataFrame]:
    """Hot passages: those that start whole in a smaller document, with spans, and the rest as rows to search.

    Of equal passages one stays, of the smallest document. An anchor with more distinct passages
    than a shard takes is indexed in parts.
    """
    hot = hot.withColumn("key", F.md5("passage"))
    least = cut(hot.groupBy("anchor", "key").agg(F.min("d").alias("least")))
    # a passage may be in a third of all documents, so the distinct ones travel while they are few
    placed = hot.join(F.broadcast(least) if least.count() <= BROADCAST_ROWS else least, ["anchor", "key"])
    length = F.col("n_passage_words")
    whole = placed.where("d > least").select(
        "d", "th", F.array(F.struct(F.col("start").alias("start"), (F.col("start") + length).alias("end"))).alias("spans")
    )
    parts = cut(least.groupBy("anchor").agg(F.ceil(F.count("*") / shard_passages).cast("int").alias("parts")))
    one = placed.where("d = least").join(parts, "anchor").withColumn("own", F.pmod(F.xxhash64("key"), "parts").cast("int"))
    spread = one.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return whole, spread.select(
        "shard", "part", "d", "th", "start", "passage", (F.col("own") == F.col("part")).alias("indexed"), F.lit(True).alias("streamed")
    )


def repeated(df: DataFrame, *, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text", shard_passages: int = SHARD_PASSAGES) -> tuple[DataFrame, DataFrame]:
    """(classes, spans): per (d, th) of a distinct text whether a smaller document has it whole, and the word spans to remove.

    classes has th, least (the smallest doc_id with that text) and n_words; spans has d, th and spans
    for the texts of smallest doc_id.
    """
    docs = _prepared(df, doc_id, text)
    rows = cut(_anchored(docs, window))
    classes = cut(rows.groupBy("th").agg(F.min("d").alias("d"), F.first("n_words").alias("n_words"), F.first("anchors").alias("anchors")))
    entries = classes.select("d", "th", F.explode("anchors").alias("anchor"))
    shared = cut(entries.groupBy("anchor").agg(
        F.count("*").alias("n"), F.min("d").alias("low"), F.max("d").alias("high")
    ).where("low < high").select("anchor", "n"))
    total = shared.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.max("n"), F.lit(0)).alias("most")).first()
    shards = max(1, -(-total.n // shard_passages))
    is_hot = F.col("n") > shard_passages // 2
    of_doc = lambda keep: F.transform(F.filter("a", lambda x: x["hot"] == keep), lambda x: x["anchor"])
    wanted = entries.join(shared, "anchor").groupBy("d", "th").agg(
        F.collect_list(F.struct(F.col("anchor"), is_hot.alias("hot"))).alias("a")
    ).select("d", "th", of_doc(False).alias("cold"), of_doc(True).alias("hot"))
    if total.most <= shard_passages // 2:
        texts = _texts(docs, wanted).withColumn("hot_starts", F.array().cast("array<long>"))
        passages = _passages(texts, window, shards)
        todo = passages.select("shard", F.lit(0).alias("part"), "d", "th", "start", "passage", F.lit(True).alias("indexed"), F.lit(True).alias("streamed"))
        found = _searched(todo, window)
    else:
        wanted = cut(wanted)
        windows = cut(_hot_windows(_texts(docs, wanted.where(F.size("hot") > 0)), window))
        twice = cut(windows.groupBy("w").agg(F.min("d").alias("low"), F.max("d").alias("high")).where("low < high").select("w"))
        starts = windows.join(twice, "w").groupBy("d", "th").agg(F.array_sort(F.collect_set("start")).alias("hot_starts"))
        wanted = wanted.join(starts, ["d", "th"], "left").withColumn("hot_starts", F.coalesce("hot_starts", F.array().cast("array<long>")))
        passages = cut(_passages(_texts(docs, wanted), window, shards))
        words = F.size(F.split(F.col("passage").cast("string"), " ", -1))
        whole, rest = _hot_rows(passages.where("hot").withColumn("n_passage_words", words.cast("long")), window, shard_passages)
        todo = passages.where("NOT hot").select(
            "shard", F.lit(0).alias("part"), "d", "th", "start", "passage", F.lit(True).alias("indexed"), F.lit(True).alias("streamed")
        ).unionByName(rest)
        found = _searched(todo, window).unionByName(whole)
    spans = found.groupBy("d", "th").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    return classes.select("th", F.col("d").alias("least"), "n_words"), spans


def deduplicate(
    df: DataFrame, *, window: int = WINDOW, keep: tuple[str, ...] | list[str] = ("doc_id",), doc_id: str = "doc_id", text: str = "text",
    shard_passages: int = SHARD_PASSAGES,
) -> DataFrame:
    """The ``keep`` columns, n_words, n_removed, removed (word spans, end exclusive) and kept_text.

    A word goes if a window of ``window`` consecutive words covers it whose words, in their order,
    also start in a document with a smaller doc_id. Words are runs of bytes other than space, tab,
    line feed, vertical tab, form feed and carriage return, unchanged; kept words are joined by
    one space. Windows are judged on the texts as they are. Null, empty and short texts lose
    nothing (a null text has no words and an empty kept_text). Rows that share a doc_id do not
    judge each other; a missing doc_id is larger than every other, and two missing ones are equal.
    Equal rows give equal results. A very long text is handled by itself in one task, a few dozen
    bytes a word. An empty table gives no rows; other columns are not read.
    """
    names = {c: f"k{i}" for i, c in enumerate(keep)}
    classes, spans = repeated(df, window=window, doc_id=doc_id, text=text, shard_passages=shard_passages)
    rows = df.select(
        *[F.col(c).alias(n) for c, n in names.items()], F.col(text).alias("text"),
        F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("d"),
    ).withColumn("th", F.md5(F.col("text").cast("binary")))
    copies = classes.where(F.col("n_words") >= window).select("th", "least")
    # a copy of a smaller document's text goes whole, so it needs no spans and no place beside other copies
    told = spans.select("th", F.col("d").alias("least"), "spans")
    verdicts = copies.join(told, ["th", "least"], "left")
    found = rows.join(verdicts, "th", "left")

    def start():
        def work(texts: list[str | None], d: list[int], least: list[int | None], spans: list) -> list[list]:
            out: list[list] = [[], [], [], []]
            for t, own, low, cut_out in zip(texts, d, least, spans, strict=True):
                words = (t or "").encode().split()
                gone = merged([(s["start"], s["end"]) for s in cut_out or []])
                if low is not None and low < own:
                    gone = [(0, len(words))]
                left, at = [], 0
                for a, b in gone:
                    left += words[at:a]
                    at = b
                left += words[at:]
                out[0].append(len(words))
                out[1].append(len(words) - len(left))
                out[2].append([{"start": a, "end": b} for a, b in gone])
                out[3].append(b" ".join(left).decode())
            return out

        return work

    added = [
        T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
        T.StructField("removed", T.ArrayType(SPAN)), T.StructField("kept_text", T.StringType()),
    ]
    done = map_slices(found, ["text", "d", "least", "spans"], list(names.values()), added, start)
    return done.select(*[F.col(n).alias(c) for c, n in names.items()], "n_words", "n_removed", "removed", "kept_text")
