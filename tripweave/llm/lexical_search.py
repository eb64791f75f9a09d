"""Ranked lexical search of many items over all documents, by Block-Max MaxScore in shards.

1. Documents are reduced to the terms that some item has, with frequencies and length; counts over
   all documents (how many there are, their terms, document frequencies) are aggregated from that.
2. Every task cuts its documents into shards, builds compressed postings of each, and searches all
   items in one shard after the other with the heap of the ones before: bounds of whole lists part
   essential from non-essential lists, and maxima of blocks reject candidates before a block of a
   non-essential list is read.
3. The heaps of the tasks are merged.

Items come in blocks of a bounded number of terms, each searched over all documents.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripweave.llm.batches import map_slices
from tripweave.llm.postings import Postings
from tripweave.session import cut

K = 50
#: Terms of the items that are searched together, and documents and postings in a shard.
QUERY_TERMS, SHARD_DOCS, SHARD_POSTINGS = 200_000, 65_536, 2_000_000
#: Groups of tasks whose heaps are merged before all are.
MERGES = 64
NO_ID = (1 << 63) - 1
#: Bytes of terms: digits, letters and all beyond ASCII; A-Z become a-z, others part terms.
_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_TABLE).split()


def weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def length_norm(n: int, docs: int, total: int) -> int:
    return 100 - 50 + (50 * n * docs) // total


def counted(df: DataFrame, vocabulary: dict[bytes, int], *, doc_id: str, text: str) -> DataFrame:
    """id, n, terms and tfs (of the vocabulary) for every document with a term."""

    def start():
        def work(ids: list[int | None], texts: list[str | None]) -> list[list]:
            out: list[list] = [[], [], [], []]
            for d, t in zip(ids, texts, strict=True):
                found = terms_of(t)
                held = [(vocabulary[x], c) for x, c in Counter(found).items() if x in vocabulary]
                out[0].append(NO_ID if d is None else d)
                out[1].append(len(found))
                out[2].append([x for x, _ in held])
                out[3].append([c for _, c in held])
            return out

        return work

    added = [
        T.StructField("id", T.LongType()), T.StructField("n", T.LongType()), T.StructField("terms", T.ArrayType(T.IntegerType())),
        T.StructField("tfs", T.ArrayType(T.IntegerType())),
    ]
    rows = df.select(F.col(doc_id).cast("long").alias("d"), F.col(text).alias("t"))
    return map_slices(rows, ["d", "t"], [], added, start).where("n > 0")


def _search(rows: DataFrame, items: list[list[int]], weights: np.ndarray, docs: int, total: int, k: int, shard_docs: int, shard_postings: int) -> DataFrame:
    """(item, id, score): the k best documents of every task for every item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = (np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64))
        heaps = [none] * len(items)
        held: list[tuple] = []

        def close() -> None:
            if held:
                ids, n, sizes, terms, tfs = (np.concatenate(x) for x in zip(*held, strict=True))
                m = np.array([length_norm(x, docs, total) for x in n.tolist()], dtype=np.int64)
                shard = Postings(terms, np.repeat(np.arange(len(ids)), sizes), tfs, m, weights)
                for i, asked in enumerate(items):
                    heaps[i] = shard.best(asked, k, ids, heaps[i])
                held.clear()

        have = 0
        for batch in batches:
            step = max(1, min(shard_docs, 1024))
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                lists = part.column("terms")
                terms = np.asarray(lists.flatten(), dtype=np.int64)
                sizes = np.asarray(lists.value_lengths(), dtype=np.int64)
                tfs = np.asarray(part.column("tfs").flatten(), dtype=np.int64)
                held.append((np.asarray(part.column("id")), np.asarray(part.column("n")), sizes, terms, tfs))
                have += len(terms)
                if have >= shard_postings or sum(len(x[0]) for x in held) >= shard_docs:
                    close()
                    have = 0
        close()
        sizes = [len(h[0]) for h in heaps]
        if sum(sizes):
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat(np.arange(len(items)), sizes), pa.int32()), pa.array(np.concatenate([h[1] for h in heaps]), pa.int64()),
                pa.array(np.concatenate([h[0] for h in heaps]), pa.int64()),
            ], ["item", "id", "score"])

    found = rows.select("id", "n", "terms", "tfs").mapInArrow(run, "item int, id long, score long")
    return found.withColumn("merge", F.pmod(F.spark_partition_id(), F.lit(MERGES)))


def ranked(
    df: DataFrame, items: DataFrame, *, k: int = K, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
    query_terms: int = QUERY_TERMS, shard_docs: int = SHARD_DOCS, shard_postings: int = SHARD_POSTINGS,
) -> DataFrame:
    """item_id, rank, doc_id, score: each item's k documents of the highest score above 0, ties to the smaller doc_id.

    Terms are runs of digits, ASCII letters and characters beyond ASCII in the whole text, A-Z in
    lower case; null and empty texts have none. Scores are 64-bit integers as ``weight``,
    ``length_norm`` and ``postings.impacts`` define them. Rows of ``items`` with one item_id are one
    item with the terms of all; null is an item_id like others. Every row of ``df`` is a document:
    repeated rows rank side by side, a missing doc_id comes after all others of its score. Very
    long texts count whole. Without documents or items there are no rows; other columns are not read.
    """
    spark = df.sparkSession
    asked = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).alias("text"))

    def start():
        return lambda texts: [[sorted(set(terms_of(t))) for t in texts]]

    split = map_slices(asked, ["text"], ["item_id"], [T.StructField("terms", T.ArrayType(T.BinaryType()))], start)
    asked = cut(split.select("item_id", F.explode("terms").alias("term")).distinct())
    blocks = max(1, -(-asked.count() // query_terms))
    out = None
    for block in range(blocks):
        part = asked.where(F.pmod(F.xxhash64(F.col("item_id").isNull(), "item_id"), F.lit(blocks)) == block)
        texts: dict[int | None, list[bytes]] = {}
        for row in part.collect():  # at most about ``query_terms`` rows
            texts.setdefault(row.item_id, []).append(bytes(row.term))
        found = _block(df, texts, k, doc_id, text, shard_docs, shard_postings)
        if found is not None:
            out = found if out is None else out.unionByName(found)
    return out if out is not None else spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")


def _block(df: DataFrame, texts: dict, k: int, doc_id: str, text: str, shard_docs: int, shard_postings: int) -> DataFrame | None:
    vocabulary = {t: i for i, t in enumerate(sorted({x for terms in texts.values() for x in terms}))}
    rows = cut(counted(df, vocabulary, doc_id=doc_id, text=text))
    docs, total = rows.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    if not docs or not vocabulary:
        return None
    frequency = np.zeros(len(vocabulary), dtype=np.int64)
    for row in rows.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # a row for each term asked for
        frequency[row.term] = row["count"]
    weights = np.array([weight(docs, int(f)) for f in frequency], dtype=np.int64)
    names = list(texts)
    found = _search(rows, [[vocabulary[t] for t in texts[i]] for i in names], weights, docs, total, k, shard_docs, shard_postings)
    for by in (["item", "merge"], ["item"]):
        best = Window.partitionBy(*by).orderBy(F.desc("score"), "id")
        found = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    named = F.broadcast(df.sparkSession.createDataFrame(list(enumerate(names)), "item int, item_id long"))  # at most ``query_terms`` rows
    return found.join(named, "item").select("item_id", "rank", F.when(F.col("id") != NO_ID, F.col("id")).alias("doc_id"), "score")
