"""Near-duplicates by bottom-k sketches of one hash function.

1. Each text's shingle set is hashed; its k smallest values are its sketch. Texts with equal sets
   form a class at once, so copies cost one row of a counting aggregation.
2. Inverted lists of the retained values generate the overlaps. A pair at the threshold shares at
   least ``sure`` retained values (``sure_overlap``), so two such classes meet in the list of one
   of the rarest values of each; the other values need no list.
3. All lists led by the same member are one star, so a family of copies that share many values is
   looked at once and not once a value. A large star is cut into blocks and pairs of blocks.
4. Within a block, the sketch of the union estimates each similarity, which filters, and full sets
   verify. Only a spanning forest of the links leaves the block, never its pairs.
5. Components of the links are contracted in rounds, each written to the checkpoint folder.

The chance that a pair at the threshold is missed is below ``MISS`` for sets larger than their
sketch, and zero for others. Nothing is cut off: every list and star is worked through.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripweave.llm.batches import map_slices
from tripweave.llm.shingles import shingle_sets
from tripweave.session import cut

SKETCH = 64
MISS = 1e-9
#: Members of a star that are compared in one block.
BLOCK = 128
#: Large stars whose number of blocks is sent to every task.
BROADCAST_ROWS = 100_000
#: Values of a block's incidence table held at a time.
COLUMNS = 8192


def sure_overlap(k: int, threshold: float, miss: float = MISS) -> int:
    """The most retained values that a pair at the threshold shares but for a chance of ``miss``.

    Each of the k smallest values of the union is in both sets with the similarity's probability.
    """
    below = 0.0
    for s in range(k + 1):
        below += math.comb(k, s) * threshold**s * (1 - threshold) ** (k - s)
        if below > miss:
            return s
    return k


def sketches(df: DataFrame, *, words: int, k: int = SKETCH, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, set_key (equal for equal sets) and sketch for every row."""

    def start():
        def work(ids: list, texts: list[str | None]) -> list[list]:
            sizes, keys, kept = [], [], []
            for s in shingle_sets([(t or "").encode() for t in texts], words):
                sizes.append(len(s))
                keys.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                kept.append(s[:k].view(np.int64).tolist())
            return [ids, sizes, keys, kept]

        return work

    added = [
        T.StructField("doc_id", T.LongType()), T.StructField("n_shingles", T.LongType()),
        T.StructField("set_key", T.BinaryType()), T.StructField("sketch", T.ArrayType(T.LongType())),
    ]
    return map_slices(df.withColumn(doc_id, F.col(doc_id).cast("long")), [doc_id, text], [], added, start)


def _rare_entries(nodes: DataFrame, k: int, percent: int) -> DataFrame:
    """(value, node) for the rarest values of each node that can meet a linked partner."""
    entries = nodes.select("node", F.explode("sketch").alias("value"))
    shared = entries.groupBy("value").agg(F.count("*").alias("holders")).where("holders > 1")
    found = entries.join(shared, "value").join(nodes.select("node", "n_shingles"), "node")
    kept = F.least(F.col("n_shingles"), F.lit(k))
    # a partner's sketch is its full set too if it can have at most k values
    whole = F.col("n_shingles") * 100 <= F.lit(k) * percent
    least = F.when(whole, F.ceil(F.col("n_shingles") * percent / 100)).otherwise(sure_overlap(k, percent / 100))
    per_node = Window.partitionBy("node")
    alone = kept - F.count("*").over(per_node)  # values that no other node holds are rarer still
    place = F.row_number().over(per_node.orderBy("holders", "value"))
    return found.withColumn("place", place + alone).where(F.col("place") <= kept - least + 1).select("value", "node")


def _stars(entries: DataFrame) -> DataFrame:
    """(hub, node): nodes that share a list with the hub that leads it, the hub among them."""
    order = F.struct(F.xxhash64("node").alias("h"), F.col("node").alias("node"))
    led = entries.groupBy("value").agg(F.min(order).alias("first"), F.count("*").alias("n")).where("n > 1")
    return entries.join(led.select("value", F.col("first.node").alias("hub")), "value").select("hub", "node").distinct()


def _blocks(stars: DataFrame) -> DataFrame:
    """(hub, one, two, node): each two members of a star meet in at least one block."""
    large = cut(stars.groupBy("hub").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts")).where("parts > 1"))
    if large.count() <= BROADCAST_ROWS:  # beyond that the stars are shuffled by their hub
        large = F.broadcast(large)
    parts = F.coalesce("parts", F.lit(1))
    own = F.pmod(F.xxhash64("node", "hub"), parts).cast("int")
    dealt = stars.join(large, "hub", "left").withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
    dealt = dealt.where(F.col("parts").isNull() | (F.col("own") != F.col("other")))
    return dealt.select("hub", F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"), "node")


def union_estimates(a: np.ndarray, b: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Share of values in both among the ``sizes`` smallest of each two sketches' union.

    a and b have a sketch in each row, filled up with the largest value.
    """
    both = np.sort(np.concatenate([a, b], axis=1), axis=1)
    again = np.zeros(both.shape, dtype=bool)
    again[:, 1:] = both[:, 1:] == both[:, :-1]
    rank = np.cumsum(~again, axis=1)
    inside = again & (rank <= sizes[:, None]) & (both != np.iinfo(np.uint64).max)
    return inside.sum(axis=1) / np.maximum(sizes, 1)


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """The number of common values of each two sets."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count > 1
    number = np.cumsum(shared) - 1
    use = shared[column]
    owner, column = owner[use], number[column[use]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((len(sets), len(sets)), dtype=np.float32)
    for at in range(0, int(shared.sum()), COLUMNS):
        a, b = np.searchsorted(column, [at, at + COLUMNS])
        table = np.zeros((len(sets), COLUMNS), dtype=np.float32)
        table[owner[a:b], column[a:b] - at] = 1
        out += table @ table.T
    return out


def linked(sets: list[np.ndarray], k: int, percent: int) -> list[tuple[int, int]]:
    """Spanning forest of the links among the sets: (member, first member of its component)."""
    n = len(sets)
    size = np.array([len(s) for s in sets])
    filled = np.full((n, k), np.iinfo(np.uint64).max, dtype=np.uint64)
    for i, s in enumerate(sets):
        filled[i, : min(k, len(s))] = s[:k]
    least = sure_overlap(k, percent / 100) / k
    common = _overlaps([s[:k] for s in sets])
    # a union has at least as many values as its larger set, so its sketch has k or that many
    left, right = np.nonzero(np.triu(common >= np.minimum(least * k, percent / 100 * np.minimum(size, size[:, None])), 1))
    close = np.zeros((n, n), dtype=bool)
    for at in range(0, len(left), 4096):
        i, j = left[at : at + 4096], right[at : at + 4096]
        whole = np.maximum(size[i], size[j]) <= k
        unions = np.where(whole, size[i] + size[j] - common[i, j].astype(np.int64), k)
        passes = union_estimates(filled[i], filled[j], unions) >= np.where(whole, percent / 100 - 1e-9, least)
        close[i[passes], j[passes]] = True
    rows = np.flatnonzero(close.any(0) | close.any(1))
    if not len(rows):
        return []
    exact = _overlaps([sets[i] for i in rows]).astype(np.int64)
    union = size[rows][:, None] + size[rows] - exact
    near = close[np.ix_(rows, rows)] & (100 * exact >= percent * union)
    near |= near.T
    label = np.arange(len(rows))
    while True:
        best = np.minimum(label, np.where(near, label, len(rows)).min(axis=1))
        best = best[best]
        if (best == label).all():
            break
        label = best
    return [(int(rows[i]), int(rows[b])) for i, b in enumerate(label) if i != b]


def _links(members: DataFrame, k: int, percent: int) -> DataFrame:
    """(a, b) links from rows (hub, one, two, node, set), a block at a time in sorted order."""
    block = ["hub", "one", "two"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, nodes, sets, out = None, [], [], []

        def close() -> None:
            if len(nodes) > 1:
                out.extend((nodes[i], nodes[j]) for i, j in linked(sets, k, percent) if nodes[i] != nodes[j])

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in [*block, "node", "set"]]
            for *at, node, values in zip(*columns, strict=True):
                if at != key:
                    close()
                    key, nodes, sets = at, [], []
                nodes.append(node)
                sets.append(np.frombuffer(values, dtype=np.uint64))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.int64()) for x in zip(*out, strict=True)], ["a", "b"])
                out.clear()
        close()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.int64()) for x in zip(*out, strict=True)], ["a", "b"])

    sorted_rows = members.repartition(*block).sortWithinPartitions(*block)
    return sorted_rows.select(*block, "node", "set").mapInArrow(run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node that has a link.

    Each round points every node to its smallest neighbour and contracts the links to those.
    """
    edges = cut(links.where("a <> b").distinct())
    labels = None
    while not edges.isEmpty():
        both = edges.select("a", "b").union(edges.select("b", "a"))
        step = cut(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select(
            "node", F.least("node", "low").alias("to")
        ))
        if labels is None:
            labels = step.select("node", F.col("to").alias("component"))
        else:
            moved = labels.join(step.withColumnRenamed("node", "component"), "component", "left")
            labels = cut(moved.select("node", F.coalesce("to", "component").alias("component")))
        ends = edges.join(step.select(F.col("node").alias("a"), F.col("to").alias("x")), "a").join(
            step.select(F.col("node").alias("b"), F.col("to").alias("y")), "b"
        )
        edges = cut(ends.where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct())
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels


def near_duplicates(
    df: DataFrame, *, words: int = 5, percent: int = 80, k: int = SKETCH, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row, as links of ``percent`` and more give.

    Two texts are linked if 100 * common shingles >= percent * shingles of either. component_id is
    the smallest doc_id reachable, its own included; kept: whether that is its own. Texts without
    words (null, empty, blank) are linked with nothing. A row without doc_id gets no component and
    is kept. Rows that repeat a doc_id with different texts tie those texts together. An empty
    table gives no rows; other columns of ``df`` are not read.
    """
    rows = cut(sketches(df, words=words, k=k, doc_id=doc_id, text=text))
    filled = rows.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = filled.groupBy("set_key").agg(F.min("doc_id").alias("node"))
    nodes = filled.join(classes, "set_key").where("doc_id = node").dropDuplicates(["node", "set_key"])
    # both are read twice, so they are fixed
    stars = cut(_stars(cut(_rare_entries(nodes.select("node", "n_shingles", "sketch"), k, percent))))
    texts = df.select(F.col(doc_id).cast("long").alias("node"), F.col(text).alias("text")).join(
        stars.select("node").distinct(), "node", "left_semi"
    ).dropDuplicates(["node", "text"])
    links = _links(_blocks(stars).join(full_sets(texts, words), "node"), k, percent)
    labels = components(links)
    ids = classes.join(labels, "node", "left").select("set_key", F.coalesce("component", "node").alias("found"))
    component = F.when(F.col("n_shingles") > 0, F.coalesce("found", "doc_id")).otherwise(F.col("doc_id"))
    return rows.select("doc_id", "n_shingles", "set_key").join(ids, "set_key", "left").select(
        "doc_id", "n_shingles", component.alias("component_id")
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def full_sets(texts: DataFrame, words: int) -> DataFrame:
    """node and its whole set, packed, for rows (node, text)."""

    def start():
        def work(values: list[str | None]) -> list[list]:
            return [[s.tobytes() for s in shingle_sets([(t or "").encode() for t in values], words)]]

        return work

    return map_slices(texts, ["text"], ["node"], [T.StructField("set", T.BinaryType())], start)
