"""Approximate nearest neighbours by a hash-prefix forest.

Each tree is a sorted array of long strings of bits, the sides of random hyperplanes on which a
row lies. A query descends each tree to its longest matching prefixes and then ascends in all
trees at once, a bit shorter each time, which takes in more candidates. It stops once a row as
near as the k-th best so far would share a prefix of this length in some tree but for a chance
of ``miss``: near rows are settled by long prefixes, and far ones only by short ones. The length
0 takes in every row, so small blocks are searched whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.llm import vector_blocks

TREES, BITS, SEED = 64, 32, 20_24
#: Chance that a row nearer than the k-th best is in no candidate set.
MISS = 0.04
#: Candidates before the first stop is tried.
FIRST = 32


def _codes(vectors: np.ndarray, trees: int, bits: int) -> np.ndarray:
    """The hash strings as integers, a row for each tree."""
    planes = np.random.default_rng(SEED).standard_normal((trees * bits, vectors.shape[1]))
    sides = (vectors @ planes.T > 0).reshape(len(vectors), trees, bits)
    weights = np.uint64(1) << np.arange(bits - 1, -1, -1, dtype=np.uint64)
    return (sides * weights).sum(axis=2, dtype=np.uint64).T


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Each vector times the power of two that brings its largest component to 0.5 to 1, which changes no digit of a cosine."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1, keepdims=True))[1])


def build(ids: np.ndarray, vectors: np.ndarray, trees: int = TREES, bits: int = BITS) -> dict[str, np.ndarray]:
    vectors = scaled(vectors)
    codes = _codes(vectors / np.linalg.norm(vectors, axis=1, keepdims=True), trees, bits)
    order = np.argsort(codes, axis=1, kind="stable").astype(np.int32)
    return {"ids": ids, "vectors": vectors, "codes": np.take_along_axis(codes, order, axis=1).astype(np.uint32), "order": order}


def needed_length(cosine: float, trees: int, bits: int, miss: float) -> int:
    """The longest prefix that a row of this cosine shares in some tree but for a chance of ``miss``."""
    same = 1 - math.acos(max(-1.0, min(1.0, cosine))) / math.pi
    in_one = 1 - miss ** (1 / trees)
    if same >= 1:
        return bits
    return int(min(bits, math.log(in_one) / math.log(same))) if same > 0 else 0


def find(
    block: dict[str, np.ndarray], query_ids: np.ndarray, queries: np.ndarray, k: int, miss: float = MISS
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    ids, vectors, codes, order = (block[x] for x in ("ids", "vectors", "codes", "order"))
    trees, n, bits = len(codes), len(ids), BITS
    queries = scaled(queries)
    lengths = np.linalg.norm(vectors, axis=1)
    unit = vectors / lengths[:, None]
    own = _codes(queries / np.linalg.norm(queries, axis=1, keepdims=True), trees, bits)
    # borders of the rows that share the first x bits with the query, for every tree and x
    low, high = (np.empty((bits + 1, trees, len(queries)), dtype=np.int32) for _ in range(2))
    for x in range(bits + 1):
        rest = np.uint64((1 << (bits - x)) - 1)
        for t in range(trees):
            low[x, t] = np.searchsorted(codes[t], (own[t] & ~rest).astype(np.uint32), "left")
            high[x, t] = np.searchsorted(codes[t], (own[t] | rest).astype(np.uint32), "right")
    reached = (high - low).sum(axis=1)
    for i, (query_id, query) in enumerate(zip(query_ids.tolist(), queries, strict=True)):
        seen = ids == query_id
        best_ids, best = np.empty(0, dtype=np.int64), np.empty(0)
        size = float(np.linalg.norm(query))
        x = int(np.flatnonzero(reached[:, i] >= FIRST)[-1]) if reached[0, i] >= FIRST else 0
        while True:
            now = np.zeros(n, dtype=bool)
            for t in range(trees):
                now[order[t, low[x, t, i]:high[x, t, i]]] = True
            new = np.flatnonzero(now & ~seen)
            seen |= now
            if len(best) >= k:  # rows that are surely worse need no score to the last bit
                new = new[unit[new] @ (query / size) >= best[-1] - 1e-9]
            scores = (vectors[new] * query).sum(axis=1) / (lengths[new] * size)
            best_ids, best = np.concatenate([best_ids, ids[new]]), np.concatenate([best, scores])
            keep = vector_blocks.top(best_ids, best, k)
            best_ids, best = best_ids[keep], best[keep]
            if x == 0 or len(best) >= k and x <= needed_length(best[-1], trees, bits, miss):
                break
            x -= 1
        yield query_id, best_ids, best


def nearest(df: DataFrame, is_query, k: int = 5, *, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score (cosine): the k nearest rows found for each row of ``is_query``.

    Rows without id or vector, with a zero vector or one that holds null or non-finite components
    take no part, nor do vectors of other lengths than the query's. Vectors are scaled by a power of
    two first, so very large and very small components give finite scores. Equal vectors share all their
    prefixes, so ties are found together and go to the smaller id. Repeated ids are candidates
    each, and one query. An empty table gives no rows. Other columns are not read.
    """
    rows = df.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector")).where(
        F.col("id").isNotNull() & vector_blocks.finite("vector")
    ).where(F.exists("vector", lambda x: x != 0)).withColumn("dim", F.size("vector"))
    return vector_blocks.search(rows, is_query, k, kind="float64", score_type="double", index=build, find=find)
