"""Exact top-k inner products by best-first search in M-trees.

An inner product becomes a distance by one more component: with it every row of a block has the
length of its longest row, so the largest product is the smallest distance. Pages are metric
nodes: a routing object with its covering radius and its distance to the parent's routing object,
leaves with their rows and each row's distance to the leaf's routing object. The page with the
smallest possible distance is opened first; stored distances rule out entries and rows by the
triangle inequality before anything is computed. Bounds are compared with a margin for rounding
and scores are integers, so the result is exact.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.llm import vector_blocks

#: Entries of an inner page, and rows of a leaf.
FANOUT, LEAF_ROWS = 16, 128
SEED = 7
#: Share of a distance's scale by which a bound must exceed it.
MARGIN = 1e-7
#: Products beyond 64 bits count as these.
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1


def _distances(points: np.ndarray, one: np.ndarray) -> np.ndarray:
    return np.sqrt(((points - one) ** 2).sum(axis=1))


def build(ids: np.ndarray, vectors: np.ndarray) -> dict[str, np.ndarray]:
    """Pages by recursive assignment of rows to the nearest of ``FANOUT`` routing objects.

    Rows are put in the order of their leaves. A page has its routing object, radius, distance to
    the parent's routing object, and children first..last (or rows first..last for a leaf).
    """
    real = vectors.astype(float)
    square = (real**2).sum(axis=1)
    longest = float(square.max())
    points = np.column_stack([real, np.sqrt(np.maximum(longest - square, 0.0))])
    rng = np.random.default_rng(SEED)
    pages: list[list] = []  # routing object, radius, parent distance, leaf, first, last
    order: list[np.ndarray] = []
    to_leaf = np.zeros(len(ids))
    placed = 0
    queue = [(np.arange(len(ids)), points.mean(axis=0), 0.0)]
    while queue:  # breadth first, so children of a page lie together
        rows, centre, parent = queue.pop(0)
        far = _distances(points[rows], centre)
        page = [centre, float(far.max()), parent, True, placed, placed + len(rows)]
        split = None
        if len(rows) > LEAF_ROWS:
            parts = min(FANOUT, -(-2 * len(rows) // LEAF_ROWS))
            seeds = points[rng.choice(rows, parts, replace=False)]
            near = np.argmin((seeds**2).sum(axis=1) - 2 * points[rows] @ seeds.T, axis=1)
            split = [rows[near == j] for j in range(parts) if (near == j).any()]
        if split and len(split) > 1:
            first = len(pages) + len(queue) + 1
            page[3:] = [False, first, first + len(split)]
            for part in split:
                middle = points[part].mean(axis=0)
                queue.append((part, middle, float(np.sqrt(((middle - centre) ** 2).sum()))))
        else:  # small enough, or copies that no routing object parts
            order.append(rows)
            to_leaf[placed:placed + len(rows)] = far
            placed += len(rows)
        pages.append(page)
    rows = np.concatenate(order)
    return {
        "ids": ids[rows], "vectors": vectors[rows], "to_leaf": to_leaf, "longest": np.array([longest]),
        "centre": np.array([p[0] for p in pages]), "radius": np.array([p[1] for p in pages]),
        "parent": np.array([p[2] for p in pages]), "leaf": np.array([p[3] for p in pages]),
        "first": np.array([p[4] for p in pages]), "last": np.array([p[5] for p in pages]),
    }


def _exact(vectors: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as floats if these hold every product's terms and sums exactly, else as Python's integers."""
    largest = lambda x: max(int(x.max(initial=0)), -int(x.min(initial=0)))
    most = largest(vectors) * largest(queries) * vectors.shape[1]
    kind = float if most < 1 << 53 else object
    return vectors.astype(kind), queries.astype(kind)


def find(
    block: dict[str, np.ndarray], query_ids: np.ndarray, queries: np.ndarray, k: int
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    ids, vectors, to_leaf, centre, radius, parent, leaf, first, last = (
        block[x] for x in ("ids", "vectors", "to_leaf", "centre", "radius", "parent", "leaf", "first", "last")
    )
    longest = float(block["longest"][0])
    vectors, queries = _exact(vectors, queries)
    for query_id, query in zip(query_ids.tolist(), queries, strict=True):
        point = np.append(query.astype(float), 0.0)
        square = float((point**2).sum())
        margin = MARGIN * (1 + np.sqrt(square + longest))
        best_ids, best = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        reach = np.inf  # distance of the k-th best
        to_root = float(_distances(centre[:1], point)[0])
        heap = [(max(0.0, to_root - float(radius[0])), 0, to_root)]
        while heap:
            bound, page, distance = heapq.heappop(heap)
            if bound > reach + margin:
                break
            a, b = int(first[page]), int(last[page])
            if leaf[page]:
                some = np.flatnonzero(np.abs(distance - to_leaf[a:b]) <= reach + margin) + a
                some = some[ids[some] != query_id]
                if len(some):
                    scores = np.clip(vectors[some] @ query, LOWEST, HIGHEST).astype(np.int64)
                    if len(best) >= k:  # others can be no better than the k-th
                        some, scores = some[scores >= best[-1]], scores[scores >= best[-1]]
                    best_ids, best = np.concatenate([best_ids, ids[some]]), np.concatenate([best, scores])
                    keep = vector_blocks.top(best_ids, best, k)
                    best_ids, best = best_ids[keep], best[keep]
                    if len(best) >= k and best[-1] > LOWEST:
                        reach = np.sqrt(max(0.0, square + longest - 2.0 * float(best[-1])))
            else:
                some = np.flatnonzero(np.abs(distance - parent[a:b]) - radius[a:b] <= reach + margin) + a
                to_child = _distances(centre[some], point)
                for child, far in zip(some.tolist(), to_child.tolist(), strict=True):
                    nearest = max(0.0, far - float(radius[child]))
                    if nearest <= reach + margin:
                        heapq.heappush(heap, (nearest, child, far))
        yield query_id, best_ids, best


def largest(df: DataFrame, is_query, k: int = 5, *, scale: int = 256, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k rows of largest product of vectors floor(scale * x).

    Rows without id or vector, or whose vector holds null or non-finite components, take no part,
    nor do vectors of other lengths than the query's and those without components. Ties go to the
    smaller id. Repeated ids are candidates each, and one query. An empty table gives no rows;
    other columns are not read. Components and products beyond 64 bits count as the nearest 64-bit
    number; such products are equal and tie by id.
    """
    rows = df.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector")).where(
        F.col("id").isNotNull() & vector_blocks.finite("vector") & (F.size("vector") > 0)
    ).select(
        "id", F.transform("vector", lambda x: F.floor(x * float(scale)).cast("long")).alias("vector"), F.size("vector").alias("dim")
    )
    return vector_blocks.search(rows, is_query, k, kind="int64", score_type="long", index=build, find=find)
