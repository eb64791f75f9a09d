"""Vector searches against brute force."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import SF
from tripweave.llm import lsh_forest, mtree_topk, queries, vector_blocks

VECTORS = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())), T.StructField("rank", T.StringType()),
    T.StructField("id", T.StringType()), T.StructField("dim", T.StringType()),
])


def _of(spark, rows):
    return spark.createDataFrame([(i, v, "x", "y", "z") for i, v in rows], VECTORS)


def _brute(rows, score, k=5):
    out = set()
    for q, v in rows:
        if q % 50 == 0:
            found = sorted((-score(v, w), i) for i, w in rows if i != q and len(w) == len(v))[:k]
            out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(found)}
    return out


def _cosine(a, b):
    a, b = np.array(a), np.array(b)
    return float((b * a).sum() / (np.linalg.norm(b) * np.linalg.norm(a)))


def _product(a, b):
    return sum(int(np.floor(x * 256)) * int(np.floor(y * 256)) for x, y in zip(a, b, strict=True))


def _odd(seed):
    rng = np.random.default_rng(seed)
    rows = [(i, rng.normal(size=8).round(1).tolist()) for i in range(400)]
    rows += [(400 + i, rows[50][1]) for i in range(30)]  # ties
    rows += [(1000 + i, rng.normal(size=3).tolist()) for i in range(4)]  # fewer than k of this length
    return rows


BAD = [(None, [1.0] * 8), (2000, None), (2050, [1.0] * 7 + [None]), (2100, [float("nan")] * 8), (2150, [float("inf")] + [1.0] * 7), (2200, [])]


def test_forest_finds_ties_and_leaves_bad_vectors(spark):
    rows = _odd(1)
    df = _of(spark, rows + BAD + [(2250, [0.0] * 8)])
    got = {tuple(r) for r in lsh_forest.nearest(df, F.col("id") % 50 == 0).collect()}
    expected = _brute(rows, _cosine)
    assert len(got) == len(expected)
    near = {(q, n): (i, s) for q, n, i, s in got}
    right = sum(near[q, n][0] == i for q, n, i, _ in expected)
    assert right >= 0.9 * len(expected)
    for n in range(1, 6):  # copies of the query's vector: the smallest ids
        assert near[50, n] == (399 + n, near[50, 1][1])
    assert near[1000, 3][0] in (1001, 1002, 1003) and (1000, 4) not in near
    assert lsh_forest.nearest(df.limit(0), F.col("id") % 50 == 0).count() == 0


def test_forest_recall(spark):
    sf = SF.replace("sf0.001", "sf0.1")
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    x = np.array([v for _, v in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    ids = np.array([i for i, _ in rows])
    got = {}
    for r in queries.op3_nearest(spark, sf).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = total = 0
    for q in np.flatnonzero(ids % 50 == 0):
        s = x @ x[q]
        s[q] = -9
        best = set(ids[np.argsort(-s)[:5]].tolist())
        hits, total = hits + len(best & got[ids[q]]), total + 5
    assert hits >= 0.9 * total


def test_needed_length():
    assert lsh_forest.needed_length(1.0, 64, 32, 0.04) == 32
    assert lsh_forest.needed_length(-1.0, 64, 32, 0.04) == 0
    lengths = [lsh_forest.needed_length(c, 64, 32, 0.04) for c in (0.0, 0.4, 0.8, 0.99)]
    assert lengths == sorted(lengths)


def test_tree_is_exact(spark):
    for seed in (2, 3):
        rows = _odd(seed)
        df = _of(spark, rows + BAD)
        got = {tuple(r) for r in mtree_topk.largest(df, F.col("id") % 50 == 0).collect()}
        assert got == _brute(rows, _product)
    assert mtree_topk.largest(df.limit(0), F.col("id") % 50 == 0).count() == 0


def test_tree_pages_hold_their_rows():
    rng = np.random.default_rng(4)
    v = np.floor(rng.normal(size=(3000, 6)) * 100).astype(np.int64)
    tree = mtree_topk.build(np.arange(3000), v)
    assert sorted(tree["ids"].tolist()) == list(range(3000)) and (~tree["leaf"]).any()
    queries_ = v[:40]
    for q, ids, scores in mtree_topk.find(tree, np.arange(40), queries_, 5):
        s = v @ v[q]
        s[q] = -(10**15)
        assert ids.tolist() == np.lexsort((np.arange(3000), -s))[:5].tolist() and scores.tolist() == s[ids].tolist()


def test_large_components_stay_exact():
    v = np.array([[1 << 30, 3], [1 << 30, 4], [-5, 2]], dtype=np.int64)
    tree = mtree_topk.build(np.array([1, 2, 3]), v)
    _, ids, scores = next(iter(mtree_topk.find(tree, np.array([3]), v[2:], 2)))
    assert sorted(zip(ids.tolist(), scores.tolist())) == [(1, -5 * (1 << 30) + 6), (2, -5 * (1 << 30) + 8)]


def test_extreme_finite_vectors_have_defined_scores(spark):
    big = [(0, [1e200, 1e200]), (1, [1e-200, 1e-200]), (2, [1e200, -1e200]), (3, [5e-324, 0.0]), (50, [1e308, 1e308]), (51, [1e30, 1.0]), (52, [-1e30, 0.5])]
    df = _of(spark, big)
    near = lsh_forest.nearest(df, F.col("id") % 50 == 0).collect()
    assert len(near) == 10 and all(np.isfinite(r.score) and abs(r.score) <= 1 + 1e-12 for r in near)
    first = {r.query_id: r for r in near if r["rank"] == 1}
    assert first[0].vec_id == 1 and first[50].vec_id == 0 and abs(first[0].score - 1) < 1e-12
    top = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in mtree_topk.largest(df, F.col("id") % 50 == 0, 6).collect()}
    most = (1 << 63) - 1
    as_long = lambda x: int(max(-(1 << 63), min(most, int(np.floor(x * 256)) if np.isfinite(x * 256) else most)))
    for q in (0, 50):
        score = lambda w: max(-(1 << 63), min(most, sum(as_long(a) * as_long(b) for a, b in zip(dict(big)[q], w))))
        expected = sorted((-score(w), i) for i, w in big if i != q)
        assert [top[q, n + 1] for n in range(6)] == [(i, -s) for s, i in expected]


def test_an_id_that_most_rows_share_spreads_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(vector_blocks, "BLOCK_ROWS", 50)
    rng = np.random.default_rng(6)
    rows = [(7, v) for v in rng.normal(size=(400, 4)).round(2).tolist()] + [(50 * i, rng.normal(size=4).round(2).tolist()) for i in range(5)]
    sizes = []
    made = vector_blocks._packed
    monkeypatch.setattr(vector_blocks, "_packed", lambda r, *a: sizes.append(r.groupBy("dim", "block").count()) or made(r, *a))
    got = [tuple(r) for r in mtree_topk.largest(_of(spark, rows), F.col("id") % 50 == 0).collect()]
    assert max(r["count"] for r in sizes[0].collect()) < 120
    for q, v in rows[400:]:
        best = sorted((-_product(v, w), i) for i, w in rows if i != q)[:5]
        assert sorted(r[1:] for r in got if r[0] == q) == [(n + 1, i, -s) for n, (s, i) in enumerate(best)]
