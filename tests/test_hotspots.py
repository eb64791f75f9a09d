from dataclasses import replace

import numpy as np
import pandas as pd
import pytest

from pyspark.sql import functions as F

from tripweave.operators import hotspots as H
from tripweave.operators.components import connected_components
from tripweave.params import DEFAULTS

P = replace(DEFAULTS, min_points=5)


def brute_force(ids, xy, eps, min_points):
    """Sequential definition: visit points in id order."""
    order = np.argsort(ids)
    near = np.sqrt(((xy[:, None] - xy[None]) ** 2).sum(-1)) <= eps
    core = near.sum(1) >= min_points
    label, cluster = np.full(len(ids), -1), 0
    for i in order:
        if not core[i] or label[i] >= 0:
            continue
        stack = [i]
        while stack:
            j = stack.pop()
            if label[j] >= 0:
                continue
            label[j] = cluster
            if core[j]:
                stack.extend(np.flatnonzero(near[j] & (label < 0)))
        cluster += 1
    return label


def metres(points):
    return points * np.array([DEFAULTS.metres_lng, DEFAULTS.metres_lat])


def check(spark, points, p, seed=0):
    ids = np.random.default_rng(seed).permutation(len(points))
    df = spark.createDataFrame(pd.DataFrame({"kind": "start", "id": ids, "lng": points[:, 0], "lat": points[:, 1]}))
    got = {r.id: r.cluster_id for r in H.cluster_points(df, p).collect()}
    want = dict(zip(ids.tolist(), brute_force(ids, metres(points), p.eps_m, p.min_points).tolist()))
    assert got == want
    return want


@pytest.fixture(scope="module")
def field():
    """Blobs, chains, duplicates and scattered points."""
    rng = np.random.default_rng(11)
    m = 1 / np.array([DEFAULTS.metres_lng, DEFAULTS.metres_lat])
    base = np.array([113.6, 22.45])
    parts = [base + rng.uniform(0, 30_000, (150, 2)) * m]
    for _ in range(12):
        parts.append(base + rng.uniform(0, 30_000, 2) * m + rng.normal(0, rng.uniform(60, 500), (rng.integers(4, 40), 2)) * m)
    line = np.linspace(0, 6_000, 60)
    parts.append(base + (np.c_[line, 2_000 + 400 * np.sin(line / 900)] + 31_000) * m)
    parts.append(np.repeat(base[None] + 33_000 * m, 7, axis=0))
    return np.concatenate(parts)


def test_equals_brute_force(spark, field):
    labels = check(spark, field, P)
    assert len(set(labels.values())) > 6 and -1 in labels.values()


def test_equals_brute_force_with_salted_cells(spark, field):
    check(spark, field, replace(P, max_rows_per_task=3, max_broadcast_rows=0), seed=4)


def test_border_point_takes_the_lowest_cluster(spark):
    m = 1 / np.array([DEFAULTS.metres_lng, DEFAULTS.metres_lat])
    left, right = np.zeros((5, 2)), np.array([[1000.0, 0.0]] * 5)
    points = np.array([114.0, 22.6]) + np.concatenate([left, right, [[500.0, 0.0]]]) * m
    for seed in range(3):
        labels = check(spark, points, replace(P, min_points=6), seed)
        assert set(labels.values()) == {0, 1} or set(labels.values()) == {0}


def test_open_pairs_are_refined(spark):
    """Cells whose closest core sites are not extreme ones: only refinement links them."""
    eps, side = P.eps_m, P.eps_m / 1.4143
    x0, y0 = 32_000 * side, 6_900 * side
    left = np.array([[x0 + 0.02 * side, y0 + 0.30 * side], [x0 + 0.02 * side, y0 + 0.70 * side], [x0 + 0.25 * side, y0 + 0.95 * side],
                     [x0 + 0.25 * side, y0 + 0.05 * side], [x0 + 0.26 * side, y0 + 0.02 * side], [x0 + 0.255 * side, y0 + 0.5 * side]])
    reach = left[5, 0] + eps - 0.5
    right = np.array([[reach, y0 + 0.5 * side], [reach + 0.001, y0 + 0.98 * side], [reach + 0.001, y0 + 0.01 * side],
                      [reach - 0.2, y0 + 0.985 * side], [reach + 60, y0 + 0.99 * side], [reach + 60, y0 + 0.005 * side]])
    points = np.concatenate([left, right]) / np.array([DEFAULTS.metres_lng, DEFAULTS.metres_lat])
    asked = []
    refine = H._refine
    H._refine = lambda *a: asked.append(1) or refine(*a)
    try:
        labels = check(spark, points, P)
    finally:
        H._refine = refine
    assert asked and set(labels.values()) == {0}


def test_both_kinds_are_clustered_apart(spark, field):
    """The same field under both kinds, ends in reverse id order: no cluster mixes them."""
    n = len(field)
    half = lambda kind, ids: pd.DataFrame({"kind": kind, "id": ids, "lng": field[:, 0], "lat": field[:, 1]})
    df = spark.createDataFrame(pd.concat([half("start", range(n)), half("end", range(n - 1, -1, -1))]))
    got = {(r.kind, r.id): r.cluster_id for r in H.cluster_points(df, P).collect()}
    for kind, ids in (("start", np.arange(n)), ("end", np.arange(n - 1, -1, -1))):
        want = brute_force(ids, metres(field), P.eps_m, P.min_points)
        assert [got[kind, int(i)] for i in ids] == want.tolist()


def test_kinds_of_any_name_do_not_mix(spark):
    """Twelve points of two kinds at one place: too few of either, and as many rows as before."""
    rows = [(kind, i, 114.0 + i * 1e-5, 22.5) for kind in ("a", "b") for i in range(12)]
    got = H.cluster_points(spark.createDataFrame(rows, "kind string, id long, lng double, lat double")).collect()
    assert len(got) == 24 and {r.cluster_id for r in got} == {-1}
    with pytest.raises(ValueError, match="kinds"):
        many = [(f"k{i}", i, 114.0, 22.5) for i in range(20)]
        H.cluster_points(spark.createDataFrame(many, "kind string, id long, lng double, lat double"))


def test_nothing_dense(spark, trips_of):
    trips = trips_of([(1, 0, 60, 1.0, 1.0, 60.0)])
    found = H.find_hotspots(trips)
    assert found.count() == 0
    assert found.columns == ["point_type", "cluster_id", "center_lng", "center_lat", "trip_count", "radius_m", "radius_true_m"]


def test_components_on_random_graphs(spark):
    rng = np.random.default_rng(2)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(i, i + 1) for i in range(1000, 1100)]
    parent = {n: n for e in edges for n in e}

    def top(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        a, b = sorted((top(a), top(b)))
        parent[b] = a
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    linked = {n for a, b in edges if a != b for n in (a, b)}
    assert got == {n: top(n) for n in linked}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_full_cells_are_counted_by_boxes(spark, field):
    check(spark, field, replace(P, max_listed_sites=2, max_broadcast_rows=0), seed=6)


def test_a_full_cell_costs_boxes_and_not_sites(spark, monkeypatch):
    """Thin sites on a ring around a cell of 20,000 sites, some within eps of few of them."""
    rng, p = np.random.default_rng(2), replace(DEFAULTS, min_points=40)
    m = 1 / np.array([DEFAULTS.metres_lng, DEFAULTS.metres_lat])
    side = p.eps_m / 1.4143
    corner = np.array([32_000, 6_800]) * side + 1.0  # the lower left corner of a cell
    inside = corner + rng.uniform(0, side - 2, (20_000, 2))
    angle = rng.uniform(0, 2 * np.pi, 25)
    ring = corner + side / 2 + np.c_[np.cos(angle), np.sin(angle)] * rng.uniform(620, 760, 25)[:, None]
    frame = lambda xy, first: pd.DataFrame({"kind": "start", "id": np.arange(len(xy)) + first, "lng": xy[:, 0] * m[0], "lat": xy[:, 1] * m[1]})
    df = spark.createDataFrame(pd.concat([frame(inside, 0), frame(ring, 20_000)]))
    tested, whole = [], H.cut
    monkeypatch.setattr(H, "cut", lambda d: (lambda out: tested.append(out.count()) or out if "inside" in d.columns else out)(whole(d)))
    got = {r.id: r.core for r in H.label_sites(df, p).select(F.col("first_id").alias("id"), "core").collect() if r.id >= 20_000}
    points = np.concatenate([inside, ring])
    want = {20_000 + i: bool((np.sqrt(((points - q) ** 2).sum(1)) <= p.eps_m).sum() >= p.min_points) for i, q in enumerate(ring)}
    assert got == want and len(set(want.values())) == 2
    hits = sum(int((np.sqrt(((inside - q) ** 2).sum(1)) <= p.eps_m).sum()) for q in ring)
    assert sum(tested) < hits / 3
