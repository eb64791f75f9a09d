import pytest
from pyspark.sql import functions as F

from tripweave.functions.geo import cell_lat, cell_lng, equirect_km, grid_center, haversine_km
from tripweave.operators import spatial
from tripweave.operators.trips import trips_from_pings
from tripweave.params import DEFAULTS
from tripweave.sources.events_view import read_events_view

from .conftest import SF


@pytest.fixture(scope="module")
def valid(spark):
    return trips_from_pings(read_events_view(spark, SF)).persist()


def test_grid(spark):
    assert (DEFAULTS.n_lng, DEFAULTS.n_lat, DEFAULTS.n_cells) == (101, 56, 5656)
    rows = [(113.5, 22.4), (114.5, 22.9), (113.0, 22.0), (120.0, 30.0), (113.519, 22.4185), (None, 22.5)]
    df = spark.createDataFrame(rows, "lng double, lat double")
    got = [tuple(r) for r in df.select(cell_lng(F.col("lng")), cell_lat(F.col("lat"))).collect()]
    assert got == [(0, 0), (100, 55), (0, 0), (100, 55), (1, 2), (None, 11)]
    c = spark.range(1).select(*grid_center(F.lit(3320).cast("long"))).first()
    assert (round(c[0], 6), round(c[1], 6)) == (114.095, 22.5485)


def test_distances(spark):
    df = spark.createDataFrame([(114.0, 22.5, 114.1, 22.6), (None, 22.5, 114.1, 22.6)], "a double, b double, c double, d double")
    cols = [F.col(c) for c in "abcd"]
    h, e = (r for r in df.select(haversine_km(*cols), equirect_km(*cols)).first())
    assert h == pytest.approx(15.132, abs=0.02) and e == pytest.approx(h, rel=1e-4)
    assert df.select(haversine_km(*cols)).collect()[1][0] is None


def test_opposite_flows(spark):
    a, b, c, d = 10, 200, 31, 77
    pairs = spark.createDataFrame([(a, b, 19), (b, a, 15), (c, d, 7), (d, c, 7), (a, c, 2), (a, a, 50)], "o long, d long, flow long")
    for first in (False, True):
        edges = spatial.flow_edges(pairs, before_topk=first)
        assert sorted((r.o, r.d, r.value) for r in edges.collect()) == [(a, c, 2), (a, b, 4)]
        assert spatial.flow_nodes(edges).count() == 3


def test_top_pairs_break_ties_by_cell(spark):
    pairs = spark.createDataFrame([(5, 1, 3), (2, 9, 3), (2, 4, 3), (1, 1, 99)], "o long, d long, flow long")
    assert [(r.o, r.d) for r in spatial.top_od_pairs(pairs, 2).collect()] == [(2, 4), (2, 9)]


def test_sums(valid):
    n = valid.count()
    od = spatial.od_matrix(valid)
    assert od.agg(F.sum("flow")).first()[0] == n
    flows = spatial.net_flow(valid)
    assert tuple(flows.agg(F.sum("net_flow"), F.sum("outflow")).first()) == (0, n)
    dense = spatial.net_flow(valid, dense=True)
    assert dense.count() == 5656 and dense.agg(F.sum("inflow")).first()[0] == n
    assert spatial.density(valid, "both").agg(F.sum("n")).first()[0] == 2 * n
    assert spatial.od_summary(od).first().trips == n


def test_heat_is_capped(valid):
    rows = spatial.heat_points(valid, n=5, cap=2).collect()
    assert len(rows) == 5 and all(r.intensity == min(r["count"], 2) for r in rows)
    assert [r["count"] for r in rows] == sorted((r["count"] for r in rows), reverse=True)


def test_extremes(valid):
    rows = spatial.net_flow_extremes(spatial.net_flow(valid), 4).collect()
    assert [(r.direction, r.order_no) for r in rows] == [("in", i) for i in range(1, 5)] + [("out", i) for i in range(1, 5)]
    assert all(r.value == abs(r.net_flow) for r in rows)


def test_empty(valid):
    none = valid.limit(0)
    od = spatial.od_matrix(none)
    assert spatial.od_summary(od).first().intra_pct is None
    assert spatial.flow_edges(od).count() == 0 and spatial.net_flow(none).count() == 0
