"""The board kept by partial states, and clusters that grow, against a fresh build."""

from __future__ import annotations

import random
from dataclasses import replace

from pyspark.sql import functions as F

from tripweave.operators import hotspots
from tripweave.operators.trips import trips_from_pings
from tripweave.params import DEFAULTS
from tripweave.plans import board
from tripweave.sources import sinks
from tripweave.sources.events_view import read_events_view
from tripweave.streaming import clusters, delta, live

from .conftest import SF

def _facts(cache):
    """Every figure of the board, rounded."""
    one = board.read_dashboard(cache).first().asDict(recursive=True)

    def plain(x):
        if isinstance(x, dict):
            return tuple((k, plain(v)) for k, v in sorted(x.items()))
        if isinstance(x, list):
            return tuple(plain(v) for v in x)
        return round(x, 9) if isinstance(x, float) else x

    return plain(one)


def test_board_of_merged_states_equals_a_fresh_one_after_replays(spark, tmp_path):
    trips = trips_from_pings(read_events_view(spark, SF)).persist()
    source, target = str(tmp_path / "trips"), str(tmp_path / "board")
    for i in range(3):
        part = trips.where(F.col("hour") % 3 == i)
        for _ in range(2 if i == 1 else 1):
            sinks.publish({"trips": part}, source, i)
            delta.refresh(spark, source, target, i, ranking=False)
        so_far = trips.where(F.col("hour") % 3 <= i)
        assert _facts(live.board(spark, target)) == _facts(board.cache_rows(so_far, None))
    state = sinks.read_published(spark, target, "counts")
    assert state.count() < 2 * 24 + 5 + trips.count() and sinks.read_published(spark, target, "vehicles").count() <= 2
    sinks.publish({"trips": trips.limit(0)}, source, 3)
    delta.refresh(spark, source, target, 3, ranking=False)
    assert _facts(live.board(spark, target)) == _facts(board.cache_rows(trips, None))


def test_an_empty_first_batch_gives_an_empty_board(spark, tmp_path):
    trips = trips_from_pings(read_events_view(spark, SF)).limit(0)
    source, target = str(tmp_path / "trips"), str(tmp_path / "board")
    sinks.publish({"trips": trips}, source, 0)
    delta.refresh(spark, source, target, 0)
    row = board.read_dashboard(live.board(spark, target)).first()
    assert row.kpis.total_trips == 0 and sum(h.trips for h in row.hourly) == 0 and not row.ranking


def test_grown_clusters_equal_fresh_ones(spark, tmp_path):
    """Dense spots, bridges that join them later, lone points and repeats, in batches; one batch is replayed."""
    p, rnd = replace(DEFAULTS, min_points=6), random.Random(8)
    spot = lambda x, y, n, r: [(x + rnd.uniform(-r, r), y + rnd.uniform(-r, r)) for _ in range(n)]
    batches = [
        spot(114.0, 22.6, 40, 0.006) + spot(114.03, 22.6, 30, 0.004) + spot(114.1, 22.7, 5, 0.002) + spot(114.1, 22.6, 60, 0.08),
        spot(114.015, 22.6, 40, 0.009) + spot(114.1, 22.7, 4, 0.002) + spot(114.2, 22.5, 30, 0.003) + spot(114.1, 22.6, 40, 0.08),
        spot(114.2, 22.51, 40, 0.006) + spot(114.1, 22.6, 120, 0.08),
    ]
    batches[1] += batches[0][:15]
    points, before, made = [], None, 0
    for i, batch in enumerate(batches):
        fresh = [(made + k, x, y) for k, (x, y) in enumerate(batch)]
        made += len(batch)
        points += fresh
        df = spark.createDataFrame(fresh, "id long, lng double, lat double")
        for _ in range(2 if i == 1 else 1):
            sinks.publish(clusters.grown(spark, before, df, p), str(tmp_path / "s"), i)
        before = sinks.version_path(spark, str(tmp_path / "s"), i)
        state = {name: spark.read.parquet(f"{before}/{name}") for name in ("sites", "regions", "cells", "borders")}
        got = sorted((r.cluster_id, r.trip_count, round(r.center_lng, 9), round(r.center_lat, 9)) for r in clusters.summary(state).collect())
        whole = spark.createDataFrame(points, "id long, lng double, lat double").withColumn("kind", F.lit("start"))
        want = hotspots.cluster_summary(hotspots.label_sites(whole, p), p)
        assert got == sorted((r.cluster_id, r.trip_count, round(r.center_lng, 9), round(r.center_lat, 9)) for r in want.collect())
        assert len(got) > 1


def test_the_whole_board_is_counted_in_one_pass(spark, trips_of, tmp_path):
    """Borders of hours and periods, several cells, no vehicle, no trips: the rows of the batch board."""
    seconds = [0, 3599, 3600, 25199, 25200, 32399, 32400, 61199, 61200, 68399, 68400, 86339, 86340, 86399]
    trips = trips_of([(None if i % 5 == 4 else i % 3, s, s + 60 * i, 1.0 + i, 0.3 + i, 10.0 + i) for i, s in enumerate(seconds)])
    trips.withColumn("s_lng", F.lit(113.49) + F.col("trip_id") % 7 * 0.0131).write.parquet(str(tmp_path / "t"))
    trips = spark.read.parquet(str(tmp_path / "t"))
    for some in (trips, trips.where("vehicle_id = 1"), trips.where("trip_id < 0")):
        assert _facts(board.rows_of_figures(board.board_figures(some))) == _facts(board.cache_rows(some, None))
    assert board.board_figures(trips)._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    sinks.publish({"trips": trips}, str(tmp_path / "trips"), 0)
    live.refresh_whole_board(spark, str(tmp_path / "trips"), str(tmp_path / "board"), 0)
    assert _facts(live.board(spark, str(tmp_path / "board"))) == _facts(board.cache_rows(trips, None))
