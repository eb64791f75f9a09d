import math
import random

import numpy as np
import pandas as pd
import pytest

from tripweave.functions.stats import exact_percentiles
from tripweave.operators import quality, sample, temporal
from tripweave.operators.trips import trips_from_pings
from tripweave.sources.events_view import read_events_view

from .conftest import SF


@pytest.fixture(scope="module")
def valid(spark):
    return trips_from_pings(read_events_view(spark, SF)).persist()


@pytest.fixture(scope="module")
def frame(valid):
    return valid.toPandas()


def test_hours_without_trips_are_zero(trips_of):
    t = trips_of([(1, 7 * 3600, 7 * 3600 + 600, 10.0, 3.0, 18.0), (2, 7 * 3600 + 5, 7 * 3600 + 305, 5.0, 2.0, 24.0), (1, 8 * 3600, 8 * 3600 + 60, 1.0, 1.0, 60.0)])
    rows = temporal.hourly_stats(t).orderBy("hour").collect()
    assert [r.hour for r in rows] == list(range(24))
    assert (rows[7].trip_count, rows[7].avg_duration, rows[7].median_duration, rows[7].unique_vehicles) == (2, 7.5, 7.5, 2)
    assert all(r.trip_count == 0 and r.avg_duration == 0 for r in rows if r.hour not in (7, 8))


def test_hourly_equals_pandas(valid, frame):
    got = temporal.hourly_stats(valid).orderBy("hour").toPandas()
    g = frame.groupby("hour")
    for name, want in {
        "trip_count": g.size(), "avg_duration": g.duration_min.mean(), "median_duration": g.duration_min.median(),
        "avg_distance": g.distance_km.mean(), "unique_vehicles": g.vehicle_id.nunique(),
    }.items():
        np.testing.assert_allclose(got[name], want.reindex(range(24)).fillna(0), rtol=1e-12)


def test_peaks(trips_of):
    hours = [8] * 30 + [18] * 30 + [17] * 20 + [3] * 20
    t = trips_of([(i, h * 3600, h * 3600 + 600, 10.0, 3.0, 18.0) for i, h in enumerate(hours)])
    p = temporal.peak_hours(temporal.hourly_counts(t)).first()
    assert p.mean_hourly_trips == pytest.approx(100 / 24)
    assert (p.peak_hours, p.morning_peak, p.evening_peak) == ([3, 8, 17, 18], [8], [17, 18])
    assert (p.peak_hour_max, p.peak_max_trips) == (8, 30)


def test_period_gaps_and_empty_periods(trips_of):
    t = trips_of([(1, 3 * 3600, 3 * 3600 + 60, 1.0, 1.0, 60.0), (1, 86370, 86399, 1.0, 1.0, 60.0), (1, 25200, 25260, 1.0, 1.0, 60.0), (1, 32400, 32460, 1.0, 1.0, 60.0)])
    rows = temporal.period_stats(t).orderBy("period_no").collect()
    assert [r.trip_count for r in rows] == [1, 1, 0, 0]
    assert [r.ratio_pct for r in rows] == [25.0, 25.0, 0.0, 0.0]
    assert rows[2].avg_duration is None and rows[2].active_vehicles == 0
    outside = temporal.period_stats(t.where("hour in (3, 23)")).collect()
    assert [r.ratio_pct for r in outside] == [0.0] * 4


def test_bin_edges(trips_of):
    t = trips_of([(1, 0, 1, d, 1.0, 10.0) for d in (0.0, 5.0, 240.0, 240.1)])
    assert [r.n for r in temporal.duration_histogram(t).orderBy("bin_no").collect()] == [1, 0, 0, 0, 0, 0, 1]


def test_duration_stats_equal_pandas(valid, frame):
    got, d = temporal.duration_stats(valid).first(), frame.duration_min
    want = {
        "mean": d.mean(), "median": d.median(), "std": d.std(), "skewness": d.skew(), "kurtosis": d.kurtosis(),
        "p25": d.quantile(0.25), "p90": d.quantile(0.9), "p99": d.quantile(0.99), "min": d.min(), "max": d.max(),
    }
    for k, v in want.items():
        assert got[k] == pytest.approx(v, rel=1e-10), k


def test_small_samples_have_no_shape(trips_of):
    rows = [(1, 0, 60 * i, float(i), 1.0, 10.0) for i in (1, 2, 4)]
    two, three = (temporal.duration_stats(trips_of(rows[:n])).first() for n in (2, 3))
    assert two.skewness is None and three.skewness is not None and three.kurtosis is None


def test_exact_percentiles(spark):
    rng = random.Random(3)
    heavy = [rng.choice((1.5, 1.5, 1.5, rng.paretovariate(0.7), -rng.random())) for _ in range(40_000)]
    for values in (heavy, [2.0] * 100, [7.0], [1.0, 2.0]):
        df = spark.createDataFrame(pd.DataFrame({"v": values}))
        fractions = [0.0, 0.25, 0.5, 0.9, 0.999, 1.0]
        for rows in (1_000_000, 50):  # at once, and by narrowing
            got = exact_percentiles(df, "v", fractions, settled_rows=rows)
            assert got == pytest.approx(np.quantile(values, fractions), rel=1e-12)
    assert exact_percentiles(df.limit(0), "v", [0.5]) == [None]


def test_distance_and_speed_stats(valid, frame):
    got = temporal.distance_stats(valid).first()
    assert got.p95 == pytest.approx(frame.distance_km.quantile(0.95), rel=1e-12)
    assert got.short_trip_ratio == pytest.approx((frame.distance_km < 3).mean() * 100)
    assert temporal.speed_stats(valid).first().median == pytest.approx(frame.avg_speed.median(), rel=1e-12)


def test_kpis_and_vehicles(valid, frame):
    k = temporal.kpis(valid).first()
    assert (k.total_trips, k.total_vehicles) == (len(frame), frame.vehicle_id.nunique())
    assert k.peak_trips == frame.groupby("hour").size().max()
    top = temporal.top_vehicles(temporal.vehicle_efficiency(valid), 3).collect()
    sizes = frame.groupby("vehicle_id").size().sort_values(ascending=False)
    assert [r.trip_count for r in top] == sizes.head(3).tolist()


def test_empty_trips_keep_their_schema(trips_of):
    t = trips_of([(1, 0, 60, 1.0, 1.0, 60.0)]).limit(0)
    assert temporal.hourly_stats(t).count() == 24
    k = temporal.kpis(t).first()
    assert (k.total_trips, k.peak_trips, k.trips_per_vehicle) == (0, 0, None)
    assert temporal.distance_stats(t).first().mean is None
    assert temporal.duration_stats(t).first().n == 0
    assert [r.n for r in temporal.speed_histogram(t).collect()] == [0] * 8


def test_sample_is_the_smallest_hashes_on_any_layout(valid, frame):
    a = {r.trip_id for r in sample.sample_trips(valid, 40).collect()}
    b = {r.trip_id for r in sample.sample_trips(valid.repartition(5), 40).collect()}
    assert len(a) == 40 and a == b and a <= set(frame.trip_id)
    assert {r.trip_id for r in sample.sample_trips(valid, 40, seed=1).collect()} != a
    assert sample.sample_trips(valid, 10_000).count() == len(frame)
    assert sample.sample_trips(valid.limit(0), 5).count() == 0


def test_derived_columns(spark):
    bare = spark.createDataFrame([(1, 85_800, 600, 114.0, 22.5, 114.0, 22.6)], "vehicle_id long, s_sec long, e_sec long, s_lng double, s_lat double, e_lng double, e_lat double")
    r = temporal.with_derived(bare).first()
    assert (r.hour, r.duration_min) == (23, 20.0)
    assert r.distance_km == pytest.approx(6371 * math.radians(0.1))


def test_speed_segments_and_profile(pings_of):
    pings = pings_of([(1, i, s, 114.0, 22.6, v) for i, (s, v) in enumerate([(0, 0.0), (1, 0.5), (1, 1.0), (2, 20.0), (1, 60.1), (1, None), (1, -4.0)])])
    assert [r.n for r in quality.speed_segments(pings).orderBy("bin_no").collect()] == [1, 2, 1, 0, 0, 1]
    p = {r.metric: r.value for r in quality.quality_profile(pings).collect()}
    assert (p["rows"], p["occupied"], p["other_status"], p["speed_median"]) == (7, 1, 1, 0.75)
    assert {r.column_name: r.nulls for r in quality.null_profile(pings).collect()}["speed"] == 1
    empty = {r.metric: r.pct for r in quality.quality_profile(pings.limit(0)).collect()}
    assert empty["occupied"] is None
