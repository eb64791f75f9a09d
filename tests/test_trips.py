import random
from dataclasses import replace


from tripweave.operators import trips as T
from tripweave.operators.sequence import listed, sequence
from pyspark.sql import functions as F

from tripweave.params import DEFAULTS
from tripweave.schemas import TRIP


def _pairs(pings, strict=True, p=DEFAULTS):
    changes = T.status_changes(sequence(pings, p))
    return sorted((r.vehicle_id, r.trip_id, r.s_sec, r.e_sec) for r in T.pair_trips(changes, strict).collect())


def _day(status, vehicle=1):
    return [(vehicle, 100 + i, s) for i, s in enumerate(status)]


def test_hand_made_days(pings_of):
    assert _pairs(pings_of(_day([1, 0, 0]))) == []
    assert _pairs(pings_of(_day([0, 1, 0, 1]))) == [(1, 2, 102, 103)]
    assert _pairs(pings_of(_day([0, 0, 1]))) == []
    assert _pairs(pings_of([(1, 5, 1), (1, 9, 0), (1, 9, 1)])) == [(1, 1, 9, 9)]


def test_unclosed(pings_of):
    changes = T.status_changes(sequence(pings_of(_day([1, 0, 0]) + _day([1, 0, 1], 2))))
    for strict in (True, False):
        assert tuple(T.unclosed_trips(changes, strict).first()) == (2, 1)


def test_foreign_status_pairs_first_in_first_out(pings_of):
    assert _pairs(pings_of(_day([1, 0, 2, 1, 0, 1])), strict=False) == [(1, 1, 101, 105)]


def _loop(status):
    """Queue of open starts; an end takes the oldest, or is discarded."""
    queue, out = [], []
    for i in range(1, len(status)):
        a, b = status[i - 1], status[i]
        if (a, b) == (1, 0):
            queue.append(i)
        elif (a, b) == (0, 1) and queue:
            out.append((queue.pop(0), i))
    return out


def test_pairing_equals_the_loop_on_random_days(pings_of):
    rng = random.Random(5)
    for values, strict in (((0, 1), True), ((0, 1), False), ((0, 1, 2, None), False)):
        rows, want, at = [], [], 0
        for vehicle in range(60):
            status = [rng.choice(values) for _ in range(rng.randrange(1, 40))]
            rows += _day(status, vehicle)
            want += [(vehicle, at + s, 100 + s, 100 + e) for s, e in _loop(status)]
            at += len(status)
        pings = pings_of(rows)
        assert _pairs(pings, strict) == sorted(want)
        assert _pairs(pings, strict, replace(DEFAULTS, max_rows_per_task=7)) == sorted(want)


def test_hot_vehicle_among_others(pings_of):
    rng = random.Random(9)
    status = [rng.choice((0, 1)) for _ in range(400)]
    rows = _day(status, 1) + _day([1, 0, 1], 2) + _day([1, 0, 0, 1], 3)
    p = replace(DEFAULTS, max_rows_per_task=50)
    assert sequence(pings_of(rows), p).split
    assert _pairs(pings_of(rows), p=p) == _pairs(pings_of(rows))
    many = replace(p, max_hot_keys=0)  # too many hot days to list: a table of their own
    assert _pairs(pings_of(rows), p=many) == _pairs(pings_of(rows))


def test_many_hot_days_are_carried_within_the_bound(pings_of):
    rng = random.Random(10)
    rows = [r for v in range(40) for r in _day([rng.choice((0, 1)) for _ in range(30 if v < 12 else 6)], v)]
    p = replace(DEFAULTS, max_rows_per_task=15, max_hot_keys=4, max_broadcast_rows=20)
    split = sequence(pings_of(rows), p)
    assert split.split and split.hot_days == 12
    assert split.df.where("chunk >= 0").select("vehicle_id").distinct().count() == 12  # ordinary days stay whole
    plan = T.trips_from_pings(pings_of(rows), p)._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" not in plan
    assert _pairs(pings_of(rows), p=p) == _pairs(pings_of(rows))


def test_pings_without_a_vehicle_belong_to_no_trip(spark, pings_of):
    rows = pings_of(_day([1, 0, 1], 1))
    nobody = pings_of(_day([1, 0, 1, 0, 1] * 20, 5)).withColumn("vehicle_id", F.lit(None).cast("long"))
    p = replace(DEFAULTS, max_rows_per_task=10)
    assert _pairs(rows.union(nobody), p=p) == _pairs(rows)


def test_filter_bounds_are_inclusive(trips_of):
    ok = [(1, 0, 60, 1.0, 1.0, 60.0), (1, 0, 14400, 240.0, 40.0, 10.0), (1, 0, 60, 1.0, 0.2, 12.0), (1, 0, 600, 10.0, 5.0, 5.0), (1, 0, 600, 10.0, 5.0, 100.0)]
    bad = [(1, 0, 59, 0.98, 1.0, 60.0), (1, 0, 14401, 240.1, 40.0, 10.0), (1, 0, 60, 1.0, 0.19, 12.0), (1, 0, 600, 10.0, 5.0, 4.9), (1, 0, 600, 10.0, 5.0, 100.1), (1, 0, 600, 10.0, None, 50.0)]
    trips = trips_of(ok + bad)
    assert [r.trip_id for r in T.filter_trips(trips).orderBy("trip_id").collect()] == [0, 1, 2, 3, 4]
    reasons = trips.select(T.reject_reason().alias("r")).collect()
    assert [r.r for r in reasons] == [None] * 5 + ["too_short", "too_long", "too_near", "too_slow", "too_fast", "no_measure"]
    assert T.rule5_rejects(trips).first().too_short == 1


def test_measures(spark):
    rows = [(0, 1, None, 23 * 3600 + 3000, 114.0, 22.5, 600, 114.1, 22.5), (1, 1, None, 50, 114.0, 22.5, 50, 114.0, 22.5)]
    m = T.measure(spark.createDataFrame(rows, TRIP[:9])).orderBy("trip_id").collect()
    assert m[0].duration_min == 20.0 and m[0].hour == 23
    assert abs(m[0].distance_km - 10.273) < 0.01
    assert m[1].avg_speed == 0.0 and m[1].duration_min == 0.0


def test_empty_input(pings_of):
    out = T.trips_from_pings(pings_of([(1, 0, 1)]).limit(0))
    assert out.count() == 0
    assert set(out.columns) == set(TRIP.names)


def test_one_shuffle_and_one_sort_from_pings_to_trips(spark, pings_of, tmp_path):
    pings_of(_day([1, 0, 1])).write.parquet(str(tmp_path / "p"))
    plan = T.trips_from_pings(spark.read.parquet(str(tmp_path / "p")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1
    assert plan.count("Sort [") == 1


def test_funnel_adds_up(spark):
    from tripweave.operators.quality import cleaning_funnel
    from tripweave.sources.events_view import read_events_view

    from .conftest import SF

    rows = cleaning_funnel(read_events_view(spark, SF)).orderBy("step_no").collect()
    assert [(r.rows_before, r.rows_after) for r in rows] == [(1000, 989), (989, 989), (989, 226), (226, 167)]
    assert all(r.rows_before - r.removed == r.rows_after for r in rows)
    none = cleaning_funnel(read_events_view(spark, SF).limit(0)).collect()
    assert all(r.removal_pct is None for r in none)


def test_the_distance_is_worked_out_once(spark, pings_of, tmp_path):
    pings_of(_day([1, 0, 1])).write.parquet(str(tmp_path / "pings"))
    plan = T.trips_from_pings(spark.read.parquet(str(tmp_path / "pings")))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ATAN2") == 1


def test_last_pings_come_with_the_changes(pings_of):
    """Whole days and chunks of three pings: the same changes, and an end for every day."""
    pings = pings_of([ping for v in range(3) for ping in _day([1, 0, 0, 1, 1, 0, 1, 1][: 5 + v], v)])
    for p in (DEFAULTS, replace(DEFAULTS, max_rows_per_task=3)):
        seq = sequence(pings, p)
        plain, both = T.status_changes(seq).df, T.status_changes(seq, ends=True).df
        facts = lambda df: sorted(map(tuple, df.select("vehicle_id", "seq", "change").collect()))
        assert facts(plain) == facts(both.where("change is not null"))
        last = both.where("is_end").groupBy("vehicle_id").agg(F.max("seq").alias("seq"))
        assert sorted(map(tuple, last.collect())) == sorted(map(tuple, pings.groupBy("vehicle_id").agg(F.max("seq")).collect()))


def test_the_prior_status_stands_for_the_first_ping_only(pings_of):
    """A null status before a ping is a ping all the same; in one window and in chunks of two."""
    pings = pings_of(_day([0, None, 0, 1, 0])).withColumn("prior_status", F.lit(1))
    for p in (DEFAULTS, replace(DEFAULTS, max_rows_per_task=2)):
        found = T.status_changes(sequence(pings, p)).df.select("seq", "prev_status", "change")
        assert sorted(map(tuple, found.collect())) == [(0, 1, 1), (3, 0, -1), (4, 1, 1)]


def test_rare_rows_are_listed_in_as_many_jobs_whatever_the_partitions(spark):
    rare = lambda n: spark.range(0, 1000, 1, n).where("id % 100 = 99")
    assert sorted(r.id for r in listed(rare(4), 10)) == list(range(99, 1000, 100))
    assert listed(rare(4), 9) is None and listed(rare(4).where("id < 0"), 9) == []

    def jobs(n):
        spark.sparkContext.setJobGroup(f"listed {n}", "")
        try:
            assert listed(rare(n).where("id < 0"), 9) == []
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"listed {n}"))

    assert 0 < jobs(2) == jobs(200)
