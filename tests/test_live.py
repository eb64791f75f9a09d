import datetime as dt
import random
from dataclasses import replace

import numpy as np
from pyspark.sql import functions as F

from tripweave.operators.trips import trips_from_pings
from tripweave.params import DEFAULTS
from tripweave.plans import board
from tripweave.sources.events_view import read_events_view, with_timestamps
from tripweave.sources import sinks
from tripweave.streaming import keyed, live

from .conftest import SF

COLS = ["seq", "vehicle_id", "ts", "lng", "lat", "open_status", "speed"]


def _stream(spark, frames, tmp_path):
    """One file per frame, read in order, one per micro-batch."""
    src = str(tmp_path / "src")
    for i, frame in enumerate(frames):
        frame.select(*COLS).coalesce(1).write.mode("append").parquet(f"{src}/part={i}")
        for f in sorted((tmp_path / "src" / f"part={i}").glob("*.parquet")):
            __import__("os").utime(f, (1_700_000_000 + i * 10, 1_700_000_000 + i * 10))
    schema = live.LIVE_PING
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(src)


def _run(query):
    query.awaitTermination()
    assert query.exception() is None


def _frames(spark):
    """Shuffled files with repeats; a ping from the next day moves the watermark past the end."""
    pings = with_timestamps(read_events_view(spark, SF))
    rng = random.Random(4)
    rows = [r.asDict() for r in pings.orderBy("ts", "seq").collect()]
    frames = []
    for i in range(6):
        part = rows[i * len(rows) // 6:(i + 1) * len(rows) // 6]
        part = part + rng.sample(part, 20)
        rng.shuffle(part)
        frames.append(spark.createDataFrame(part, pings.schema))
    sentinel = dict(rows[0], seq=10**9, vehicle_id=10**6, ts=rows[-1]["ts"] + dt.timedelta(days=1))
    frames.append(spark.createDataFrame([sentinel], pings.schema))
    return frames


def _facts(trips):
    cols = ["trip_id", "vehicle_id", "service_date", "s_sec", "e_sec", "duration_s", "hour"]
    return sorted(map(tuple, trips.select(cols).collect()))


def test_stream_equals_batch(spark, tmp_path):
    frames = _frames(spark)
    stream = live.watermarked(_stream(spark, frames, tmp_path))
    out = str(tmp_path / "trips")
    _run(live.start_trips(live.assemble(live.drop_repeats(stream)), out, str(tmp_path / "c1"), once=True))
    got = spark.read.parquet(out)
    want = trips_from_pings(read_events_view(spark, SF))
    assert _facts(got) == _facts(want)

    target = str(tmp_path / "board")
    trips = spark.readStream.schema(got.schema).option("maxFilesPerTrigger", 5).parquet(out)
    _run(live.start_board(trips, target, str(tmp_path / "c2"), once=True))
    rows = live.board(spark, target).where("stat_type = 'hourly_trips'").collect()
    hours = {r.stat_key[11:13]: int(r.stat_value) for r in rows}
    assert hours == {f"{r.hour:02d}": r["count"] for r in want.groupBy("hour").count().collect()}


def test_settling_equals_batch_with_hot_vehicles(spark, tmp_path):
    """Vehicle-days above 15 pings are cut into chunks in every micro-batch."""
    target, p = str(tmp_path / "settled"), replace(DEFAULTS, max_rows_per_task=15)
    stream = _stream(spark, _frames(spark), tmp_path)
    _run(live.start_settling(stream, target, str(tmp_path / "c"), once=True, p=p))
    got = live.settled_trips(spark, target)
    want = trips_from_pings(read_events_view(spark, SF))
    assert _facts(got) == _facts(want)
    version = live.published_version(spark, target)
    kept = sinks.read_published(spark, target, "kept").count()
    assert version == 6 and kept == 1  # only the ping of the new day is ahead


def test_settling_keeps_an_open_trip(spark, tmp_path):
    target = str(tmp_path / "s")
    at = lambda h, m: dt.datetime(2024, 1, 1, h, m)
    row = lambda seq, ts, status, lng=114.0: (seq, 1, ts, lng, 22.6, status, 30.0)
    batches = [
        [row(0, at(8, 0), 1), row(1, at(8, 1), 0), row(2, at(9, 30), 0)],
        [row(1, at(8, 1), 0), row(3, at(9, 40), 1, 114.3), row(4, at(10, 50), 1, 114.3)],
        [row(5, at(13, 0), 1)],
    ]
    for i, rows in enumerate(batches):
        for _ in range(2):  # a replayed batch changes nothing
            live.settle(spark.createDataFrame(rows, live.LIVE_PING), i, target)
        n = live.settled_trips(spark, target).count()
        assert n == (0, 1, 1)[i]
    trip = live.settled_trips(spark, target).first()
    assert (trip.trip_id, trip.duration_min, trip.s_ts, trip.e_ts) == (1, 99.0, at(8, 1), at(9, 40))


def test_repeats_stay_whole_rows(spark, tmp_path):
    """Two pings under one number: one of them is taken, never a mix of both."""
    target, at = str(tmp_path / "r"), lambda h, m: dt.datetime(2024, 1, 1, h, m)
    rows = [(0, 1, at(8, 1), 114.0, 22.6, 1, 30.0), (0, 1, at(8, 2), 113.9, 22.8, 0, 20.0), (1, None, at(8, 0), 114.0, 22.6, 0, 1.0)]
    live.settle(spark.createDataFrame(rows, live.LIVE_PING), 0, target)
    kept = [tuple(r) for r in sinks.read_published(spark, target, "kept").select("seq", "ts", "lng", "lat").collect()]
    assert kept == [(0, at(8, 2), 113.9, 22.8)]


def test_refresh_is_idempotent(spark, tmp_path):
    target = str(tmp_path / "b")
    hourly = lambda n: spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 7), n, 20.0, 3.0)], "window_start timestamp, trip_count long, avg_speed double, avg_distance double"
    )
    live.refresh_board(live.board_rows(hourly(5)), 0, target)
    for _ in range(2):
        live.refresh_board(live.board_rows(hourly(8)), 1, target)
    rows = live.board(spark, target).collect()
    assert [(r.stat_key, r.stat_value) for r in rows] == [("2024-01-01 07:00", 8.0)]


def test_cache_documents(spark):
    trips = trips_from_pings(read_events_view(spark, SF)).persist()
    cache = board.cache_rows(trips, None).persist()
    assert cache.groupBy("stat_type", "stat_key").count().where("count > 1").count() == 0
    assert board.read_kpis(cache).first().total_trips == 167
    trend = board.read_trend(cache).collect()
    assert [r.hours for r in trend] == [f"{h:02d}:00" for h in range(24)]
    assert sum(r.trips for r in trend) == 167
    heat = board.read_heatmap(cache).collect()
    assert [r["count"] for r in heat] == sorted((r["count"] for r in heat), reverse=True)
    assert [r.label for r in board.read_periods(cache).collect()] == ["早高峰", "日间平峰", "晚高峰", "夜间"]
    assert len(board.read_hourly(cache).collect()) == 24
    one = board.read_dashboard(cache).first()
    assert one.kpis.total_trips == 167 and one.ranking is None and len(one.hourly) == 24


def test_keyed_state_equals_batch_with_late_and_repeated_pings(spark, tmp_path):
    *frames, last = _frames(spark)
    # Spark filters before it looks at event times, so the ping that ends the day must be in the box
    frames.append(last.withColumn("lng", F.lit(114.0)))
    stream = live.watermarked(_stream(spark, frames, tmp_path))
    out = str(tmp_path / "trips")
    with keyed.state_store(spark):
        _run(live.start_trips(keyed.assemble_keyed(stream), out, str(tmp_path / "c"), once=True))
    assert _facts(spark.read.parquet(out)) == _facts(trips_from_pings(read_events_view(spark, SF)))


def test_keyed_state_writes_what_is_new(spark, tmp_path):
    """All pings wait behind a long watermark; the bytes of a batch follow its own pings."""
    day, batches = dt.datetime(2024, 1, 1), 8
    frames = [
        spark.createDataFrame(
            [(1000 * b + i, i % 5, day + dt.timedelta(seconds=9000 * b + 25 * i), 114.0, 22.6, i % 2, 30.0) for i in range(300)], live.LIVE_PING
        ) for b in range(batches)
    ]
    stream = live.watermarked(_stream(spark, frames, tmp_path), "3 days")
    with keyed.state_store(spark):
        query = live.start_trips(keyed.assemble_keyed(stream), str(tmp_path / "t"), str(tmp_path / "c"), once=True)
        _run(query)
    sizes = {}
    for delta in (tmp_path / "c" / "state").rglob("*.changelog"):
        version = int(delta.name.split(".")[0].split("_")[0])
        sizes[version] = sizes.get(version, 0) + delta.stat().st_size
    written = [sizes[v] for v in sorted(sizes) if v <= batches]
    assert len(written) >= batches and max(written[1:batches]) < 1.5 * min(written[1:batches])


def test_keyed_state_has_an_entry_an_hour(spark, tmp_path):
    """A ping in each slot of the day: what waits is stored by hours, not by slots or pings."""
    day = dt.datetime(2024, 1, 1)
    frame = spark.createDataFrame(
        [(i, i % 5, day + dt.timedelta(seconds=60 * i), 114.0, 22.6, i % 2, 30.0) for i in range(1440)], live.LIVE_PING
    )
    stream = live.watermarked(_stream(spark, [frame], tmp_path), "3 days")
    with keyed.state_store(spark):
        query = live.start_trips(keyed.assemble_keyed(stream), str(tmp_path / "t"), str(tmp_path / "c"), once=True)
        _run(query)
    entries = max(op["numRowsUpdated"] for x in query.recentProgress for op in x["stateOperators"])
    assert 5 * 24 <= entries < 5 * 48


def test_keyed_state_of_many_vehicles_in_one_group(spark, tmp_path):
    frames = _frames(spark)
    frames[-1] = frames[-1].withColumn("lng", F.lit(114.0))
    stream, out = live.watermarked(_stream(spark, frames, tmp_path)), str(tmp_path / "trips")
    with keyed.state_store(spark):
        trips = keyed.assemble_keyed(stream, replace(DEFAULTS, vehicle_groups=2))
        _run(live.start_trips(trips, out, str(tmp_path / "c"), once=True))
    assert _facts(spark.read.parquet(out)) == _facts(trips_from_pings(read_events_view(spark, SF)))


def test_replay_equals_a_loop():
    """Pings of many vehicles in several pieces, tails carried from one to the next."""
    rng = random.Random(7)
    tails, got, want, known = np.empty(0, live.TAIL), [], [], {}
    for piece in range(6):
        pings = np.array([
            (rng.randrange(12), 100 * piece + i, 1000 * piece + rng.randrange(900), 114.0 + i / 1000, 22.6, rng.randrange(2)) for i in range(40)
        ], live.HELD)
        trips, tails = live.replay(pings, tails, dt.date(2024, 1, 1))
        got += [tuple(r) for r in trips[["trip_id", "vehicle_id", "s_us", "s_lng", "e_us", "e_lng"]].itertuples(index=False)]
        for vehicle, seq, us, lng, _, status in sorted(pings.tolist(), key=lambda r: (r[2], r[1])):
            last, start = known.get(vehicle, (None, None))
            if (last, status) == (1, 0):
                start = (seq, us, lng)
            elif (last, status) == (0, 1) and start:
                want.append((start[0], vehicle, start[1], start[2], us, lng))
                start = None
            known[vehicle] = status, start
    assert got and sorted(got) == sorted(want)
    assert {t["vehicle_id"]: (t["status"], (t["s_seq"], t["s_us"], t["s_lng"]) if t["open"] else None) for t in tails} == known


def test_assembled_state_is_kept_by_groups(spark, tmp_path):
    """15 vehicles in 4 groups: a state for each group and day, and the trips of the batch."""
    stream, out = live.watermarked(_stream(spark, _frames(spark), tmp_path)), str(tmp_path / "trips")
    trips = live.assemble(live.drop_repeats(stream), replace(DEFAULTS, vehicle_groups=4))
    query = live.start_trips(trips, out, str(tmp_path / "c"), once=True)
    _run(query)
    states = [op["numRowsTotal"] for x in query.recentProgress for op in x["stateOperators"] if "WithState" in op["operatorName"]]
    assert states and 0 < max(states) <= 4 + 1  # one more for the ping of the next day
    assert _facts(spark.read.parquet(out)) == _facts(trips_from_pings(read_events_view(spark, SF)))


def test_pings_sent_again_whether_few_or_many(spark):
    """None, few (listed) and many repeats, numbers and none, give one whole row each: a kept one, else the latest."""
    at = lambda m: dt.datetime(2024, 1, 1, 8, m)
    row = lambda seq, vehicle, m, prior=None: (seq, vehicle, at(m), 114.0 + m / 100, 22.6, m % 2, 30.0, prior)
    schema = "seq long, vehicle_id long, ts timestamp, lng double, lat double, open_status int, speed double, prior_status int"
    once = [row(1, 1, 0), row(2, 1, 1), row(1, 2, 2), row(None, 3, 3)]
    again = [row(5, 1, 4), row(5, 1, 9), row(6, 1, 4, 1), row(6, 1, 9), row(None, 1, 5), row(None, 1, 6)]
    want = [row(5, 1, 9), row(6, 1, 4, 1), row(None, 1, 6)]
    for rows, expected in ((once, once), (once + again, once + want)):
        df = spark.createDataFrame(rows, schema)
        for p in (DEFAULTS, replace(DEFAULTS, max_broadcast_rows=1)):
            got = live.sent_once(df, p)
            assert got.columns == df.columns and sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, expected))
            got.unpersist()


def test_an_open_start_that_is_the_last_ping_is_kept_once(spark, tmp_path):
    target, at = str(tmp_path / "o"), lambda h, m: dt.datetime(2024, 1, 1, h, m)
    rows = [(0, 1, at(8, 0), 114.0, 22.6, 1, 30.0), (1, 1, at(8, 5), 114.0, 22.6, 0, 30.0), (2, 1, at(10, 0), 114.3, 22.6, 1, 30.0)]
    live.settle(spark.createDataFrame(rows, live.LIVE_PING), 0, target)
    kept = sinks.read_published(spark, target, "kept").select("seq", "prior_status")
    assert sorted(map(tuple, kept.collect())) == [(1, 1), (2, None)]
    live.close(spark, target)
    assert [(t.trip_id, t.e_ts) for t in live.settled_trips(spark, target).collect()] == [(1, at(10, 0))]
