"""Days cleaned one after the other against one long run."""

from __future__ import annotations

import datetime as dt
import random
from dataclasses import replace

from tripweave.params import DEFAULTS
from tripweave.plans import days
from tripweave.schemas import PING

D = [dt.date(2024, 1, d) for d in (1, 2, 4)]


def _pings(spark, rows):
    """(vehicle, day index, second, status[, speed]) in source order."""
    made = [
        (i, v, D[d], s, 114.0 + (i % 97) / 300, 22.6 + (i % 31) / 300, status, *(rest or (30.0,))) for i, (v, d, s, status, *rest) in enumerate(rows)
    ]
    return spark.createDataFrame(made, PING), made


def _one_run(made, p=DEFAULTS):
    """Trips of each vehicle in one run: (start, vehicle, start day, start second, end second, seconds); and open starts."""
    trips, still = [], set()
    plausible = {(r[1], r[2]) for r in made if r[7] is not None and 0 <= r[7] <= 150}
    for v in sorted({r[1] for r in made}):
        at = lambda r: (r[2] - D[0]).days * 86_400 + r[3]
        rows = sorted((r for r in made if r[1] == v and (v, r[2]) in plausible), key=lambda r: (at(r), r[0]))
        status, start = None, None
        for r in rows:
            if status == 1 and r[6] == 0:
                start = r
            elif status == 0 and r[6] == 1 and start:
                trips.append((start[0], v, start[2], start[3], r[3], at(r) - at(start)))
                start = None
            status = r[6]
        if start:
            still.add((v, start[0]))
    return sorted(t for t in trips if 60 <= t[5] <= 240 * 60), still


def _stored(spark, target):
    cols = ("trip_id", "vehicle_id", "service_date", "s_sec", "e_sec", "duration_s")
    return sorted(tuple(r[c] for c in cols) for r in days.day_trips(spark, target).collect())


LOOSE = replace(DEFAULTS, trip_km_min=0.0, trip_kmh_min=0.0, trip_kmh_max=1e9)


def test_hand_made_midnights(spark, tmp_path):
    rows = [
        (1, 0, 80_000, 1), (1, 0, 86_000, 0), (1, 1, 600, 1),  # over midnight
        (2, 0, 86_000, 1), (2, 1, 600, 0), (2, 1, 1200, 1),  # the change lies across midnight
        (3, 0, 86_000, 1), (3, 0, 86_100, 0), (3, 2, 100, 1),  # two days later: too long
        (4, 0, 100, 1), (4, 0, 200, 0), (4, 1, 300, 0), (4, 2, 400, 0),  # never ends
        (5, 0, 86_000, 1), (5, 0, 86_300, 0), (5, 1, 50, 1, 999.0),  # a day without a plausible speed does not count
        (6, 0, 86_000, 0), (6, 1, 50, 1),  # started before the first ping
    ]
    pings, made = _pings(spark, rows)
    days.clean_from(spark, str(tmp_path), D[0], pings, LOOSE)
    trips, still = _one_run(made)
    assert [t[:2] for t in trips] == [(1, 1), (4, 2)] and _stored(spark, str(tmp_path)) == trips
    assert {(r.vehicle_id, r.seq) for r in days.open_trips(spark, str(tmp_path)).collect()} == still == {(4, 10), (5, 14)}


def test_random_days_and_a_repair(spark, tmp_path):
    rnd = random.Random(6)
    rows = [(v, d, rnd.choice([rnd.randrange(3000), 83_000 + rnd.randrange(3400)]), rnd.randrange(2)) for v in range(12) for d in range(3) for _ in range(rnd.randint(0, 9))]
    rnd.shuffle(rows)
    pings, made = _pings(spark, rows)
    target = str(tmp_path / "t")
    days.clean_from(spark, target, D[0], pings.where("seq % 3 > 0 OR service_date <> DATE'2024-01-02'"), LOOSE)
    days.clean_from(spark, target, D[1], pings, LOOSE)  # the second day again, whole
    trips, still = _one_run(made)
    assert _stored(spark, target) == trips and {(r.vehicle_id, r.seq) for r in days.open_trips(spark, target).collect()} == still
    hot = str(tmp_path / "hot")
    days.clean_from(spark, hot, D[0], pings, replace(LOOSE, max_rows_per_task=5))  # vehicle-days in chunks
    assert _stored(spark, hot) == trips
