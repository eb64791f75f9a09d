import math
from dataclasses import replace

from pyspark.sql import functions as F

from tripweave.operators import clean
from tripweave.operators.sequence import CHUNK, sequence
from tripweave.params import DEFAULTS
from tripweave.sources.events_view import read_events_view

from .conftest import SF

SMALL = replace(DEFAULTS, max_rows_per_task=20)


def test_box_is_inclusive_and_drops_nulls(pings_of):
    pings = pings_of([
        (1, 0, 1, 113.5, 22.9), (1, 1, 1, 114.5, 22.4), (1, 2, 1, 113.49, 22.6),
        (1, 3, 1, None, 22.6), (1, 4, 1, 114.0, None),
    ])
    assert [r.seq for r in clean.filter_box(pings).orderBy("seq").collect()] == [0, 1]


def test_box_filter_reaches_the_scan(spark, pings_of, tmp_path):
    pings_of([(1, 0, 1)]).write.parquet(str(tmp_path / "p"))
    plan = clean.filter_box(spark.read.parquet(str(tmp_path / "p")))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(lng), IsNotNull(lat), GreaterThanOrEqual(lng,113.5)" in plan


def _speeds(pings, **kw):
    fixed = clean.repair_speed(sequence(pings, kw.pop("p", DEFAULTS)), **kw)
    return [(r.vehicle_id, r.speed) for r in fixed.df.orderBy("vehicle_id", "sec_of_day", "seq").collect()]


RUN = [None, -1.0, 10.0, 200.0, 200.0, 40.0, 151.0]


def test_speed_repair(pings_of):
    pings = pings_of(
        [(1, i, 1, 114.0, 22.6, v) for i, v in enumerate(RUN)]
        + [(2, 0, 1, 114.0, 22.6, 200.0), (2, 1, 1, 114.0, 22.6, 300.0)]
    )
    assert [v for _, v in _speeds(pings)] == [10, 10, 10, 20, 30, 40, 40]
    assert [v for _, v in _speeds(pings, method="ffill")] == [10, 10, 10, 10, 10, 40, 40]


def test_speed_repair_across_chunks(pings_of):
    p = replace(DEFAULTS, max_rows_per_task=2)
    pings = pings_of([(1, i, 1, 114.0, 22.6, v) for i, v in enumerate(RUN)])
    assert sequence(pings, p).split
    assert [v for _, v in _speeds(pings, p=p)] == [10, 10, 10, 20, 30, 40, 40]
    assert [v for _, v in _speeds(pings, p=p, method="ffill")] == [10, 10, 10, 10, 10, 40, 40]


def test_speedless_vehicles_are_dropped_in_chunks_too(pings_of):
    rows = [(1, i, 1, 114.0, 22.6, 200.0) for i in range(9)] + [(1, 9, 1, 114.0, 22.6, 50.0)]
    rows += [(2, i, 1, 114.0, 22.6, 200.0) for i in range(10)]
    for p in (DEFAULTS, replace(DEFAULTS, max_rows_per_task=3)):
        kept = clean.drop_speedless(sequence(pings_of(rows), p)).df
        assert [(r.vehicle_id, r["count"]) for r in kept.groupBy("vehicle_id").count().collect()] == [(1, 10)]


def test_chunks_are_bounded_and_ordered(spark):
    pings = clean.filter_box(read_events_view(spark, SF)).withColumn("vehicle_id", F.lit(7).cast("long"))
    seq = sequence(pings, SMALL)
    groups = seq.df.groupBy(CHUNK).agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("sec_of_day", "seq")).alias("lo"), F.max(F.struct("sec_of_day", "seq")).alias("hi")
    ).orderBy(CHUNK).collect()
    assert sum(g.n for g in groups) == pings.count()
    assert max(g.n for g in groups) <= 4 * SMALL.max_rows_per_task
    assert all(a.hi < b.lo for a, b in zip(groups, groups[1:]))


def test_result_does_not_depend_on_layout(spark):
    pings = read_events_view(spark, SF)
    plain = clean.clean_pings(pings).df
    mixed = clean.clean_pings(pings.repartition(7).orderBy(F.rand(3)), SMALL).df.select(plain.columns)
    key = lambda rows: {r.seq: r.speed for r in rows}
    a, b = key(plain.collect()), key(mixed.collect())
    assert a.keys() == b.keys()
    assert all(math.isclose(a[k], b[k], rel_tol=1e-12) for k in a)
