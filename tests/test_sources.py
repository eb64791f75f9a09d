import pytest
from pyspark.sql import functions as F

from tripweave.functions.clock import format_seconds, hour_label, parse_seconds
from tripweave.operators.trips import trips_from_pings
from tripweave.plans import pipeline
from tripweave.plans.marts import Marts
from tripweave.schemas import PING, RESULT_TABLES
from tripweave.sources import files, sinks
from tripweave.sources.events_view import read_events_view

from .conftest import SF

HEAD = "VehicleNum, Stime, Lng,Lat ,OpenStatus,Speed"
LINES = [
    "22223,22:54:04,114.167000,22.718399,0,0", "22223,7:05:00,114.1,22.7,1,12.5", "22223,xx,114.1,22.7,1,3",
    "cab,07:00:00,114.1,22.7,1,3", "22224,07:00:00,east,22.7,1,3", "22224,07:00:01,114.1,22.7,2,3",
    "22224,07:00:02,114.1,22.7,1,fast", "22224,07:00:03,,22.7,0,", "22224,25:00:00,114.1,22.7,0,1",
]


def _write(path, text, encoding="utf-8"):
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_clock(spark):
    df = spark.createDataFrame([("7:05:00",), ("07:05:00",), (" 23:59:59 ",), ("xx",), ("24:00:00",), ("7:5",), (None,)], "t string")
    assert [r[0] for r in df.select(parse_seconds(F.col("t"))).collect()] == [25500, 25500, 86399, None, None, None, None]
    r = spark.range(1).select(format_seconds(F.lit(25500)), hour_label(F.lit(7))).first()
    assert tuple(r) == ("07:05:00", "07:00")


def test_csv_with_blanks_in_header_and_bad_rows(spark, tmp_path):
    path = _write(tmp_path / "a.csv", "\n".join([HEAD, *LINES]) + "\n", "utf-8-sig")
    pings, bad = files.read_pings(spark, path, "2024-01-01")
    rows = pings.orderBy("seq").collect()
    assert pings.columns == PING.names
    assert [(r.vehicle_id, r.sec_of_day, r.lng, r.open_status, r.speed) for r in rows] == [
        (22223, 82444, 114.167, 0, 0.0), (22223, 25500, 114.1, 1, 12.5), (22224, 25203, None, 0, None),
    ]
    reasons = [r.reject_reason for r in bad.orderBy("seq").collect()]
    assert reasons == ["bad_time", "bad_vehicle", "bad_coordinate", "bad_status", "bad_speed", "bad_time"]
    assert '"Lng":"east"' in bad.where("reject_reason = 'bad_coordinate'").first().row_text


def test_wrong_column_count_is_quarantined(spark, tmp_path):
    path = _write(tmp_path / "a.csv", "\n".join([HEAD, LINES[0], LINES[1] + ",9,9"]) + "\n")
    pings, bad = files.read_pings(spark, path, "2024-01-01")
    assert pings.count() == 1
    assert [r.reject_reason for r in bad.collect()] == ["corrupt_line"]


def test_encoding_is_the_one_given_and_strict(spark, tmp_path):
    text = "\n".join([HEAD + ",备注", *[line + ",出租车" for line in LINES[:2]]]) + "\n"
    path = _write(tmp_path / "a.csv", text, "gb18030")
    before = spark.conf.get("spark.sql.legacy.javaCharsets")
    raw = files.read_text_table(spark, path, files.PING_NAMES, "GB18030")
    assert spark.conf.get("spark.sql.legacy.javaCharsets") == before
    assert [r["备注"] for r in raw.collect()] == ["出租车"] * 2
    assert files.read_pings(spark, path, "2024-01-01", "GB18030")[0].count() == 2


def test_late_line_of_another_encoding_is_quarantined(spark, tmp_path):
    lines = "\n".join([HEAD + ",note", *[LINES[0] + ",x"] * 6]).encode() + b"\n" + (LINES[1] + ",出租车").encode("gb18030") + b"\n"
    path = tmp_path / "a.csv"
    path.write_bytes(lines)
    pings, bad = files.read_pings(spark, str(path), "2024-01-01")
    assert pings.count() == 6 and [r.reject_reason for r in bad.collect()] == ["bad_encoding"]
    assert bytes.fromhex(bad.first().row_text) == (LINES[1] + ",出租车").encode("gb18030")
    mixed = tmp_path / "b.csv"
    mixed.write_bytes((HEAD + "\n" + LINES[0] + "\n").encode("gb18030") + LINES[1].encode() + b"\xff\xff\n")
    pings, bad = files.read_pings(spark, str(mixed), "2024-01-01", "GB18030")
    assert pings.count() == 1 and [r.reject_reason for r in bad.collect()] == ["bad_encoding"]


def test_columns_are_taken_by_name_in_each_file(spark, tmp_path):
    (tmp_path / "in").mkdir()
    _write(tmp_path / "in" / "a.csv", "VehicleNum,Stime,Lng,Lat,OpenStatus,Speed\n1,07:00:00,114.0,22.6,1,5\n")
    _write(tmp_path / "in" / "b.csv", "VehicleNum,Stime,Lat,Lng,OpenStatus,Speed\n2,07:00:00,22.6,114.0,1,5\n")
    _write(tmp_path / "in" / "c.csv", "3,07:00:00,22.6,114.0,1,5\n")
    pings, bad = files.read_pings(spark, str(tmp_path / "in"), "2024-01-01")
    assert [(r.vehicle_id, r.lng, r.lat) for r in pings.orderBy("seq").collect()] == [(1, 114.0, 22.6), (2, 114.0, 22.6)]
    assert [r.reject_reason for r in bad.collect()] == ["no_header"]


def test_row_numbers_of_many_files_differ(spark):
    n = (1 << 20) + 7
    rows = spark.range(n).select(files.row_number_of(F.col("id"), F.lit(5)).alias("a"), files.row_number_of(F.col("id"), F.lit((1 << 40) - 1)).alias("b"))
    assert rows.agg(F.countDistinct("a")).first()[0] == n and rows.where("b < a or a < 0").count() == 0


def test_days_stay_in_the_store(spark, tmp_path):
    for day, vehicle in (("2024-01-01", 1), ("2024-01-02", 2)):
        path = _write(tmp_path / f"{day}.csv", f"{HEAD}\n{vehicle},07:00:00,114.1,22.7,1,3\nx,07:00:00,114.1,22.7,1,3\n")
        pipeline.ingest(spark, path, str(tmp_path / "store"), day)
    stored = pipeline.stored_pings(spark, str(tmp_path / "store"))
    assert sorted((r.vehicle_id, str(r.service_date)) for r in stored.collect()) == [(1, "2024-01-01"), (2, "2024-01-02")]
    assert pipeline.stored_rejects(spark, str(tmp_path / "store")).count() == 2
    pipeline.ingest(spark, path, str(tmp_path / "store"), "2024-01-02")  # a day again replaces that day
    assert pipeline.stored_pings(spark, str(tmp_path / "store")).count() == 2


def test_seq_follows_the_file_however_it_is_split(spark, tmp_path):
    lines = [f"{i % 7},00:00:00,114.1,22.7,{i % 2},{i % 100}" for i in range(3000)]
    path = _write(tmp_path / "a.csv", "\n".join([HEAD, *lines]) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    want = None
    try:
        for size in (before, "10000", "7001"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            pings, _ = files.read_pings(spark, path, "2024-01-01")
            got = [(r.vehicle_id, r.speed) for r in pings.orderBy("seq").collect()]
            assert pings.select("seq").distinct().count() == 3000
            want = want or got
            assert got == want == [(i % 7, float(i % 100)) for i in range(3000)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_date_is_required(spark, tmp_path):
    path = _write(tmp_path / "a.csv", "\n".join([HEAD, LINES[0]]) + "\n")
    with pytest.raises(ValueError, match="service_date"):
        files.read_pings(spark, path)


def test_pipeline_round_trip(spark, tmp_path):
    pings = read_events_view(spark, SF)
    text = pings.select(
        F.col("vehicle_id").alias("VehicleNum"), format_seconds(F.col("sec_of_day")).alias("Stime"), F.col("lng").alias("Lng"),
        F.col("lat").alias("Lat"), F.col("open_status").alias("OpenStatus"), F.col("speed").alias("Speed"), "seq",
    )
    sinks.write_csv(text, str(tmp_path / "raw"))
    stored = pipeline.ingest(spark, str(tmp_path / "raw"), str(tmp_path / "in"), "2024-01-01", "utf-8")
    trips = pipeline.clean(stored, str(tmp_path / "work"))
    want = trips_from_pings(pings)
    assert {r.trip_id for r in trips.collect()} == {r.trip_id for r in want.collect()}
    pipeline.export_trips(trips, str(tmp_path / "od"))
    again = pipeline.clean_od(spark, str(tmp_path / "od"), str(tmp_path / "again"), "2024-01-01")
    assert again.count() == want.count() == 167
    assert again.agg(F.sum("duration_s")).first() == want.agg(F.sum("duration_s")).first()


def test_trip_quarantine(spark, tmp_path):
    head = "VehicleNum,Stime,SLng,SLat,ELng,ELat,Etime,duration_min,distance_km,avg_speed"
    path = _write(tmp_path / "od.csv", "\n".join([head, "1,23:50:00,114,22.5,114.1,22.6,00:10:00,20,15,45", "1,xx,114,22.5,114.1,22.6,00:10:00,20,15,45", "1,07:00:00,,22.5,114.1,22.6,00:10:00,20,15,45"]) + "\n")
    good, bad = files.read_trips(spark, path, "2024-01-01")
    assert good.count() == 1 and sorted(r.reject_reason for r in bad.collect()) == ["bad_coordinate", "bad_time"]


def test_schema_check_names_the_problem(spark):
    hourly = spark.createDataFrame([(1, 2)], "HOUR int, trip_count int")
    with pytest.raises(ValueError, match="trip_count is int, not bigint; avg_duration is missing"):
        sinks.check_schema(hourly, "hourly_stats")


def test_merge_latest(spark):
    cols = "k string, x int, updated_at timestamp"
    at = lambda d: __import__("datetime").datetime(2024, 1, d)
    old = spark.createDataFrame([("a", 1, at(2)), ("b", 2, at(2))], cols)
    new = spark.createDataFrame([("b", 3, at(2)), ("c", 4, at(1)), ("a", 9, at(1))], cols)
    assert sorted((r.k, r.x) for r in sinks.merge_latest(old, new, ["k"]).collect()) == [("a", 1), ("b", 3), ("c", 4)]


def test_publish_switches_versions(spark, tmp_path):
    target = str(tmp_path / "out")
    trips = trips_from_pings(read_events_view(spark, SF))
    pipeline.analyse(trips, target, 1)
    for name, (schema, key) in RESULT_TABLES.items():
        table = sinks.read_published(spark, target, name)
        assert table.columns == schema.names
        assert table.select(*key).distinct().count() == table.count()
    assert sinks.read_published(spark, target, "od_trips").count() == 167
    # a version that was written but never announced is not read
    spark.range(1).write.parquet(f"{target}/v=2/od_trips")
    assert sinks.published_version(spark, target) == 1


def test_a_reader_keeps_the_version_it_holds(spark, tmp_path):
    target = str(tmp_path / "out")
    sinks.publish({"t": spark.range(3)}, target, 1)
    held = sinks.read_published(spark, target, "t")
    sinks.publish({"t": spark.range(5)}, target, 1)
    assert held.count() == 3 and sinks.read_published(spark, target, "t").count() == 5
    assert sinks.read_all_versions(spark, target, "t").count() == 5


def test_merge_by_key_and_unique_keys(spark, tmp_path):
    target, cols = str(tmp_path / "m"), RESULT_TABLES["net_flow"][0]
    row = lambda cell, n: (cell, 114.0, 22.5, n, 0, -n)
    sinks.publish({"net_flow": spark.createDataFrame([row(1, 1), row(2, 2)], cols)}, target, 1)
    sinks.publish_merged({"net_flow": spark.createDataFrame([row(2, 5), row(3, 3)], cols)}, target, 2)
    assert {r.grid_id: r.outflow for r in sinks.read_published(spark, target, "net_flow").collect()} == {1: 1, 2: 5, 3: 3}
    with pytest.raises(ValueError, match="share a key"):
        sinks.publish_merged({"net_flow": spark.createDataFrame([row(2, 5), row(2, 6)], cols)}, target, 3)


def test_report(spark, tmp_path):
    marts = Marts(trips_from_pings(read_events_view(spark, SF)).persist())
    text = pipeline.report_text(marts)
    assert "| trips | 167 |" in text and "| pick-up hotspots | 0 |" in text
    pipeline.write_report(marts, str(tmp_path / "report"))
    assert "".join(r.value + "\n" for r in spark.read.text(str(tmp_path / "report")).collect()).strip() == text.strip()
    assert set(marts.board_set()) >= {"kpis", "hotspots", "flow_edges", "net_flow"}
    assert marts.space_summary().first().n_cells == 5656
    assert marts.time_summary().first().total_trips == 167
    for name, df in marts.board_set().items():
        assert df.columns and df.count() >= 0, name
