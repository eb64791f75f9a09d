"""Named queries over the driver's tables: one or more per operator."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, StructType

from tripweave.functions.geo import equirect_km
from tripweave.operators import clean, hotspots, quality, spatial, temporal, trips
from tripweave.operators.sample import scatter
from tripweave.operators.sequence import Sequence, sequence
from tripweave.functions.clock import format_seconds
from tripweave.plans import board, days, pipeline
from tripweave.plans.marts import Marts
from tripweave.session import cut, scratch_path, settings
from tripweave.sources import files, sinks
from tripweave.schemas import LIVE_PING
from tripweave.sources.events_view import read_events_view, stream_events_view, with_timestamps
from tripweave.streaming import delta, keyed, live

Query = Callable[[SparkSession, str], DataFrame]


def _round(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[
        F.round(f.name, digits).alias(f.name) if isinstance(f.dataType, DoubleType) else F.col(f.name)
        for f in df.schema
    ])


def _pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_events_view(spark, sf_dir)


def _trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips.trips_from_pings(_pings(spark, sf_dir))


def _kept_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixed once, for queries that go over the trips several times."""
    return cut(_trips(spark, sf_dir))


def _changes(spark: SparkSession, sf_dir: str) -> Sequence:
    pings = _pings(spark, sf_dir)
    return trips.status_changes(clean.drop_speedless(sequence(clean.filter_box(pings), source=pings)))


def _of_pings(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: _round(build(_pings(spark, sf_dir)))


def _of_trips(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: _round(build(_trips(spark, sf_dir)))


def _of_kept_trips(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: _round(build(_kept_trips(spark, sf_dir)))


def _of_marts(build: Callable[[Marts], DataFrame]) -> Query:
    return lambda spark, sf_dir: _round(build(Marts(_trips(spark, sf_dir))))


def _of_kept_marts(build: Callable[[Marts], DataFrame]) -> Query:
    return lambda spark, sf_dir: _round(build(Marts(_kept_trips(spark, sf_dir))))


def _of_od(build: Callable[[DataFrame], DataFrame]) -> Query:
    return _of_trips(lambda t: build(spatial.od_matrix(t)))


def _no_date(df: DataFrame) -> DataFrame:
    return df.drop("service_date")


def _speeds(method: str) -> Query:
    return _of_pings(lambda g: clean.clean_pings(g, fill=method).df.select("seq", "vehicle_id", "speed"))


def _fifo(spark: SparkSession, sf_dir: str) -> DataFrame:
    pings = read_events_view(spark, sf_dir, foreign=True)
    return _round(_no_date(trips.raw_trips(pings, strict=False)))


def _midnight(t: DataFrame) -> DataFrame:
    late = lambda c: ((F.col(c) + 43_200) % 86_400).alias(c)
    shifted = t.select(*[late(c) if c in ("s_sec", "e_sec") else c for c in trips.RAW_COLUMNS])
    return _no_date(trips.clean_trips(shifted))


def _joined(values) -> F.Column:  # noqa: ANN001
    return F.array_join(values, ",")


def _peaks(t: DataFrame) -> DataFrame:
    p = temporal.peak_hours(temporal.hourly_counts(t))
    lists = ("peak_hours", "morning_peak", "evening_peak")
    return p.withColumns({c: _joined(F.col(c).cast("array<string>")) for c in lists})


def _labels(t: DataFrame) -> DataFrame:
    points = t.select(F.lit("start").alias("kind"), F.col("trip_id").alias("id"), F.col("s_lng").alias("lng"), F.col("s_lat").alias("lat"))
    return hotspots.cluster_points(points).select("id", F.col("cluster_id").cast("int").alias("cluster_id"))


def _hotspots(kind: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = _round(hotspots.find_hotspots(_trips(spark, sf_dir), kind))
        return found.withColumns({c: F.round(c, 4) for c in ("radius_m", "radius_true_m")})

    return run


def _net_top(t: DataFrame) -> DataFrame:
    return spatial.net_flow_extremes(spatial.net_flow(t))


def _cells(column: str) -> Query:
    return _of_trips(lambda t: spatial.top_cells(spatial.net_flow(t), column).select("grid_id", "outflow", "inflow"))


def _of_cache(build: Callable[[DataFrame], DataFrame]) -> Query:
    return _of_kept_marts(lambda m: build(m.cache_rows()))


def _facts(section: str, df: DataFrame, label: F.Column, *values: str) -> DataFrame:
    """Rows of a document as section, label and up to five numbers."""
    numbers = [F.col(v).cast("double") for v in values] + [F.lit(None).cast("double")] * (5 - len(values))
    return df.select(F.lit(section).alias("section"), label.alias("label"), *[n.alias(c) for n, c in zip(numbers, "abcde")])


_KPIS = ("total_trips", "total_vehicles", "avg_duration", "avg_distance", "avg_speed")


def _cache_facts(cache: DataFrame) -> DataFrame:
    """Everything the cache holds, through the reader of each document."""
    rows = cut(cache)
    return _facts("kpis", board.read_kpis(rows), F.lit("all"), *_KPIS).unionByName(
        _facts("heatmap", board.read_heatmap(rows), F.lit(""), "lat", "lng", "count")
    ).unionByName(_facts("ranking", board.read_ranking(rows), F.col("name"), "rank", "lng", "lat", "count")).unionByName(
        _facts("trend", board.read_trend(rows), F.col("hours"), "trips", "speeds", "distances")
    ).unionByName(_facts("periods", board.read_periods(rows), F.col("label"), "trips")).unionByName(
        _facts("hourly", board.read_hourly(rows), F.col("hour"), "trips")
    )


def _dashboard(cache: DataFrame) -> DataFrame:
    """The same facts out of the one row that holds everything."""
    row = cut(board.read_dashboard(cache))
    trend = row.select("trend.*").select(F.inline(F.arrays_zip("hours", "trips", "speeds", "distances")))
    return _facts("kpis", row.select("kpis.*"), F.lit("all"), *_KPIS).unionByName(
        _facts("heatmap", row.select(F.inline("heatmap")), F.lit(""), "lat", "lng", "count")
    ).unionByName(_facts("ranking", row.select(F.inline("ranking")), F.col("name"), "rank", "lng", "lat", "count")).unionByName(
        _facts("trend", trend, F.col("hours"), "trips", "speeds", "distances")
    ).unionByName(_facts("periods", row.select(F.inline("periods")), F.col("stat_key"), "trips")).unionByName(
        _facts("hourly", row.select(F.inline("hourly")), F.col("stat_key"), "trips")
    )


def _listed_peaks(df: DataFrame) -> DataFrame:
    return df.withColumns({c: _joined(F.col(c).cast("array<string>")) for c in ("morning_peak", "evening_peak")})


def _csv_pings(pings: DataFrame, damage: bool = False) -> str:
    """The pings as CSV files under a scratch folder, each third with its columns in another order."""
    out = scratch_path(pings.sparkSession, "csv-pings")
    cell = lambda c, n, text: F.when(F.col("seq") % n == 0, text).otherwise(F.col(c).cast("string")) if damage else F.col(c)
    text = pings.select(
        cell("vehicle_id", 13, "cab").alias("VehicleNum"), format_seconds(F.col("sec_of_day")).alias("Stime"),
        cell("lng", 11, "east").alias("Lng"), F.col("lat").alias("Lat"), cell("open_status", 7, "5").alias("OpenStatus"),
        F.col("speed").alias("Speed"), *(["seq"] if damage else [F.col("seq").alias("row_id")]),
    )
    key = "seq" if damage else "row_id"
    for k, order in enumerate((text.columns, text.columns[::-1], [*text.columns[2:], *text.columns[:2]])):
        sinks.write_csv(text.where(F.col(key) % 3 == k).select(*order), f"{out}/part={k}")
    return f"{out}/*"


def _read_csv_pings(pings: DataFrame) -> DataFrame:
    good, _ = files.read_pings(pings.sparkSession, _csv_pings(pings), "2024-01-01")
    return good.drop("seq", "service_date")


def _csv_rejects(pings: DataFrame) -> DataFrame:
    return files.read_pings(pings.sparkSession, _csv_pings(pings, damage=True), "2024-01-01")[1].select("seq", "reject_reason")


def _csv_trips(t: DataFrame) -> DataFrame:
    out = scratch_path(t.sparkSession, "csv-trips")
    pipeline.export_trips(t, out)
    return _no_date(files.read_trips(t.sparkSession, out, "2024-01-01")[0].drop("trip_id"))


def _two_days(pings: DataFrame) -> DataFrame:
    """Two days ingested one after the other into one store, the second one twice."""
    spark, store = pings.sparkSession, scratch_path(pings.sparkSession, "two-days")
    for day, part in (("2024-01-01", 0), ("2024-01-02", 1), ("2024-01-02", 1)):
        pipeline.ingest(spark, _csv_pings(pings.where(F.col("seq") % 2 == part)), store, day)
    return pipeline.stored_pings(spark, store).select(
        F.date_format("service_date", "yyyy-MM-dd").alias("day"), "vehicle_id", "sec_of_day", "lng", "lat", "open_status", "speed"
    )


def _over_midnight(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two days, the first at first without half of its pings and cleaned again, whole, which repairs the second."""
    store = scratch_path(spark, "over-midnight")
    later = F.lit("2024-01-01").cast("date") + (F.col("seq") % 2).cast("int")
    pings = cut(_pings(spark, sf_dir).withColumn("service_date", later))
    first, second = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    days.clean_from(spark, store, first, pings.where((F.col("service_date") == F.lit(second)) | (F.col("seq") % 4 == 0)))
    days.clean_from(spark, store, first, pings)
    found = days.day_trips(spark, store).withColumn("day", F.date_format("service_date", "yyyy-MM-dd")).drop("service_date")
    still = days.open_trips(spark, store).select(F.col("seq").alias("trip_id"), "vehicle_id", F.lit("open").alias("day"))
    return _round(found.unionByName(still, allowMissingColumns=True))


def _csv_mixed(pings: DataFrame) -> DataFrame:
    """Files of two encodings in one folder, each found by itself; every seventh line has a cell too many."""
    out = scratch_path(pings.sparkSession, "csv-mixed")
    note = F.when(F.col("seq") % 7 == 0, "坏,行").otherwise(F.concat(F.lit("出租车"), F.col("vehicle_id")))
    text = pings.select(
        F.col("vehicle_id").alias("VehicleNum"), format_seconds(F.col("sec_of_day")).alias("Stime"), F.col("lng").alias("Lng"),
        F.col("lat").alias("Lat"), F.col("open_status").alias("OpenStatus"), F.col("speed").alias("Speed"), note.alias("备注"), F.col("seq").alias("no"),
    )
    with settings(pings.sparkSession, {"spark.sql.legacy.javaCharsets": "true", "spark.sql.legacy.codingErrorAction": "true"}):
        for k, encoding in enumerate(("UTF-8", "GB18030")):
            part = text.where(F.col("no") % 2 == k)
            part.write.option("header", True).option("encoding", encoding).option("quote", "\u0000").csv(f"{out}/part={k}")
    raw = files.read_text_table(pings.sparkSession, f"{out}/*", files.PING_NAMES, "auto")
    return raw.select(
        F.when(F.col("_bad").isNull(), F.col("VehicleNum")).alias("vehicle"), F.when(F.col("_bad").isNull(), F.col("备注")).alias("note"),
        F.col("_bad").alias("reason"), F.when(F.col("_bad").isNotNull(), F.element_at(F.split("_line", ","), -1)).alias("bad_no"),
    )


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _board_set(m: Marts) -> DataFrame:
    """The whole board set as facts."""
    s, text = m.board_set(), lambda c: F.col(c).cast("string")
    bins = [_facts(n, s[n], F.col("label"), "n", "share_pct") for n in ("duration", "distance", "speed")]
    return _union([
        _facts("kpis", s["kpis"], F.lit("all"), "total_trips", "total_vehicles", "avg_duration", "peak_hour", "peak_trips"),
        _facts("hourly", s["hourly"], F.col("label"), "trip_count"), *bins, _facts("period", s["period"], F.col("period_name"), "ratio_pct"),
        _facts("hotspots", s["hotspots"], F.col("label"), "cluster_id", "trip_count"),
        _facts("distance_summary", s["distance_summary"], F.lit(""), "mean", "median", "short_ratio", "long_ratio"),
        _facts("speed_summary", s["speed_summary"], F.lit(""), "mean", "median", "total", "mean_bin"),
        _facts("vehicles", s["vehicles"], text("vehicle_id"), "trip_count", "total_duration", "total_distance", "avg_duration", "avg_distance"),
        _facts("flow_nodes", s["flow_nodes"], F.col("name"), "lng", "lat"),
        _facts("flow_edges", s["flow_edges"], F.concat_ws(">", "source", "target"), "value"),
        _facts("net_flow", s["net_flow"], F.concat_ws(" ", "direction", "label"), "order_no", "grid_id", "net_flow"),
    ])


def _analysed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All result tables built, published as one set and read back."""
    target = scratch_path(spark, "analysed")
    pipeline.analyse(_kept_trips(spark, sf_dir), target, 1)
    t, text = lambda name: sinks.read_published(spark, target, name), lambda *c: F.concat_ws(" ", *c)
    return _round(_union([
        _facts("od_trips", t("od_trips"), text("VehicleNum", "Stime", "Etime", "trip_id"), "SLng", "ELat", "duration_min", "distance_km", "avg_speed"),
        _facts("hourly_stats", t("hourly_stats"), text("hour"), "trip_count", "avg_duration", "median_duration", "avg_distance", "unique_vehicles"),
        _facts("period_stats", t("period_stats"), text("period_name", "time_range"), "trip_count", "ratio_pct", "avg_duration", "avg_distance", "active_vehicles"),
        _facts("hotspots", t("hotspots"), text("point_type", "cluster_id"), "center_lng", "center_lat", "trip_count"),
        _facts("vehicle_efficiency", t("vehicle_efficiency"), text("VehicleNum", "first_trip", "last_trip"),
               "trip_count", "total_duration", "total_distance", "avg_duration", "avg_distance"),
        _facts("net_flow", t("net_flow"), text("grid_id"), "lng", "lat", "outflow", "inflow", "net_flow"),
        _facts("realtime_stats", t("realtime_stats").where("stat_value IS NOT NULL"), text("stat_type", "stat_key"), "stat_value"),
    ]))


def _merged(name: str, build: Callable[[DataFrame], DataFrame], newer: str) -> Query:
    """A result table of the trips before noon, updated by the rows of all trips that ``newer`` names."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        t, target = _kept_trips(spark, sf_dir), scratch_path(spark, name)
        sinks.publish({name: build(t.where("hour < 12"))}, target, 1)
        sinks.publish_merged({name: build(t).where(newer)}, target, 2)
        return _round(sinks.read_published(spark, target, name))

    return run


def _vehicle_rows(t: DataFrame) -> DataFrame:
    return temporal.vehicle_efficiency(t).withColumnRenamed("vehicle_id", "VehicleNum")


def _published(m: Marts) -> DataFrame:
    """A result table written, announced and read back under its declared schema."""
    target = scratch_path(m.trips.sparkSession, "published")
    sinks.publish({"net_flow": spatial.net_flow(m.trips)}, target, 1)
    return sinks.read_published(m.trips.sparkSession, target, "net_flow")


def _live_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third ping is sent again in a later batch, one batch is replayed, and the day is closed."""
    target, pings = scratch_path(spark, "live-repeats"), cut(with_timestamps(_pings(spark, sf_dir)).select(*LIVE_PING.names))
    early = F.col("ts") < F.lit("2024-01-01 12:00:00").cast("timestamp")
    again = pings.where(early & (F.col("seq") % 3 == 0))
    for i, batch in enumerate((pings.where(early), pings.where(~early).unionByName(again))):
        for _ in range(1 + i):
            live.settle(batch, i, target)
    live.close(spark, target)
    return _round(live.settled_trips(spark, target).drop("service_date", "s_ts", "e_ts"))


def _cache_scalars(t: DataFrame) -> DataFrame:
    return board.scalar_rows(t).select("stat_type", "stat_key", "stat_value")


def _cache_upsert(t: DataFrame) -> DataFrame:
    stamp = lambda text: F.lit(text).cast("timestamp")
    old = board.scalar_rows(t.where("hour < 12")).withColumn("updated_at", stamp("2024-01-01 12:00:00"))
    new = board.scalar_rows(t).where("stat_type = 'hourly_trips' AND stat_key >= '12:00'").withColumn(
        "updated_at", stamp("2024-01-02 00:00:00")
    )
    merged = sinks.merge_latest(old, new, ["stat_type", "stat_key"])
    return merged.select("stat_type", "stat_key", "stat_value")


def _quarantine(t: DataFrame) -> DataFrame:
    """Trips written as text with damaged cells, read back through the parser."""
    text = sinks.od_columns(t).select(
        F.when(F.col("trip_id") % 13 == 0, "cab").otherwise(F.col("VehicleNum").cast("string")).alias("VehicleNum"),
        F.when(F.col("trip_id") % 11 == 0, "xx").otherwise(F.col("Stime")).alias("Stime"),
        F.when(F.col("trip_id") % 7 == 0, "east").otherwise(F.col("SLng").cast("string")).alias("SLng"),
        *[F.col(c).cast("string").alias(c) for c in ("SLat", "ELng", "ELat", "Etime")],
        F.col("trip_id").alias("seq"),
    )
    return files.rejected(files.parse_trips(text)).select("seq", "reject_reason")


def _run(query) -> None:  # noqa: ANN001
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


_LATER = dt.datetime(2024, 1, 4)


def _closing(spark: SparkSession, schema: StructType, values: dict) -> DataFrame:
    """A stream of one record two days on, which moves the watermark past all others."""
    path = scratch_path(spark, "closing")
    row = spark.createDataFrame([tuple(values.get(c) for c in schema.names)], schema)
    row.write.parquet(path)
    return spark.readStream.schema(schema).parquet(path)


def _live_table(spark: SparkSession, sf_dir: str) -> str:
    out = scratch_path(spark, "live-trips")
    closing = _closing(spark, LIVE_PING, {"seq": -1, "vehicle_id": -1, "ts": _LATER, "lng": 114.0, "lat": 22.6, "open_status": 1})
    pings = live.watermarked(stream_events_view(spark, sf_dir).select(*LIVE_PING.names).union(closing))
    assembled = live.assemble(live.drop_repeats(pings))
    _run(live.start_trips(assembled, f"{out}/table", f"{out}/checkpoint", once=True))
    return f"{out}/table"


def _live_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(_live_table(spark, sf_dir))
    return _round(table.drop("service_date", "s_ts", "e_ts"))


def _live_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyed state; every third ping is sent again in a file of its own."""
    out = scratch_path(spark, "live-keyed")
    pings = with_timestamps(_pings(spark, sf_dir)).select(*LIVE_PING.names)
    pings.where(F.col("seq") % 3 == 0).write.parquet(f"{out}/again")
    again = spark.readStream.schema(LIVE_PING).parquet(f"{out}/again")
    closing = _closing(spark, LIVE_PING, {"seq": -1, "vehicle_id": -1, "ts": _LATER, "lng": 114.0, "lat": 22.6, "open_status": 1})
    stream = stream_events_view(spark, sf_dir).select(*LIVE_PING.names).union(again).union(closing)
    with keyed.state_store(spark):
        _run(live.start_trips(keyed.assemble_keyed(live.watermarked(stream)), f"{out}/table", f"{out}/checkpoint", once=True))
    return _round(spark.read.parquet(f"{out}/table").drop("service_date", "s_ts", "e_ts"))


def _live_settled(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "live-settled")
    _run(live.start_settling(stream_events_view(spark, sf_dir), f"{out}/table", f"{out}/checkpoint", once=True))
    live.close(spark, f"{out}/table")
    return _round(live.settled_trips(spark, f"{out}/table").drop("service_date", "s_ts", "e_ts"))


def _trip_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _live_table(spark, sf_dir)
    return spark.readStream.schema(spark.read.parquet(table).schema).parquet(table)


def _live_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "live-board")
    _run(live.start_board(_trip_stream(spark, sf_dir), f"{out}/board", f"{out}/checkpoint", once=True))
    info = F.from_json("extra_info", "avg_speed double, avg_distance double")
    return _round(live.board(spark, f"{out}/board").select("stat_key", "stat_value", info.alias("i")).select("stat_key", "stat_value", "i.*"))


def _live_board(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "live-whole-board")
    _run(live.start_whole_board(
        stream_events_view(spark, sf_dir), f"{out}/trips", f"{out}/board", f"{out}/checkpoint", once=True
    ))
    live.close(spark, f"{out}/trips")
    version = sinks.published_version(spark, f"{out}/trips")
    live.refresh_whole_board(spark, f"{out}/trips", f"{out}/board", version)
    return _round(_cache_facts(live.board(spark, f"{out}/board")))


def _live_delta_board(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches and what is left at the day's end, merged one after the other, with the ranking."""
    out = scratch_path(spark, "live-delta-board")
    pings = cut(with_timestamps(_pings(spark, sf_dir)).select(*LIVE_PING.names))
    half = F.floor(F.unix_seconds("ts") % 86_400 / 43_200)
    for i in range(2):
        live.settle(pings.where(half == i), i, f"{out}/trips")
        delta.refresh(spark, f"{out}/trips", f"{out}/board", i)
    live.close(spark, f"{out}/trips")
    delta.refresh(spark, f"{out}/trips", f"{out}/board", 2)
    return _round(_cache_facts(live.board(spark, f"{out}/board")))


def _live_heat(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "live-heat")
    trips_in = _trip_stream(spark, sf_dir)
    closing = _closing(spark, trips_in.schema, {"s_ts": _LATER, "s_lng": 114.0, "s_lat": 22.6})
    heat = live.rolling_heat(trips_in.union(closing)).writeStream.outputMode("append")
    _run(
        heat.option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True)
        .format("parquet").start(f"{out}/table")
    )
    return _round(spark.read.parquet(f"{out}/table")).withColumn(
        "window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm")
    )


def queries() -> dict[str, Query]:
    return {
        # cleaning
        "ping_box_filter": _of_pings(lambda g: _no_date(clean.filter_box(g))),
        "speed_marked": _of_pings(lambda g: clean.mark_speed(clean.filter_box(g)).select("seq", "vehicle_id", "speed")),
        "speed_linear": _speeds("linear"),
        "speed_ffill": _speeds("ffill"),
        # trips
        "status_changes": lambda spark, d: _changes(spark, d).df.select(
            "seq", "vehicle_id", "sec_of_day", "prev_status", "open_status", "change"
        ),
        "trips_raw": _of_pings(lambda g: _no_date(trips.raw_trips(g))),
        "trips_fifo": _fifo,
        "trips_unclosed": lambda spark, d: trips.unclosed_trips(_changes(spark, d)),
        "trips_valid": _of_trips(_no_date),
        "trips_equirect": _of_pings(lambda g: trips.raw_trips(g).select(
            "trip_id", equirect_km(*[F.col(c) for c in ("s_lng", "s_lat", "e_lng", "e_lat")]).alias("distance_km")
        )),
        "od_midnight": _of_pings(lambda g: _midnight(trips.raw_trips(g))),
        "od_export": _of_trips(sinks.od_columns),
        "rule5_rejects": _of_pings(lambda g: trips.rule5_rejects(trips.measure(trips.raw_trips(g)))),
        "reject_counts": _of_pings(lambda g: quality.reject_counts(trips.measure(trips.raw_trips(g)))),
        "quarantine_rows": _of_trips(_quarantine),
        # quality
        "clean_funnel": _of_pings(quality.cleaning_funnel),
        "quality_profile": _of_pings(quality.quality_profile),
        "quality_nulls": _of_pings(quality.null_profile),
        "speed_segments": _of_pings(quality.speed_segments),
        # time
        "hourly_stats": _of_trips(temporal.hourly_stats),
        "hourly_counts": _of_trips(temporal.hourly_counts),
        "hourly_trend": _of_trips(temporal.hourly_trend),
        "hourly_reference_lines": _of_marts(Marts.reference_lines),
        "peak_hours": _of_trips(_peaks),
        "period_stats": _of_trips(temporal.period_stats),
        "duration_stats": _of_trips(temporal.duration_stats),
        "distance_stats": _of_kept_trips(temporal.distance_stats),
        "duration_hist": _of_trips(temporal.duration_histogram),
        "distance_hist": _of_trips(temporal.distance_histogram),
        "speed_hist": _of_trips(temporal.speed_histogram),
        "speed_stats": _of_kept_trips(temporal.speed_stats),
        "vehicle_efficiency": _of_trips(temporal.vehicle_efficiency),
        "vehicle_top15": _of_trips(lambda t: temporal.top_vehicles(temporal.vehicle_efficiency(t))),
        "kpis": _of_marts(Marts.kpis),
        "live_kpis": _of_trips(board.live_kpis),
        "trips_per_vehicle": _of_trips(lambda t: temporal.kpis(t).select("total_trips", "total_vehicles", "trips_per_vehicle")),
        "dur_dist_corr": _of_trips(temporal.duration_distance_correlation),
        "scatter_sample": _of_kept_trips(lambda t: scatter(t, 500)),
        # space
        "density_start": _of_trips(spatial.density),
        "density_end": _of_trips(lambda t: spatial.density(t, "end")),
        "density_both": _of_trips(lambda t: spatial.density(t, "both")),
        "density_by_period": _of_trips(spatial.density_by_period),
        "heat_top500": _of_trips(spatial.heat_points),
        "od_matrix": _of_od(lambda od: od),
        "od_summary": _of_od(spatial.od_summary),
        "od_top30": _of_od(lambda od: spatial.top_od_pairs(od, 30)),
        "od_net_edges": _of_od(spatial.flow_edges),
        "od_net_edges_all": _of_od(lambda od: spatial.flow_edges(od, before_topk=True)),
        "od_nodes": _of_od(lambda od: spatial.flow_nodes(spatial.flow_edges(od))),
        "net_flow": _of_trips(spatial.net_flow),
        "net_flow_dense": _of_trips(lambda t: spatial.net_flow(t, dense=True)),
        "net_flow_top15": _of_trips(_net_top),
        "top_cells_outflow": _cells("outflow"),
        "top_cells_inflow": _cells("inflow"),
        # hotspots
        "hotspots_start": _hotspots("start"),
        "hotspots_end": _hotspots("end"),
        "hotspot_labels": _of_kept_trips(_labels),
        "hotspot_ranking": _of_trips(lambda t: hotspots.hotspot_ranking(hotspots.find_hotspots(t))),
        "hotspots_both": _of_kept_marts(lambda m: m.hotspots.withColumns({c: F.round(c, 4) for c in ("radius_m", "radius_true_m")})),
        "hotspot_bars": _of_kept_marts(Marts.hotspot_bars),
        # board and report
        "report_fields": _of_kept_marts(lambda m: _listed_peaks(m.report_fields())),
        "report_figures": _of_kept_marts(Marts.report_figures),
        "board_set": _of_kept_marts(_board_set),
        "vehicle_bars": _of_kept_marts(Marts.top_vehicles),
        "space_summary": _of_kept_marts(Marts.space_summary),
        "trips_derived": _of_pings(lambda g: _no_date(temporal.with_derived(trips.raw_trips(g)))),
        "hourly_board": _of_marts(Marts.hourly),
        "period_shares": _of_marts(Marts.period_shares),
        "distance_summary": _of_kept_marts(Marts.distance_summary),
        "speed_summary": _of_kept_marts(Marts.speed_summary),
        "time_summary": _of_kept_marts(lambda m: _listed_peaks(m.time_summary())),
        "cache_rows": _of_cache(_cache_facts),
        "cache_kpis": _of_cache(board.read_kpis),
        "cache_heatmap": _of_cache(board.read_heatmap),
        "cache_trend": _of_cache(board.read_trend),
        "cache_periods": _of_cache(board.read_periods),
        "cache_hourly": _of_cache(board.read_hourly),
        "cache_ranking": _of_cache(board.read_ranking),
        "board_dashboard": _of_cache(_dashboard),
        "cache_scalars": _of_kept_trips(_cache_scalars),
        "cache_upsert": _of_kept_trips(_cache_upsert),
        # files and stored tables
        "csv_pings": _of_pings(_read_csv_pings),
        "csv_quarantine": _of_pings(_csv_rejects),
        "csv_trips": _of_trips(_csv_trips),
        "csv_mixed": _of_pings(_csv_mixed),
        "trips_over_midnight": _over_midnight,
        "two_day_store": _of_pings(_two_days),
        "hourly_merge": _merged("hourly_stats", temporal.hourly_stats, "hour >= 9"),
        "period_merge": _merged("period_stats", temporal.period_stats, "period_name <> '早高峰'"),
        "vehicle_merge": _merged("vehicle_efficiency", _vehicle_rows, "VehicleNum % 2 = 0"),
        "hotspot_merge": lambda spark, d: _merged("hotspots", hotspots.find_hotspots, "cluster_id % 2 = 0")(spark, d).withColumns(
            {c: F.round(c, 4) for c in ("radius_m", "radius_true_m")}
        ),
        "published_table": _of_marts(_published),
        "analysed_tables": _analysed,
        # streams
        "live_trips": _live_trips,
        "live_keyed": _live_keyed,
        "live_settled": _live_settled,
        "live_repeats": _live_repeats,
        "live_hourly": _live_hourly,
        "live_heat": _live_heat,
        "live_board": _live_board,
        "live_delta_board": _live_delta_board,
    }
