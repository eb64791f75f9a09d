"""The live board as Structured Streaming: pings to trips to refreshed board rows.

Trips are assembled per vehicle-day behind the watermark, so late pings fall into
place and an emitted trip never changes. The box and trip filters are the batch
functions. Live speeds are not repaired by interpolation, which needs the next
plausible value; no trip column depends on them. Batch drops the day of a vehicle
that never reports a plausible speed, which is known at the day's end only: live
trips of such a vehicle are kept.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame, GroupedData, SparkSession, functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from tripweave.functions.clock import seconds_of
from tripweave.functions.geo import cell_lat, cell_lng, center_lat, center_lng
from tripweave.operators.clean import filter_box
from tripweave.operators.sequence import KEYS, ORDER, listed, sequence
from tripweave.operators.trips import clean_trips, filter_trips, measure, pair_trips, status_changes
from tripweave.params import DEFAULTS, Params
from tripweave.plans.board import board_figures, rows_of_figures
from tripweave.schemas import LIVE_PING
from tripweave.session import cut
from tripweave.sources.sinks import (
    merge_latest, one_row, publish, published_version, read_all_versions, read_published, version_path,
)

LATENESS = "1 hour"
_DAY_US = 86_400_000_000

#: A ping as the stateful steps keep it. Their states hold arrays of these, of many vehicles, as bytes.
HELD = np.dtype([
    ("vehicle_id", np.int64), ("seq", np.int64), ("us", np.int64), ("lng", np.float64), ("lat", np.float64), ("open_status", np.int32),
])
#: What is known of a vehicle behind the watermark: its last status, and its start where one is open.
TAIL = np.dtype([
    ("vehicle_id", np.int64), ("status", np.int32), ("open", np.bool_),
    ("s_seq", np.int64), ("s_us", np.int64), ("s_lng", np.float64), ("s_lat", np.float64),
])
_START = (("s_seq", "seq"), ("s_us", "us"), ("s_lng", "lng"), ("s_lat", "lat"))
_STATE = "last_us long, tails binary, held binary"
ASSEMBLED = (
    "trip_id long, vehicle_id long, service_date date, s_us long, s_lng double, s_lat double,"
    "e_us long, e_lng double, e_lat double"
)


def read_ping_stream(spark: SparkSession, path: str, schema: StructType = LIVE_PING) -> DataFrame:
    """New parquet files of timestamped pings."""
    return spark.readStream.schema(schema).parquet(path)


def watermarked(pings: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Declares how late pings may be; once per stream, before the other steps."""
    return pings.withWatermark("ts", lateness)


def drop_repeats(pings: DataFrame) -> DataFrame:
    """Drops a ping sent again within the watermark."""
    return pings.dropDuplicatesWithinWatermark(["vehicle_id", "seq"])


def packed(pdf: pd.DataFrame) -> np.ndarray:
    """Usable pings as :data:`HELD` rows."""
    out = np.empty(len(pdf), HELD)
    for name in HELD.names:
        out[name] = pdf[name].to_numpy(dtype=HELD[name])
    return out


def replay(pings: np.ndarray, tails: np.ndarray, day: dt.date) -> tuple[pd.DataFrame, np.ndarray]:
    """The trips that end in these pings, and the tails behind them, by vehicle.

    The pings of a vehicle lie behind all that its tail has seen. Status is 0 or 1, so the
    changes of a vehicle alternate and an end belongs to the change before it.
    """
    pings = pings[np.lexsort((pings["seq"], pings["us"], pings["vehicle_id"]))]
    vehicle, occ = pings["vehicle_id"], pings["open_status"]
    ids, firsts, nth = np.unique(vehicle, return_index=True, return_inverse=True)
    at = np.searchsorted(tails["vehicle_id"], ids)
    known = np.isin(ids, tails["vehicle_id"])
    held = np.zeros(len(ids), TAIL)
    held["vehicle_id"], held["status"] = ids, -1
    held[known] = tails[at[known]]
    before = np.concatenate((occ[:1], occ[:-1]))
    before[firsts] = held["status"]
    flips = np.flatnonzero((before + occ == 1) & (before >= 0))
    of = nth[flips]
    opened = held[of]  # what is open at each change: the tail's start at a vehicle's first one, else the change before
    later = np.flatnonzero(of[1:] == of[:-1]) + 1
    earlier = pings[flips[later - 1]]
    opened["open"][later] = earlier["open_status"] == 0
    for start, name in _START:
        opened[start][later] = earlier[name]
    closed = (occ[flips] == 1) & opened["open"]
    starts, ends = opened[closed], pings[flips[closed]]
    trips = pd.DataFrame({
        "trip_id": starts["s_seq"], "vehicle_id": starts["vehicle_id"], "service_date": day,
        "s_us": starts["s_us"], "s_lng": starts["s_lng"], "s_lat": starts["s_lat"],
        "e_us": ends["us"], "e_lng": ends["lng"], "e_lat": ends["lat"],
    })
    held["status"] = occ[np.append(firsts[1:], len(occ)) - 1]
    last = np.flatnonzero(np.diff(of, append=-1))
    change = pings[flips[last]]
    held["open"][of[last]] = change["open_status"] == 0
    for start, name in _START:
        held[start][of[last]] = change[name]
    tails = np.concatenate((tails[~np.isin(tails["vehicle_id"], ids)], held))
    return trips, tails[np.argsort(tails["vehicle_id"])]


def _step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Replays the pings of one group of vehicles and day that the watermark has passed.

    State: time of the last ping replayed, tails, and the pings still ahead of the watermark.
    """
    last_us, tails, held = state.get if state.exists else (0, b"", b"")
    fresh = [] if state.hasTimedOut else [packed(pdf) for pdf in frames]
    pings, tails = np.concatenate([np.frombuffer(held, HELD), *fresh]), np.frombuffer(tails, TAIL)
    passed = state.getCurrentWatermarkMs() * 1000
    done = pings["us"] <= passed
    due, rest = pings[done], pings[~done]
    trips = None
    if len(due):
        trips, tails = replay(due, tails, key[1])
        last_us = int(due["us"].max())
    if len(rest):
        wake = int(rest["us"].min()) // 1000 + 1
    else:
        wake = (last_us + _DAY_US) // 1000  # the day is over: forget the vehicles
    if not len(rest) and wake <= passed // 1000:
        state.remove()
    else:
        state.update((last_us, tails.tobytes(), rest.tobytes()))
        state.setTimeoutTimestamp(max(wake, passed // 1000 + 1))
    if trips is not None and len(trips):
        yield trips


def usable(pings: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """Pings inside the box with a vehicle and a status of 0 or 1, as the stateful steps take them."""
    boxed = filter_box(pings, p).where(F.col("open_status").isin(0, 1) & F.col("vehicle_id").isNotNull())
    return boxed.withColumns({"us": F.unix_micros("ts"), "service_date": F.to_date("ts")}).select(
        "vehicle_id", "service_date", "seq", "us", "lng", "lat", "open_status", "ts"
    )


def by_vehicle_group(pings: DataFrame, p: Params = DEFAULTS) -> GroupedData:
    """Usable pings by a group of vehicles and day: one call and one state for many vehicles.

    The number of groups is part of a stream's checkpoint.
    """
    group = F.pmod(F.xxhash64("vehicle_id"), F.lit(p.vehicle_groups)).alias("vehicle_group")
    return usable(pings, p).select("*", group).groupBy("vehicle_group", "service_date")


def assemble(pings: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """Watermarked stream of pings to a stream of valid trips with s_ts and e_ts."""
    return valid(by_vehicle_group(pings, p).applyInPandasWithState(
        _step, ASSEMBLED, _STATE, "append", GroupStateTimeout.EventTimeTimeout
    ), p)


def valid(raw: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """Assembled trips that pass the trip filter, measured."""
    timed = raw.withColumns({"s_ts": F.timestamp_micros("s_us"), "e_ts": F.timestamp_micros("e_us")})
    timed = timed.withColumns({"s_sec": seconds_of(F.col("s_ts")), "e_sec": seconds_of(F.col("e_ts"))})
    return filter_trips(measure(timed.drop("s_us", "e_us")), p)


def hourly_trips(trips: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """Trips, mean speed and mean distance per tumbling start hour.

    A valid trip arrives at most its longest duration after its start.
    """
    timed = trips.withWatermark("s_ts", f"{int(p.trip_minutes_max)} minutes")
    return timed.groupBy(F.window("s_ts", "1 hour").alias("w")).agg(
        F.count(F.lit(1)).alias("trip_count"),
        F.avg("avg_speed").alias("avg_speed"), F.avg("distance_km").alias("avg_distance"),
    ).select(F.col("w.start").alias("window_start"), "trip_count", "avg_speed", "avg_distance")


def rolling_heat(trips: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """Pick-ups per cell over the last 60 minutes, every 15 minutes."""
    i_lng, i_lat = cell_lng(F.col("s_lng"), p), cell_lat(F.col("s_lat"), p)
    timed = trips.withWatermark("s_ts", f"{int(p.trip_minutes_max)} minutes")
    counts = timed.groupBy(
        F.window("s_ts", "60 minutes", "15 minutes").alias("w"), i_lng.alias("i_lng"), i_lat.alias("i_lat")
    ).agg(F.count(F.lit(1)).alias("count"))
    return counts.select(
        F.col("w.start").alias("window_start"), "i_lng", "i_lat",
        center_lng(F.col("i_lng"), p).alias("lng"), center_lat(F.col("i_lat"), p).alias("lat"), "count",
    )


def board_rows(hourly: DataFrame) -> DataFrame:
    """Hourly windows as keyed board rows."""
    info = F.to_json(F.struct("avg_speed", "avg_distance"))
    return hourly.select(
        F.lit("hourly_trips").alias("stat_type"), F.date_format("window_start", "yyyy-MM-dd HH:mm").alias("stat_key"),
        F.col("trip_count").cast("double").alias("stat_value"), info.alias("extra_info"),
        F.current_timestamp().alias("updated_at"),
    )


def refresh_board(rows: DataFrame, batch_id: int, target: str) -> None:
    """Upsert one micro-batch into the published board.

    The version is the batch number: a replayed batch publishes its version again,
    merged into the one before it.
    """
    spark = rows.sparkSession
    if batch_id > 0:
        before = spark.read.parquet(f"{version_path(spark, target, batch_id - 1)}/realtime_stats")
        rows = merge_latest(before, rows, ["stat_type", "stat_key"])
    publish({"realtime_stats": rows}, target, batch_id)


def start_trips(trips: DataFrame, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Trips to a parquet table."""
    writer = trips.writeStream.outputMode("append").format("parquet").option("checkpointLocation", checkpoint)
    return triggered(writer, once).start(path)


def start_board(trips: DataFrame, target: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Hourly board rows, refreshed every 30 seconds."""
    rows = board_rows(hourly_trips(trips))
    writer = rows.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(
        lambda df, batch_id: refresh_board(df, batch_id, target)
    )
    return triggered(writer, once).start()


def sent_once(fresh: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """Of pings under one number, one whole row.

    A kept row, because only it carries a prior status, else the latest. The numbers sent
    again are counted first (two columns, combined before the shuffle); where they are
    few, only their rows are shuffled and sorted.
    """
    name = ["vehicle_id", "seq"]
    values = [c for c in fresh.columns if c not in name]
    order = F.struct(F.col("prior_status").isNotNull(), "ts", *[c for c in values if c not in ("prior_status", "ts")])

    def latest(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*name).agg(F.max_by(F.struct(*values), order).alias("r")).select(*name, "r.*").select(*fresh.columns)

    again = fresh.groupBy(*name).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*name)
    repeats = listed(again, p.max_broadcast_rows)
    if repeats == []:
        return fresh
    if repeats is None:
        return latest(fresh).persist(StorageLevel.MEMORY_AND_DISK)
    spark = fresh.sparkSession
    numbers = F.broadcast(spark.createDataFrame(repeats, fresh.select(*name).schema).toDF("again_vehicle", "again_seq"))
    same = (F.col("vehicle_id") == F.col("again_vehicle")) & F.col("seq").eqNullSafe(F.col("again_seq"))
    return fresh.join(numbers, same, "left_anti").unionByName(latest(fresh.join(numbers, same, "left_semi")))


def settle(batch: DataFrame, batch_id: int, target: str, p: Params = DEFAULTS, lateness_s: int = 3600) -> None:
    """One micro-batch of live trips with the batch operators.

    The same trips as :func:`assemble`, for fleets where one vehicle may send a large
    share of all pings: a long vehicle-day is cut into chunks as in batch, instead of
    being replayed in one task. Kept between batches are the pings ahead of the
    watermark and, per vehicle and day, the last ping behind it and an open start.
    Every version is built from the one before it, so a replayed batch gives the same.
    """
    spark = batch.sparkSession
    us = F.unix_micros("ts")
    named = [*LIVE_PING.names, "prior_status"]
    fresh = batch.withColumn("prior_status", F.lit(None).cast("int")).select(*named)
    passed = -(2**62)
    if batch_id > 0:
        before = version_path(spark, target, batch_id - 1)
        passed = spark.read.schema("us long").parquet(f"{before}/passed").first().us
        fresh = spark.read.parquet(f"{before}/kept").select(*named).unionByName(fresh.where(us > passed))
    fresh = fresh.where(F.col("vehicle_id").isNotNull()).persist(StorageLevel.MEMORY_AND_DISK)
    rows = sent_once(fresh, p)
    timed = rows.withColumns({"service_date": F.to_date("ts"), "sec_of_day": seconds_of(F.col("ts"))})
    days = timed.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n"), F.max(us).alias("us")).persist(StorageLevel.MEMORY_AND_DISK)
    newest = days.agg(F.max("us").alias("us")).first().us
    if newest is not None:
        passed = max(passed, newest - lateness_s * 1_000_000)
    behind = us <= F.lit(passed)
    pings = filter_box(timed.where(behind & F.col("open_status").isin(0, 1)), p)
    marked = status_changes(sequence(pings, p, counts=days.select(*KEYS, "n")), ends=True)
    marks = marked.df.persist(StorageLevel.MEMORY_AND_DISK)  # one sort of the pings for trips, open starts and last pings
    changes = marked.on(marks.where(F.col("change").isNotNull()))
    trips = clean_trips(pair_trips(changes), p)
    midnight = F.unix_micros(F.col("service_date").cast("timestamp"))
    trips = trips.withColumns({
        "s_ts": F.timestamp_micros(midnight + F.col("s_sec") * 1_000_000),
        "e_ts": F.timestamp_micros(midnight + F.col("e_sec") * 1_000_000),
    })
    ping = F.struct(*named[:-1])
    place = F.struct(*ORDER)
    last = marks.where("is_end").groupBy(*KEYS).agg(
        F.max_by(ping, place).alias("r"), F.max_by(F.coalesce("change", F.lit(0)), place).alias("change")
    ).where(F.col("change") != 1).select("service_date", "r.*", F.lit(None).cast("int").alias("prior_status"))
    # of the changes only the last of every day and chunk; an open start that is the last ping is kept once, as the start
    final = changes.df.withColumn("later", F.lead("change").over(changes.window())).where(F.col("later").isNull())
    opened = final.groupBy(*KEYS).agg(
        F.max_by(ping, place).alias("r"), F.max_by("change", place).alias("change")
    ).where(F.col("change") == 1).select("service_date", "r.*", F.lit(1).alias("prior_status"))
    # days before the watermark's are over
    context = last.unionByName(opened).where(F.col("service_date") >= F.to_date(F.timestamp_micros(F.lit(passed))))
    kept = context.select(*named).unionByName(rows.where(~behind).select(*named))
    mark = one_row(spark, us=F.lit(passed).cast("long"))
    publish({"trips": trips, "kept": kept, "passed": mark}, target, batch_id)
    for kept_in_memory in (marks, days, rows, fresh):
        kept_in_memory.unpersist()


def close(spark: SparkSession, target: str, p: Params = DEFAULTS) -> None:
    """Settles what is still ahead of the watermark, once the pings have ended."""
    version = published_version(spark, target)
    none = spark.range(0, 0, 1, 1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in LIVE_PING])
    settle(none, version + 1, target, p, lateness_s=-2 * 86_400)


def start_settling(
    pings: DataFrame, target: str, checkpoint: str, once: bool = False, p: Params = DEFAULTS, lateness_s: int = 3600
) -> StreamingQuery:
    """Stream of pings (no watermark needed) to versions of settled trips."""
    writer = pings.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda df, batch_id: settle(df, batch_id, target, p, lateness_s)
    )
    return triggered(writer, once).start()


def settled_trips(spark: SparkSession, target: str) -> DataFrame:
    """Trips of all announced versions."""
    return read_all_versions(spark, target, "trips")


def refresh_whole_board(
    spark: SparkSession, trips_target: str, board_target: str, version: int, p: Params = DEFAULTS
) -> None:
    """KPI, heat, trend, period and hourly rows of all trips settled so far.

    Counted in one pass over the settled trips, a row per trip: keep one store a day. The
    rows equal the batch board's; the ranking needs a clustering and is left to batch.
    """
    figures = cut(board_figures(settled_trips(spark, trips_target), p))
    publish({"realtime_stats": rows_of_figures(figures, p)}, board_target, version)


def start_whole_board(
    pings: DataFrame, trips_target: str, board_target: str, checkpoint: str, once: bool = False,
    p: Params = DEFAULTS, lateness_s: int = 3600,
) -> StreamingQuery:
    """Stream of pings to settled trips and the board over them, in every micro-batch."""
    def step(batch: DataFrame, batch_id: int) -> None:
        settle(batch, batch_id, trips_target, p, lateness_s)
        refresh_whole_board(batch.sparkSession, trips_target, board_target, batch_id, p)

    writer = pings.writeStream.option("checkpointLocation", checkpoint).foreachBatch(step)
    return triggered(writer, once).start()


def triggered(writer, once: bool):  # noqa: ANN001, ANN202
    return writer.trigger(availableNow=True) if once else writer.trigger(processingTime="30 seconds")


def board(spark: SparkSession, target: str) -> DataFrame:
    return read_published(spark, target, "realtime_stats")


__all__ = [
    "assemble", "board", "board_rows", "close", "drop_repeats", "hourly_trips", "published_version",
    "read_ping_stream", "refresh_board", "refresh_whole_board", "rolling_heat", "settle", "settled_trips", "start_board",
    "start_settling", "start_trips", "start_whole_board", "usable", "valid", "watermarked",
]
