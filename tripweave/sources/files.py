"""Readers for raw ping and trip files.

Every cell is read as text and converted with ``try_`` functions, so a bad value
becomes a quarantined row with a reason and never an error or a guessed type.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tripweave.functions.clock import parse_seconds
from tripweave.params import DEFAULTS, Params
from tripweave.schemas import PING
from tripweave.session import cut, scratch_path
from tripweave.sources.lines import RANGE_BYTES, LineSource

PING_NAMES = ("VehicleNum", "Stime", "Lng", "Lat", "OpenStatus", "Speed")
TRIP_NAMES = ("VehicleNum", "Stime", "SLng", "SLat", "ELng", "ELat", "Etime")
#: Bits of a row's number that hold its place in the file; the others hold the file's rank.
OFFSET_BITS = 40
#: Encodings that ``auto`` chooses between, for each file.
DETECTED = ("UTF-8", "GB18030")
_BAD, _LINE = "_bad", "_line"


def row_number_of(file_no: Column, offset: Column) -> Column:
    """Orders rows by file and place in it; no two places share a number."""
    return F.shiftleft(file_no.cast("long"), OFFSET_BITS) + offset


def _load(spark: SparkSession, path: str, names: tuple[str, ...], encodings: list[str], **options: str) -> DataFrame:
    spark.dataSource.register(LineSource)
    largest = int(spark.conf.get("spark.sql.files.maxPartitionBytes").rstrip("bB")) if spark.conf.get(
        "spark.sql.files.maxPartitionBytes"
    ).rstrip("bB").isdigit() else RANGE_BYTES
    return spark.read.format(LineSource.name()).options(
        path=path, names=json.dumps(names), encodings=json.dumps(encodings), rangeBytes=str(min(largest, RANGE_BYTES)), **options
    ).load()


def read_text_table(
    spark: SparkSession, path: str, names: tuple[str, ...], encoding: str = "UTF-8", p: Params = DEFAULTS
) -> DataFrame:
    """CSV files with headers as text columns, each file's columns taken by the names in its header.

    A header is a line with all of ``names`` as cells, blanks around them aside; it is looked for in
    the first block of a file. Adds ``_bad``, the reason why a line gives no row (``bad_encoding``,
    ``no_header``, ``corrupt_line``), ``_line``, its text, and ``seq``, which orders rows by file name and
    by the byte at which the line starts: equal however files are cut, and whatever files come after.

    Lines are decoded strictly. With the encoding ``auto`` each file is UTF-8 or GB18030, whichever
    leaves fewer of its lines undecoded, UTF-8 among equals; the lines are then stored once, as
    all of a file decide on each.
    """
    auto = encoding.lower() == "auto"
    encodings = list(DETECTED) if auto else [encoding]
    headers = _load(spark, path, names, encodings, mode="headers").select(F.explode("cells").alias("c"))
    found = [r.c for r in headers.where("c IS NOT NULL").distinct().orderBy("c").collect()]  # a row for each column name
    columns = [*names, *[c for c in found if c not in names]]
    lines = _load(spark, path, names, encodings, columns=json.dumps(columns))
    reading = ("cells", "bad", "line")
    if auto:
        stored = scratch_path(spark, "lines")
        lines.write.parquet(stored)
        lines = spark.read.parquet(stored)
        undecoded = lambda c: F.count_if(F.col(c) == "bad_encoding")
        second = cut(lines.where("NOT plain").groupBy("file_no").agg(
            (undecoded("bad2") < undecoded("bad")).alias("second")
        ).where("second"))
        # a table of files within the bound is sent to every task; a larger one is joined by shuffle
        lines = lines.join(F.broadcast(second) if second.count() <= p.max_broadcast_rows else second, "file_no", "left")
        other = F.coalesce("second", F.lit(False)) & ~F.col("plain")
        lines = lines.select("file_no", "offset", *[F.when(other, F.col(f"{c}2")).otherwise(F.col(c)).alias(c) for c in reading])
    value = lambda c: F.get("cells", F.lit(columns.index(c)))
    if "seq" in columns:
        lines = lines.withColumn("row_seq", value("seq"))
    seq = F.expr("try_cast(row_seq AS bigint)") if "seq" in columns else row_number_of(F.col("file_no"), F.col("offset"))
    return lines.select(
        *[value(c).alias(c) for c in columns if c != "seq"], F.col("bad").alias(_BAD), F.col("line").alias(_LINE), seq.alias("seq"),
    )


def _number(name: str, kind: str) -> Column:
    return F.expr(f"try_cast(trim({name}) AS {kind})")


def _bad(name: str, value: Column) -> Column:
    """A value is there but does not convert."""
    return F.col(name).isNotNull() & (F.trim(name) != "") & value.isNull()


def _unread(raw: DataFrame) -> Column:
    return F.col(_BAD) if _BAD in raw.columns else F.lit(None).cast("string")


def _tagged(raw: DataFrame, names: tuple[str, ...], reason: Column) -> DataFrame:
    # typed names may differ from file names by case only, so the text is kept first
    text = F.to_json(F.struct(*[F.col(n) for n in names]))
    if _LINE in raw.columns:
        text = F.when(F.col(_BAD).isNotNull(), F.col(_LINE)).otherwise(text)
    return raw.withColumns({"reject_reason": F.coalesce(_unread(raw), reason), "row_text": text})


def parse_pings(raw: DataFrame, service_date: str | None = None) -> DataFrame:
    """Text rows to typed pings with ``reject_reason`` (null for a good row).

    Empty coordinates and speeds stay null and are left to cleaning. The text
    of a row is kept as ``row_text`` for the quarantine.
    """
    vehicle, sec = _number("VehicleNum", "bigint"), parse_seconds(F.col("Stime"))
    lng, lat, speed = (_number(c, "double") for c in ("Lng", "Lat", "Speed"))
    status = _number("OpenStatus", "int")
    if service_date is not None:
        raw = raw.withColumn("service_date", F.lit(service_date).cast("date"))
    elif "service_date" not in raw.columns:
        raise ValueError("the files carry no date: give service_date")
    reason = (
        F.when(vehicle.isNull(), "bad_vehicle")
        .when(sec.isNull(), "bad_time")
        .when(_bad("Lng", lng) | _bad("Lat", lat), "bad_coordinate")
        .when(_bad("Speed", speed), "bad_speed")
        .when(status.isNull() | ~status.isin(0, 1), "bad_status")
    )
    return _tagged(raw, PING_NAMES, reason).withColumns({
        "vehicle_id": vehicle, "sec_of_day": sec, "lng": lng, "lat": lat,
        "open_status": status, "speed": speed,
    })


def parse_trips(raw: DataFrame, service_date: str | None = None) -> DataFrame:
    """Text trip rows to typed raw trips with ``reject_reason``."""
    vehicle = _number("VehicleNum", "bigint")
    s_sec, e_sec = parse_seconds(F.col("Stime")), parse_seconds(F.col("Etime"))
    spots = {n.lower()[0] + "_" + n[1:].lower(): _number(n, "double") for n in ("SLng", "SLat", "ELng", "ELat")}
    missing = F.lit(False)
    for value in spots.values():
        missing = missing | value.isNull()
    if service_date is not None:
        raw = raw.withColumn("service_date", F.lit(service_date).cast("date"))
    reason = (
        F.when(vehicle.isNull(), "bad_vehicle")
        .when(s_sec.isNull() | e_sec.isNull(), "bad_time")
        .when(missing, "bad_coordinate")
    )
    return _tagged(raw, TRIP_NAMES, reason).withColumns({
        "trip_id": F.col("seq"), "vehicle_id": vehicle, "s_sec": s_sec, "e_sec": e_sec, **spots,
    })


def accepted(parsed: DataFrame, columns: tuple[str, ...] | list[str]) -> DataFrame:
    return parsed.where(F.col("reject_reason").isNull()).select(*columns)


def rejected(parsed: DataFrame) -> DataFrame:
    """Rows for the quarantine: order, reason, original text."""
    return parsed.where(F.col("reject_reason").isNotNull()).select("seq", "reject_reason", "row_text")


def parsed_pings(
    spark: SparkSession, path: str, service_date: str | None = None, encoding: str = "UTF-8"
) -> DataFrame:
    """Every line of raw ping files, typed, with ``reject_reason`` (null for a good row)."""
    parsed = parse_pings(read_text_table(spark, path, PING_NAMES, encoding), service_date)
    return parsed.select(*PING.names, "reject_reason", "row_text")


def parsed_trips(
    spark: SparkSession, path: str, service_date: str | None = None, encoding: str = "UTF-8"
) -> DataFrame:
    """Every line of trip files, typed, with ``reject_reason`` (null for a good row)."""
    parsed = parse_trips(read_text_table(spark, path, TRIP_NAMES, encoding), service_date)
    columns = [c for c in (
        "trip_id", "vehicle_id", "service_date", "s_sec", "s_lng", "s_lat", "e_sec", "e_lng", "e_lat",
    ) if c in parsed.columns]
    return parsed.select(*columns, "seq", "reject_reason", "row_text")


def read_pings(
    spark: SparkSession, path: str, service_date: str | None = None, encoding: str = "UTF-8"
) -> tuple[DataFrame, DataFrame]:
    """Raw ping CSV to (pings, quarantine)."""
    parsed = parsed_pings(spark, path, service_date, encoding)
    return accepted(parsed, PING.names), rejected(parsed)


def read_trips(
    spark: SparkSession, path: str, service_date: str | None = None, encoding: str = "UTF-8"
) -> tuple[DataFrame, DataFrame]:
    """Cleaned trip CSV to (raw trips, quarantine)."""
    parsed = parsed_trips(spark, path, service_date, encoding)
    return accepted(parsed, [c for c in parsed.columns if c not in ("seq", "reject_reason", "row_text")]), rejected(parsed)
