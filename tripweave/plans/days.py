"""Trips over midnight: days cleaned one after the other, with what is open carried to the next.

After each day a table keeps, for every vehicle seen so far, its last status and the start of a trip
that has not ended. The next day takes these as pings before its first one, so its trips are those of
one long run: a start may lie on the day before, and a status may change across a gap of days. Trips
are stored under the day on which they end. Cleaning a day again cleans the later ones after it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from tripweave.functions.clock import DAY_S, hour_of
from tripweave.operators.clean import drop_speedless, filter_box
from tripweave.operators.sequence import KEYS, ORDER, sequence
from tripweave.operators.trips import filter_trips, measure, pair_trips, status_changes
from tripweave.params import DEFAULTS, Params
from tripweave.schemas import PING, TRIP
from tripweave.session import cut

#: What is carried: a ping before the day, with the status before it where it starts an open trip.
_CARRIED = "vehicle_id long, day date, seq long, sec_of_day long, lng double, lat double, open_status int, prior_status int"


def _carried(spark: SparkSession, target: str, day: dt.date) -> DataFrame:
    """The state behind the last stored day before ``day``, with seconds counted from the start of ``day``."""
    try:
        stored = spark.read.schema(_CARRIED).parquet(f"{target}/carried").where(F.col("day") < F.lit(day))
        last = stored.agg(F.max("day")).first()[0]
    except Exception as e:  # no day has been stored yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
        last = None
    if last is None:
        return spark.createDataFrame([], _CARRIED)
    shift = (day - last).days * DAY_S
    return stored.where(F.col("day") == F.lit(last)).withColumn("sec_of_day", F.col("sec_of_day") - shift)


def clean_day(pings: DataFrame, target: str, day: dt.date, p: Params = DEFAULTS) -> None:
    """Stores the valid trips that end on ``day`` and the state behind it. ``pings`` are those of the day."""
    spark = pings.sparkSession
    before = cut(_carried(spark, target, day))
    own = pings.where((F.col("service_date") == F.lit(day)) & F.col("vehicle_id").isNotNull()).withColumn("prior_status", F.lit(None).cast("int"))
    context = before.withColumns({"service_date": F.lit(day), "speed": F.lit(None).cast("double")})
    columns = [*PING.names, "prior_status"]
    rows = filter_box(own, p).select(*columns).unionByName(context.select(*columns))
    ordered = drop_speedless(sequence(rows, p))
    changes = status_changes(ordered)
    raw = pair_trips(changes)
    # seconds before the day are negative, so durations are those that passed, however many days
    valid = filter_trips(measure(raw), p)
    days_back = F.floor(F.col("s_sec") / DAY_S).cast("int")
    trips = valid.withColumns({
        "day": F.lit(day), "service_date": F.date_add(F.lit(day), days_back), "s_sec": F.pmod("s_sec", F.lit(DAY_S)),
    }).withColumn("hour", hour_of(F.col("s_sec"))).select(*TRIP.names, "day")
    ping = F.struct("seq", "sec_of_day", "lng", "lat", "open_status")
    last = ordered.df.groupBy(*KEYS).agg(F.max_by(ping, F.struct(*ORDER)).alias("r")).select(
        "vehicle_id", "r.*", F.lit(None).cast("int").alias("prior_status")
    )
    opened = changes.df.groupBy(*KEYS).agg(
        F.max_by(ping, F.struct(*ORDER)).alias("r"), F.max_by("change", F.struct(*ORDER)).alias("change")
    ).where(F.col("change") == 1).select("vehicle_id", "r.*", F.lit(1).alias("prior_status"))
    state = last.join(opened.select("vehicle_id", "seq"), ["vehicle_id", "seq"], "left_anti").select(*opened.columns).unionByName(opened)
    absent = before.drop("day").join(last.select("vehicle_id"), "vehicle_id", "left_anti")
    carried = state.unionByName(absent.select(*state.columns)).withColumn("day", F.lit(day))
    _replace_day(trips, f"{target}/day_trips", day)
    _replace_day(carried, f"{target}/carried", day)


def _replace_day(df: DataFrame, path: str, day: dt.date) -> None:
    """Writes a day's folder anew, also where there are no rows."""
    df.drop("day").write.mode("overwrite").parquet(f"{path}/day={day.isoformat()}")


def clean_from(spark: SparkSession, target: str, day: dt.date, pings: DataFrame, p: Params = DEFAULTS) -> None:
    """Cleans ``day`` and, in order, every later day of ``pings``, which is what a changed day asks for."""
    days = [r.service_date for r in pings.where(F.col("service_date") >= F.lit(day)).select("service_date").distinct().orderBy("service_date").collect()]
    for one in sorted({day, *days}):  # a row for each day
        clean_day(pings, target, one, p)


def day_trips(spark: SparkSession, target: str) -> DataFrame:
    """Valid trips of all stored days, those over midnight among them."""
    return spark.read.parquet(f"{target}/day_trips").select(*TRIP.names)


def open_trips(spark: SparkSession, target: str) -> DataFrame:
    """vehicle_id, seq: starts without an end behind the last stored day."""
    stored = spark.read.parquet(f"{target}/carried")
    last = stored.agg(F.max("day")).first()[0]
    return stored.where((F.col("day") == F.lit(last)) & (F.col("prior_status") == 1)).select("vehicle_id", "seq")


