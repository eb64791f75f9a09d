"""The ping view over an event table (``events.parquet``).

Thirty days of events are laid on one service day with integer arithmetic only,
so that any SQL engine builds the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

SERVICE_DATE = "2024-01-01"
EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def pings_from_events(events: DataFrame, foreign: bool = False) -> DataFrame:
    """Event rows as pings; ``foreign`` gives error events a status that is neither 0 nor 1."""
    e, ts = F.col("event_id"), F.col("ts")
    # field arithmetic keeps a timestamp without zone independent of the session zone
    elapsed = (
        F.datediff(ts.cast("date"), F.lit(SERVICE_DATE).cast("date")).cast("long") * 86_400
        + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
    )
    hub = e % 4 == 0
    ring = F.floor(e / 4) % 6
    jitter_lng, jitter_lat = e * 7919, e * 104729
    lng = (
        F.when(e % 97 == 0, F.lit(112.5))
        .when(hub, F.lit(114.0) + ring * F.lit(0.03) + (jitter_lng % 60) / F.lit(20000.0))
        .otherwise(F.lit(113.95) + (jitter_lng % 2000) / F.lit(10000.0))
    )
    lat = F.when(
        hub, F.lit(22.52) + ring * F.lit(0.01) + (jitter_lat % 60) / F.lit(20000.0)
    ).otherwise(F.lit(22.5) + (jitter_lat % 1000) / F.lit(10000.0))
    status = F.when(F.col("event_type").isin("click", "purchase"), 0)
    if foreign:
        status = status.when(F.col("event_type") == "error", 2)
    return events.select(
        e.alias("seq"),
        F.col("user_id").alias("vehicle_id"),
        F.lit(SERVICE_DATE).cast("date").alias("service_date"),
        F.floor(elapsed / 30).cast("long").alias("sec_of_day"),
        lng.alias("lng"),
        lat.alias("lat"),
        status.otherwise(1).alias("open_status"),
        F.col("value").alias("speed"),
    )


def read_events_view(spark: SparkSession, sf_dir: str, foreign: bool = False) -> DataFrame:
    return pings_from_events(spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet"), foreign)


def stream_events_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same pings as a file stream, with full timestamps."""
    events = spark.readStream.schema(EVENTS).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return with_timestamps(pings_from_events(events))


def with_timestamps(pings: DataFrame) -> DataFrame:
    midnight = F.col("service_date").cast("timestamp")
    return pings.withColumn("ts", F.timestamp_seconds(F.unix_seconds(midnight) + F.col("sec_of_day")))
