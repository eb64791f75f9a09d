"""End-to-end runs: clean a ping file, analyse trips, publish, report."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F

from tripweave.operators.temporal import top_vehicles, vehicle_efficiency
from tripweave.operators.trips import clean_trips, trips_from_pings
from tripweave.params import DEFAULTS, Params
from tripweave.plans.marts import Marts
from tripweave.schemas import PING, TRIP
from tripweave.sources.files import accepted, parsed_pings, parsed_trips, rejected
from tripweave.sources.sinks import od_columns, publish, write_csv, write_parquet


_DAY = ("service_date",)


def ingest(
    spark: SparkSession, source: str, target: str, service_date: str, encoding: str = "UTF-8"
) -> DataFrame:
    """Raw CSV to typed pings, stored by day in one pass; other days in the store stay.

    Accepted and rejected lines of a day are one table, so repeating a day replaces both.
    """
    write_parquet(parsed_pings(spark, source, service_date, encoding), f"{target}/ingested", _DAY)
    return stored_pings(spark, target)


def stored_pings(spark: SparkSession, target: str) -> DataFrame:
    """Accepted pings of all stored days."""
    return accepted(spark.read.parquet(f"{target}/ingested"), PING.names)


def stored_rejects(spark: SparkSession, target: str, table: str = "ingested") -> DataFrame:
    """The quarantine: lines of all stored days that gave no row."""
    return rejected(spark.read.parquet(f"{target}/{table}"))


def clean(pings: DataFrame, target: str, p: Params = DEFAULTS, strict: bool = True) -> DataFrame:
    """Pings to valid trips, stored once by day; later steps read the stored table."""
    path = f"{target}/trips"
    write_parquet(trips_from_pings(pings, p, strict), path, _DAY)
    return pings.sparkSession.read.schema(TRIP).parquet(path)


def clean_od(
    spark: SparkSession, source: str, target: str, service_date: str, p: Params = DEFAULTS
) -> DataFrame:
    """Input that holds trips already: the trip filter only."""
    write_parquet(parsed_trips(spark, source, service_date), f"{target}/od_ingested", _DAY)
    stored = spark.read.parquet(f"{target}/od_ingested").where(F.col("service_date") == F.lit(service_date).cast("date"))
    od = accepted(stored, [c for c in stored.columns if c not in ("seq", "reject_reason", "row_text")])
    path = f"{target}/trips"
    write_parquet(clean_trips(od, p), path, _DAY)
    return spark.read.schema(TRIP).parquet(path)


def export_trips(trips: DataFrame, path: str) -> None:
    write_csv(od_columns(trips).drop("trip_id"), path)


def analyse(trips: DataFrame, target: str, version: int, p: Params = DEFAULTS) -> None:
    """Build and publish all result tables from one read of the trips."""
    kept = trips.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        publish(Marts(kept, p).result_tables(), target, version)
    finally:
        kept.unpersist()


def report_text(marts: Marts) -> str:
    """The analysis report as Markdown, from its figures and five vehicles."""
    best = top_vehicles(vehicle_efficiency(marts.trips), 5).select(
        "vehicle_id", "trip_count", F.format_number("avg_duration", 1).alias("avg_duration")
    ).collect()
    lines = ["# Trip analysis", "", "| figure | value |", "| --- | --- |"]
    lines += [f"| {r.figure} | {r.text} |" for r in marts.report_figures().orderBy("figure_no").collect()]
    lines += ["", "| vehicle | trips | mean duration (min) |", "| --- | --- | --- |"]
    lines += [f"| {v.vehicle_id} | {v.trip_count} | {v.avg_duration} |" for v in best]
    return "\n".join(lines) + "\n"


def write_report(marts: Marts, path: str) -> None:
    text = report_text(marts)
    lines = marts.trips.sparkSession.createDataFrame([(text.rstrip("\n"),)], "value string")
    lines.coalesce(1).write.mode("overwrite").text(path)
