"""The live board kept by mergeable partial states.

Every version of the board holds counts and sums by hour, period and cell, and the vehicles as
bitmaps. A micro-batch builds these from its own trips and merges them with the version before it,
so what it reads is bounded by hours, periods, cells and vehicles, and not by the trips so far. A
replayed batch merges with the same version before it and gives the same board.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tripweave.functions.geo import cell_lat, cell_lng, center_lat, center_lng
from tripweave.operators.spatial import busiest_cells
from tripweave.operators.temporal import in_periods, on_hours, periods_table
from tripweave.params import DEFAULTS, Params
from tripweave.plans.board import cache_rows_of
from tripweave.session import cut
from tripweave.sources.sinks import publish, version_path
from tripweave.streaming import clusters
from tripweave.streaming.live import settle, triggered

_SUMS = ("n", "seconds", "km", "kmh")


def partial_counts(trips: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """kind (all, hour, period, cell), a, b, n, seconds, km, kmh: counts and sums of these trips."""
    def counted(df: DataFrame, kind: str, a, b) -> DataFrame:  # noqa: ANN001
        return df.groupBy(F.lit(kind).alias("kind"), a.cast("long").alias("a"), b.cast("long").alias("b")).agg(
            F.count(F.lit(1)).alias("n"), F.sum("duration_s").alias("seconds"), F.sum("distance_km").alias("km"), F.sum("avg_speed").alias("kmh")
        )

    zero = F.lit(0)
    return counted(trips, "all", zero, zero).unionByName(counted(trips, "hour", F.col("hour"), zero)).unionByName(
        counted(in_periods(trips, p), "period", F.col("period_no"), zero)
    ).unionByName(counted(trips, "cell", cell_lng(F.col("s_lng"), p), cell_lat(F.col("s_lat"), p)))


def partial_vehicles(trips: DataFrame) -> DataFrame:
    """bucket, bits: the vehicles of these trips, 32,768 to a bitmap."""
    return trips.where(F.col("vehicle_id").isNotNull()).groupBy(F.bitmap_bucket_number("vehicle_id").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("vehicle_id")).alias("bits")
    )


def merged_counts(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b).groupBy("kind", "a", "b").agg(*[F.sum(c).alias(c) for c in _SUMS])


def merged_vehicles(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b).groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def board_rows(counts: DataFrame, vehicles: DataFrame, hotspots: DataFrame | None, p: Params = DEFAULTS) -> DataFrame:
    """The rows of the cache, from partial states of all trips."""
    of = lambda kind: counts.where(F.col("kind") == kind)
    mean = lambda c: F.try_divide(F.sum(c), F.sum("n"))
    figures = of("all").select(*_SUMS, F.lit(0).cast("long").alias("v")).unionByName(
        vehicles.select(*[F.lit(None).cast("double" if c in ("km", "kmh") else "long").alias(c) for c in _SUMS], F.bitmap_count("bits").alias("v"))
    )
    kpis = figures.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_trips"), F.coalesce(F.sum("v"), F.lit(0)).alias("total_vehicles"),
        (mean("seconds") / F.lit(60.0)).alias("avg_duration"), mean("km").alias("avg_distance"), mean("kmh").alias("avg_speed"),
    )
    trend = on_hours(of("hour").select(
        F.col("a").cast("int").alias("hour"), F.col("n").alias("trip_count"), (F.col("kmh") / F.col("n")).alias("avg_speed"),
        (F.col("km") / F.col("n")).alias("avg_distance"),
    ))
    periods = periods_table(counts, p).join(
        F.broadcast(of("period").select(F.col("a").cast("int").alias("period_no"), "n")), "period_no", "left"  # a row for each period
    ).select("period_name", F.coalesce("n", F.lit(0)).alias("trip_count"))
    cells = of("cell").select(F.col("a").alias("i_lng"), F.col("b").alias("i_lat"), "n").withColumns({
        "lng": center_lng(F.col("i_lng"), p), "lat": center_lat(F.col("i_lat"), p),
    })
    return cache_rows_of(kpis, trend.select("hour", "trip_count"), periods, trend, busiest_cells(cells), hotspots)


def refresh(
    spark: SparkSession, trips_target: str, board_target: str, version: int, p: Params = DEFAULTS, ranking: bool = True
) -> None:
    """The board with the trips that were settled under this version, merged into the version before."""
    trips = spark.read.parquet(f"{version_path(spark, trips_target, version)}/trips")
    counts, vehicles = partial_counts(trips, p), partial_vehicles(trips)
    before = version_path(spark, board_target, version - 1) if version > 0 else None
    if before:
        counts = merged_counts(spark.read.parquet(f"{before}/counts"), counts)
        vehicles = merged_vehicles(spark.read.parquet(f"{before}/vehicles"), vehicles)
    counts, vehicles = cut(counts), cut(vehicles)
    tables = {"counts": counts, "vehicles": vehicles}
    hotspots = None
    if ranking:
        state = clusters.grown(spark, before, trips.select(F.col("trip_id").alias("id"), F.col("s_lng").alias("lng"), F.col("s_lat").alias("lat")), p)
        tables |= state
        hotspots = clusters.hotspots(state, p)
    publish(tables | {"realtime_stats": board_rows(counts, vehicles, hotspots, p)}, board_target, version)


def start_delta_board(
    pings: DataFrame, trips_target: str, board_target: str, checkpoint: str, once: bool = False, p: Params = DEFAULTS,
    lateness_s: int = 3600, ranking: bool = True,
) -> StreamingQuery:
    """Stream of pings to settled trips and the board merged from each micro-batch's own trips."""
    def step(batch: DataFrame, batch_id: int) -> None:
        settle(batch, batch_id, trips_target, p, lateness_s)
        refresh(batch.sparkSession, trips_target, board_target, batch_id, p, ranking)

    return triggered(pings.writeStream.option("checkpointLocation", checkpoint).foreachBatch(step), once).start()
