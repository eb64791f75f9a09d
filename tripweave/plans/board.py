"""The live board cache: keyed rows with a value or a JSON document, and its readers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tripweave.functions.clock import hour_label, hour_of
from tripweave.functions.geo import cell_lat, cell_lng, center_lat, center_lng
from tripweave.operators.hotspots import hotspot_ranking
from tripweave.operators.spatial import busiest_cells, heat_points
from tripweave.operators.temporal import hourly_counts, hourly_trend, in_periods, kpis, on_hours, period_stats, periods_table
from tripweave.params import DEFAULTS, Params

KPI_JSON = "total_trips long, total_vehicles long, avg_duration double, avg_distance double, avg_speed double"
HEAT_JSON = "array<struct<lat double, lng double, count long>>"
RANKING_JSON = "array<struct<rank int, name string, lng double, lat double, count long>>"
TREND_JSON = "hours array<string>, trips array<long>, speeds array<double>, distances array<double>"


def _rows(df: DataFrame, stat_type: str, key: Column, value: Column | None = None, info: Column | None = None) -> DataFrame:
    return df.select(
        F.lit(stat_type).alias("stat_type"), key.alias("stat_key"),
        (F.lit(None) if value is None else value).cast("double").alias("stat_value"),
        (F.lit(None) if info is None else info).cast("string").alias("extra_info"),
    )


def _ordered(order: Column, *fields: Column) -> Column:
    """Ordered array of structs; only for frames of a few hundred rows."""
    pairs = F.array_sort(F.collect_list(F.struct(order.alias("o"), F.struct(*fields).alias("f"))))
    return F.transform(pairs, lambda x: x["f"])


def live_kpis(trips: DataFrame) -> DataFrame:
    return kpis(trips).select("total_trips", "total_vehicles", "avg_duration", "avg_distance", "avg_speed")


def _scalar_rows(hours: DataFrame, periods: DataFrame) -> DataFrame:
    return _rows(hours, "hourly_trips", hour_label(F.col("hour")), F.col("trip_count")).unionByName(
        _rows(periods, "period_trips", F.col("period_name"), F.col("trip_count"))
    )


def scalar_rows(trips: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """The rows of the cache that hold one number: hours and periods."""
    return _scalar_rows(hourly_counts(trips), period_stats(trips, p))


def cache_rows(trips: DataFrame, hotspots: DataFrame | None, p: Params = DEFAULTS) -> DataFrame:
    """All rows of the cache; the ranking row only where start hotspots are given."""
    return cache_rows_of(
        live_kpis(trips), hourly_counts(trips), period_stats(trips, p), hourly_trend(trips), heat_points(trips, p=p), hotspots
    )


def board_figures(trips: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """kind (minute, cell, vehicles), minute, i_lng, i_lat, n, seconds, km, kmh: counts and sums of valid trips.

    One pass with grouping sets. A row for each start minute and start cell, and one that
    counts the vehicles; hours and periods begin with a minute, so they are sums of these.
    """
    keys = ["minute", "i_lng", "i_lat", "vehicle_id"]
    keyed = trips.select(
        F.floor(F.col("s_sec") / 60).alias("minute"), cell_lng(F.col("s_lng"), p).alias("i_lng"),
        cell_lat(F.col("s_lat"), p).alias("i_lat"), "vehicle_id", "duration_s", "distance_km", "avg_speed",
    )
    sets = keyed.groupingSets([["minute"], ["i_lng", "i_lat"], ["vehicle_id"]], *keys).agg(
        F.grouping("minute").alias("no_minute"), F.grouping("vehicle_id").alias("no_vehicle"),
        F.count(F.lit(1)).alias("n"), F.sum("duration_s").alias("seconds"), F.sum("distance_km").alias("km"), F.sum("avg_speed").alias("kmh"),
    )
    kind = F.when(F.col("no_minute") == 0, "minute").when(F.col("no_vehicle") == 0, "vehicles").otherwise("cell")
    n = F.when(F.col("kind") == "vehicles", F.col("vehicle_id").isNotNull().cast("long")).otherwise(F.col("n"))
    return sets.withColumn("kind", kind).groupBy("kind", "minute", "i_lng", "i_lat").agg(
        F.sum(n).alias("n"), *[F.sum(c).alias(c) for c in ("seconds", "km", "kmh")]
    )


def rows_of_figures(figures: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """The rows of the cache but the ranking from :func:`board_figures`; fix these first, several parts read them."""
    of = lambda kind: figures.where(F.col("kind") == kind)
    total = lambda kind, c: F.sum(F.when(F.col("kind") == kind, F.col(c)))
    mean = lambda c: F.try_divide(total("minute", c), total("minute", "n"))
    kpi = figures.agg(
        F.coalesce(total("minute", "n"), F.lit(0)).alias("total_trips"), F.coalesce(total("vehicles", "n"), F.lit(0)).alias("total_vehicles"),
        (mean("seconds") / F.lit(60.0)).alias("avg_duration"), mean("km").alias("avg_distance"), mean("kmh").alias("avg_speed"),
    )
    minutes = of("minute").withColumn("s_sec", F.col("minute") * 60)
    trend = on_hours(minutes.groupBy(hour_of(F.col("s_sec")).alias("hour")).agg(
        F.sum("n").alias("trip_count"), (F.sum("kmh") / F.sum("n")).alias("avg_speed"), (F.sum("km") / F.sum("n")).alias("avg_distance"),
    ))
    counted = in_periods(minutes, p).groupBy("period_no").agg(F.sum("n").alias("n"))
    periods = periods_table(figures, p).join(F.broadcast(counted), "period_no", "left")  # a row for each period
    cells = of("cell").select("i_lng", "i_lat", "n").withColumns({
        "lng": center_lng(F.col("i_lng"), p), "lat": center_lat(F.col("i_lat"), p),
    })
    return cache_rows_of(
        kpi, trend.select("hour", "trip_count"), periods.select("period_name", F.coalesce("n", F.lit(0)).alias("trip_count")),
        trend, busiest_cells(cells), None,
    )


def cache_rows_of(
    kpis: DataFrame, hours: DataFrame, periods: DataFrame, trend: DataFrame, heat: DataFrame, hotspots: DataFrame | None
) -> DataFrame:
    """The rows of the cache from the tables they show, however these were made."""
    one = F.lit("all")
    kpi = _rows(kpis, "kpi_summary", one, info=F.to_json(F.struct("*")))
    series = trend.agg(
        F.sort_array(F.collect_list(F.struct("hour", "trip_count", "avg_speed", "avg_distance"))).alias("s")
    ).select(F.to_json(F.struct(
        F.transform("s.hour", hour_label).alias("hours"),
        F.col("s.trip_count").alias("trips"),
        F.col("s.avg_speed").alias("speeds"),
        F.col("s.avg_distance").alias("distances"),
    )).alias("j"))
    cells = heat.agg(F.to_json(_ordered(
        F.struct(-F.col("count"), F.col("i_lng"), F.col("i_lat")), F.col("lat"), F.col("lng"), F.col("count")
    )).alias("j"))
    parts = [
        kpi, _scalar_rows(hours, periods),
        _rows(series, "trend_data", F.lit("hourly"), info=F.col("j")),
        _rows(cells, "heatmap_data", one, info=F.col("j")),
    ]
    if hotspots is not None:
        ranking = hotspot_ranking(hotspots).agg(F.to_json(_ordered(
            F.col("rank_no"), F.col("rank_no").alias("rank"),
            F.concat(F.lit("#"), F.col("cluster_id")).alias("name"), F.col("lng"), F.col("lat"), F.col("count"),
        )).alias("j"))
        parts.append(_rows(ranking, "hotspot_ranking", F.lit("top15"), info=F.col("j")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.withColumn("updated_at", F.current_timestamp())


def _document(cache: DataFrame, stat_type: str, key: str, schema: str) -> DataFrame:
    row = cache.where((F.col("stat_type") == stat_type) & (F.col("stat_key") == key))
    return row.select(F.from_json("extra_info", schema).alias("doc"))


def read_kpis(cache: DataFrame) -> DataFrame:
    return _document(cache, "kpi_summary", "all", KPI_JSON).select("doc.*")


def read_heatmap(cache: DataFrame) -> DataFrame:
    return _document(cache, "heatmap_data", "all", HEAT_JSON).select(F.inline("doc"))


def read_ranking(cache: DataFrame) -> DataFrame:
    return _document(cache, "hotspot_ranking", "top15", RANKING_JSON).select(F.inline("doc")).orderBy("rank")


def read_trend(cache: DataFrame) -> DataFrame:
    doc = _document(cache, "trend_data", "hourly", TREND_JSON).select("doc.*")
    zipped = F.arrays_zip("hours", "trips", "speeds", "distances")
    return doc.select(F.inline(zipped)).orderBy("hours")


def read_periods(cache: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    order = F.array_position(F.array(*[F.lit(name) for name, _, _ in p.periods]), F.col("stat_key"))
    rows = cache.where(F.col("stat_type") == "period_trips")
    return rows.orderBy(order).select(F.col("stat_key").alias("label"), F.col("stat_value").cast("long").alias("trips"))


def read_hourly(cache: DataFrame) -> DataFrame:
    rows = cache.where(F.col("stat_type") == "hourly_trips").orderBy("stat_key")
    return rows.select(F.col("stat_key").alias("hour"), F.col("stat_value").cast("long").alias("trips"))


def read_dashboard(cache: DataFrame) -> DataFrame:
    """Everything in one row from one scan of the cache."""
    def doc(stat_type: str, schema: str) -> Column:
        text = F.max(F.when(F.col("stat_type") == stat_type, F.col("extra_info")))
        return F.from_json(text, schema)

    def listed(stat_type: str) -> Column:
        entry = F.struct("stat_key", F.col("stat_value").cast("long").alias("trips"))
        return F.sort_array(F.collect_list(F.when(F.col("stat_type") == stat_type, entry)))

    return cache.agg(
        doc("kpi_summary", KPI_JSON).alias("kpis"),
        doc("heatmap_data", HEAT_JSON).alias("heatmap"),
        doc("hotspot_ranking", RANKING_JSON).alias("ranking"),
        doc("trend_data", TREND_JSON).alias("trend"),
        listed("period_trips").alias("periods"),
        listed("hourly_trips").alias("hourly"),
    )
