"""Demand over the day and distributions of trip measures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tripweave.functions.bins import bin_no, bins_table, histogram
from tripweave.functions.clock import elapsed_seconds, format_seconds, hour_of
from tripweave.functions.geo import equirect_km
from tripweave.functions.stats import (
    exact_percentiles, safe_ratio, sample_kurtosis, sample_skewness,
)
from tripweave.params import (
    DEFAULTS, DISTANCE_EDGES, DISTANCE_LABELS, DURATION_EDGES, DURATION_LABELS,
    SPEED_EDGES, SPEED_LABELS, Params, clock_seconds,
)


def _total_minutes() -> Column:
    """Durations are whole seconds: their sum is exact, whatever the order of rows."""
    return F.sum("duration_s") / F.lit(60.0)


def _mean_minutes() -> Column:
    return _total_minutes() / F.count("duration_s")


def with_derived(trips: DataFrame) -> DataFrame:
    """Add hour, duration and distance where an input lacks them.

    The fallback distance is the flat-earth one.
    """
    have = set(trips.columns)
    if "hour" not in have:
        trips = trips.withColumn("hour", hour_of(F.col("s_sec")))
    if "duration_s" not in have:
        seconds = (
            F.round(F.col("duration_min") * 60).cast("long")
            if "duration_min" in have
            else elapsed_seconds(F.col("s_sec"), F.col("e_sec"))
        )
        trips = trips.withColumn("duration_s", seconds)
    if "duration_min" not in have:
        trips = trips.withColumn("duration_min", F.col("duration_s") / F.lit(60.0))
    if "distance_km" not in have:
        km = equirect_km(F.col("s_lng"), F.col("s_lat"), F.col("e_lng"), F.col("e_lat"))
        trips = trips.withColumn("distance_km", km)
    return trips


def hourly_stats(trips: DataFrame) -> DataFrame:
    """24 rows: trips, mean and exact median duration, mean distance, vehicles.

    One pass with two grouping sets. Durations are whole seconds, so the
    (hour, duration) set is bounded by the clock and its weighted median is exact.
    """
    sets = trips.groupingSets(
        [["hour", "duration_s"], ["hour", "vehicle_id"]], "hour", "duration_s", "vehicle_id"
    ).agg(
        F.grouping("vehicle_id").alias("by_duration"),
        F.count(F.lit(1)).alias("n"),
        F.sum("distance_km").alias("km"),
        F.count("distance_km").alias("n_km"),
    )
    timed = F.col("by_duration") == 1
    n = F.when(timed, F.col("n"))
    stats = sets.groupBy("hour").agg(
        F.sum(n).alias("trip_count"),
        (F.sum(n * F.col("duration_s")) / F.lit(60.0)
         / F.sum(F.when(timed & F.col("duration_s").isNotNull(), F.col("n")))).alias("avg_duration"),
        F.percentile(F.when(timed, F.col("duration_s") / F.lit(60.0)), 0.5, F.col("n")).alias("median_duration"),
        (F.sum(F.when(timed, F.col("km"))) / F.sum(F.when(timed, F.col("n_km")))).alias("avg_distance"),
        F.count_if(~timed & F.col("vehicle_id").isNotNull()).alias("unique_vehicles"),
    )
    return on_hours(stats)


def on_hours(stats: DataFrame) -> DataFrame:
    """24 rows, zeros where there is no row."""
    spine = stats.sparkSession.range(24).select(F.col("id").cast("int").alias("hour"))
    return spine.join(F.broadcast(stats), "hour", "left").fillna(0)  # at most 24 rows


def hourly_counts(trips: DataFrame) -> DataFrame:
    return on_hours(trips.groupBy("hour").agg(F.count(F.lit(1)).alias("trip_count")))


def hourly_trend(trips: DataFrame) -> DataFrame:
    """24 rows: trips, mean speed, mean distance."""
    return on_hours(
        trips.groupBy("hour").agg(
            F.count(F.lit(1)).alias("trip_count"),
            F.avg("avg_speed").alias("avg_speed"),
            F.avg("distance_km").alias("avg_distance"),
        )
    )


def peak_hours(hourly: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """One row from the 24: mean, threshold, hours above it, the top hour."""
    level = Window.partitionBy()  # 24 rows
    rows = hourly.select(
        "hour", "trip_count", F.avg("trip_count").over(level).alias("mean_trips")
    )
    above = F.col("trip_count") > F.col("mean_trips") * F.lit(p.peak_factor)

    def listed(cond: Column) -> Column:
        return F.array_sort(F.collect_list(F.when(cond, F.col("hour"))))

    return rows.agg(
        F.first("mean_trips").alias("mean_hourly_trips"),
        (F.first("mean_trips") * F.lit(p.peak_factor)).alias("peak_threshold"),
        listed(above).alias("peak_hours"),
        listed(above & F.col("hour").between(*p.morning_hours)).alias("morning_peak"),
        listed(above & F.col("hour").between(*p.evening_hours)).alias("evening_peak"),
        F.max_by("hour", F.struct("trip_count", -F.col("hour"))).alias("peak_hour_max"),
        F.max("trip_count").alias("peak_max_trips"),
    )


def hourly_reference_lines(hourly: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """The hourly chart with its mean, peak threshold and period bands."""
    level = Window.partitionBy()  # 24 rows
    mean = F.avg("trip_count").over(level)
    names = F.array_compact(F.array(*[
        F.when((F.col("hour") * 3600 >= clock_seconds(a)) & (F.col("hour") * 3600 < clock_seconds(b)), F.lit(name))
        for name, a, b in p.periods
    ]))
    return hourly.select(
        "hour", "trip_count",
        mean.alias("mean_trips"),
        (mean * F.lit(p.peak_factor)).alias("peak_threshold"),
        (F.col("trip_count") > mean * F.lit(p.peak_factor)).alias("is_peak"),
        F.try_element_at(names, F.lit(1)).alias("period_name"),
    )


def periods_of(sec: Column, p: Params = DEFAULTS) -> Column:
    """Array of the period numbers a second of the day belongs to."""
    return F.array_compact(F.array(*[
        F.when((sec >= clock_seconds(a)) & (sec < clock_seconds(b)), F.lit(i))
        for i, (_, a, b) in enumerate(p.periods)
    ]))


def in_periods(trips: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """Trips with their ``period_no``; trips in no period are left out."""
    return trips.withColumn("period_no", F.explode(periods_of(F.col("s_sec"), p)))


def periods_table(trips: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """period_no, period_name."""
    return bins_table(trips.sparkSession, [name for name, _, _ in p.periods]).toDF("period_no", "period_name")


def period_stats(trips: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """One row per period, empty ones with null means; shares are of all trips.

    Number -1 collects trips of no period, so that the total needs no second pass.
    """
    periods = periods_of(F.col("s_sec"), p)
    numbered = trips.withColumns({
        "period_no": F.explode(F.when(F.size(periods) > 0, periods).otherwise(F.array(F.lit(-1)))),
        "share": F.lit(1.0) / F.greatest(F.size(periods), F.lit(1)),
    })
    stats = numbered.groupBy("period_no").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("share").alias("whole"),
        _mean_minutes().alias("avg_duration"),
        F.avg("distance_km").alias("avg_distance"),
        F.count_distinct("vehicle_id").alias("vehicles"),
    )
    empty = trips.sparkSession.range(len(p.periods)).select(
        F.col("id").cast("int").alias("period_no"), F.lit(0).alias("n"), F.lit(0.0).alias("whole"),
        F.lit(None).cast("double").alias("avg_duration"), F.lit(None).cast("double").alias("avg_distance"),
        F.lit(0).alias("vehicles"),
    )
    rows = stats.unionByName(empty).groupBy("period_no").agg(
        *[F.max(c).alias(c) for c in ("n", "whole", "avg_duration", "avg_distance", "vehicles")]
    ).withColumn("total", F.round(F.sum("whole").over(Window.partitionBy())))  # a row per period
    name = lambda texts: F.element_at(F.array(*[F.lit(t) for t in texts]), F.col("period_no") + 1)
    return rows.where(F.col("period_no") >= 0).select(
        "period_no",
        name([n for n, _, _ in p.periods]).alias("period_name"),
        name([f"{a}-{b}" for _, a, b in p.periods]).alias("time_range"),
        F.col("n").alias("trip_count"),
        safe_ratio(F.col("n"), F.col("total"), 100.0).alias("ratio_pct"),
        "avg_duration", "avg_distance", F.col("vehicles").alias("active_vehicles"),
    )


DURATION_FRACTIONS = (0.25, 0.5, 0.75, 0.9, 0.95, 0.99)
DISTANCE_FRACTIONS = (0.25, 0.5, 0.75, 0.9, 0.95)


def duration_stats(trips: DataFrame) -> DataFrame:
    """Moments and exact percentiles of duration, from the per-second counts.

    Durations are whole seconds below two days, so the counts are a small table.
    """
    seconds = (
        trips.where(F.col("duration_s").isNotNull())
        .groupBy("duration_s").agg(F.count(F.lit(1)).alias("n"))
        .withColumn("x", F.col("duration_s") / F.lit(60.0))
    )
    every = Window.partitionBy()  # bounded by the seconds of a day
    dev = F.col("x") - F.sum(F.col("x") * F.col("n")).over(every) / F.sum("n").over(every)
    rows = seconds.withColumn("dev", dev)
    power = lambda k: F.sum(F.col("n") * F.pow("dev", F.lit(float(k))))
    agg = rows.agg(
        F.sum("n").alias("n"),
        (F.sum(F.col("duration_s") * F.col("n")) / F.lit(60.0) / F.sum("n")).alias("mean"),
        power(2).alias("m2"), power(3).alias("m3"), power(4).alias("m4"),
        F.percentile("x", list(DURATION_FRACTIONS), F.col("n")).alias("q"),
        F.min("x").alias("min"), F.max("x").alias("max"),
    )
    n = F.col("n").cast("double")
    return agg.select(
        F.coalesce("n", F.lit(0)).alias("n"), "mean", F.col("q")[1].alias("median"),
        F.when(n > 1, F.sqrt(F.col("m2") / (n - 1))).alias("std"),
        sample_skewness(n, F.col("m2"), F.col("m3")).alias("skewness"),
        sample_kurtosis(n, F.col("m2"), F.col("m4")).alias("kurtosis"),
        *[F.col("q")[i].alias(f"p{round(f * 100)}") for i, f in enumerate(DURATION_FRACTIONS)],
        "min", "max",
    )


def distance_stats(trips: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """Mean, deviation, exact percentiles, shares of short and long trips."""
    q = exact_percentiles(trips, "distance_km", list(DISTANCE_FRACTIONS))
    km = F.col("distance_km")
    literal = lambda v: F.lit(v).cast("double")
    return trips.agg(
        F.count("distance_km").alias("n"),
        F.avg(km).alias("mean"),
        literal(q[1]).alias("median"),
        F.stddev_samp(km).alias("std"),
        *[literal(v).alias(f"p{round(f * 100)}") for f, v in zip(DISTANCE_FRACTIONS, q)],
        (F.avg(F.when(km < p.short_km, 1.0).otherwise(0.0)) * 100).alias("short_trip_ratio"),
        (F.avg(F.when(km > p.long_km, 1.0).otherwise(0.0)) * 100).alias("long_trip_ratio"),
    )


def _with_shares(hist: DataFrame) -> DataFrame:
    every = Window.partitionBy()  # one row per bin
    return hist.withColumns({
        "share_pct": safe_ratio(F.col("n"), F.sum("n").over(every), 100.0),
        "rank_no": F.row_number().over(Window.orderBy(F.desc("n"), "bin_no")),
    })


def duration_histogram(trips: DataFrame) -> DataFrame:
    return _with_shares(histogram(trips, "duration_min", DURATION_EDGES, DURATION_LABELS))


def distance_histogram(trips: DataFrame) -> DataFrame:
    return _with_shares(histogram(trips, "distance_km", DISTANCE_EDGES, DISTANCE_LABELS))


def speed_histogram(trips: DataFrame) -> DataFrame:
    return _with_shares(histogram(trips, "avg_speed", SPEED_EDGES, SPEED_LABELS))


def speed_stats(trips: DataFrame) -> DataFrame:
    """Mean, median, total, and the bin the mean falls in."""
    q = exact_percentiles(trips, "avg_speed", [0.5])
    return trips.agg(
        F.avg("avg_speed").alias("mean"),
        F.lit(q[0]).cast("double").alias("median"),
        F.count(F.lit(1)).alias("total"),
    ).withColumn("mean_bin", bin_no(F.col("mean"), SPEED_EDGES))


def vehicle_efficiency(trips: DataFrame) -> DataFrame:
    """One row per vehicle."""
    per = trips.groupBy("vehicle_id").agg(
        F.count(F.lit(1)).alias("trip_count"),
        _total_minutes().alias("total_duration"),
        F.sum("distance_km").alias("total_distance"),
        _mean_minutes().alias("avg_duration"),
        F.avg("distance_km").alias("avg_distance"),
        F.min("s_sec").alias("first"),
        F.max("e_sec").alias("last"),
    )
    return per.withColumns({
        "first_trip": format_seconds(F.col("first")), "last_trip": format_seconds(F.col("last")),
    }).drop("first", "last")


def top_vehicles(efficiency: DataFrame, n: int = 15) -> DataFrame:
    return efficiency.orderBy(F.desc("trip_count"), "vehicle_id").limit(n)


def kpis(trips: DataFrame) -> DataFrame:
    """One row: trips, vehicles, means, trips per vehicle, top hour and its trips.

    One pass: the grouping sets give the total, the vehicles and the hours.
    """
    sets = trips.groupingSets([[], ["vehicle_id"], ["hour"]], "vehicle_id", "hour").agg(
        F.grouping_id().alias("g"),
        F.count(F.lit(1)).alias("n"),
        _mean_minutes().alias("duration_min"),
        *[F.avg(c).alias(c) for c in ("distance_km", "avg_speed")],
    )
    # grouping_id bits: vehicle_id, hour; a set bit means "not grouped by"
    total, vehicle, hour = F.col("g") == 3, F.col("g") == 1, F.col("g") == 2
    hourly = F.when(hour, F.struct("n", -F.col("hour")))
    one = lambda c: F.max(F.when(total, F.col(c)))
    return sets.agg(
        F.coalesce(one("n"), F.lit(0)).alias("total_trips"),
        F.count_if(vehicle & F.col("vehicle_id").isNotNull()).alias("total_vehicles"),
        one("duration_min").alias("avg_duration"),
        one("distance_km").alias("avg_distance"),
        one("avg_speed").alias("avg_speed"),
        F.coalesce(F.max_by("hour", hourly), F.lit(0)).alias("peak_hour"),
        F.coalesce(F.max(F.when(hour, F.col("n"))), F.lit(0)).alias("peak_trips"),
    ).withColumn("trips_per_vehicle", safe_ratio(F.col("total_trips"), F.col("total_vehicles")))


def duration_distance_correlation(trips: DataFrame) -> DataFrame:
    return trips.agg(
        F.corr("duration_min", "distance_km").alias("correlation"),
        F.count(F.lit(1)).alias("n"),
    )
