"""Data-quality profile of pings and the cleaning funnel."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tripweave.functions.bins import bin_no, bins_table
from tripweave.functions.geo import in_box
from tripweave.functions.stats import exact_median, safe_ratio
from tripweave.operators.clean import valid_speed
from tripweave.operators.sequence import KEYS
from tripweave.operators.trips import REJECT_REASONS, measure, raw_trips, reject_reason
from tripweave.params import DEFAULTS, PING_SPEED_EDGES, PING_SPEED_LABELS, Params
from tripweave.session import cut

CHECKED = ("vehicle_id", "sec_of_day", "lng", "lat", "open_status", "speed")


def _profile_row(pings: DataFrame, p: Params) -> DataFrame:
    known = F.col("lng").isNotNull() & F.col("lat").isNotNull()
    return pings.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("vehicle_id").alias("vehicles"),
        F.min("sec_of_day").alias("first_sec"),
        F.max("sec_of_day").alias("last_sec"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in CHECKED],
        F.count_if(known & ~in_box(F.col("lng"), F.col("lat"), p)).alias("out_of_box"),
        F.count_if(F.col("open_status") == 0).alias("occupied"),
        F.count_if(F.col("open_status") == 1).alias("vacant"),
        F.count_if(~F.col("open_status").isin(0, 1)).alias("other_status"),
        F.avg("speed").alias("speed_mean"),
        F.stddev_samp("speed").alias("speed_std"),
        F.max("speed").alias("speed_max"),
    )


def quality_profile(pings: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """Rows (metric, value, pct): one aggregation of the pings, turned upright."""
    median = exact_median(pings, "speed", keep=False)
    row = _profile_row(pings, p).withColumn("speed_median", F.lit(median).cast("double"))
    counted = ("out_of_box", "occupied", "vacant", "other_status")
    plain = (
        "rows", "vehicles", "first_sec", "last_sec", "speed_mean", "speed_median", "speed_std", "speed_max",
    )
    entries = [
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"), F.lit(None).cast("double").alias("pct"))
        for m in plain
    ] + [
        F.struct(
            F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"),
            safe_ratio(F.col(m), F.col("rows"), 100.0).alias("pct"),
        )
        for m in counted
    ]
    return row.select(F.inline(F.array(*entries)))


def null_profile(pings: DataFrame) -> DataFrame:
    """Rows (column_name, nulls, pct)."""
    row = pings.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in CHECKED],
    )
    entries = [
        F.struct(
            F.lit(c).alias("column_name"), F.col(c).alias("nulls"),
            safe_ratio(F.col(c), F.col("rows"), 100.0).alias("pct"),
        )
        for c in CHECKED
    ]
    return row.select(F.inline(F.array(*entries)))


def speed_segments(pings: DataFrame) -> DataFrame:
    """Speed bins; a speed of exactly 0 has its own bin 0, outside the labelled ones."""
    counts = (
        pings.select(
            F.when(F.col("speed") == 0, -1).otherwise(bin_no(F.col("speed"), PING_SPEED_EDGES)).alias("b")
        )
        .groupBy("b").agg(F.count(F.lit(1)).alias("n"))
    )
    table = bins_table(pings.sparkSession, ("0", *PING_SPEED_LABELS))
    total = counts.select(
        (F.col("b") + 1).alias("bin_no"), "n", F.sum("n").over(Window.partitionBy()).alias("total")  # 7 rows
    )
    return table.join(F.broadcast(total.where(F.col("bin_no").isNotNull())), "bin_no", "left").select(
        "bin_no", "label", F.coalesce("n", F.lit(0)).alias("n"),
        F.coalesce(safe_ratio(F.col("n"), F.col("total"), 100.0), F.lit(0.0)).alias("pct"),
    )


def cleaning_funnel(pings: DataFrame, p: Params = DEFAULTS, strict: bool = True) -> DataFrame:
    """Rows (step_no, step, rows_before, rows_after, removed, removal_pct).

    Steps 1 and 2 count pings; step 3 turns pings into trips; step 4 filters trips.
    Pings are counted per vehicle-day first (map-side); the counts are fixed and serve the
    ordering too, so the pings are read twice and shuffled once.
    """
    boxed = in_box(F.col("lng"), F.col("lat"), p)
    known = valid_speed(F.col("speed"), p).isNotNull()
    days = cut(pings.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("pings"),
        F.count_if(boxed).alias("boxed"),
        F.count_if(boxed & known).alias("known"),
    ))
    before = days.agg(
        F.sum("pings").alias("pings"),
        F.sum("boxed").alias("boxed"),
        F.sum(F.when(F.col("known") > 0, F.col("boxed")).otherwise(0)).alias("fed"),
        F.lit(None).cast("long").alias("trips"),
        F.lit(None).cast("long").alias("valid"),
    )
    none = F.lit(None).cast("long")
    counts = days.select(*KEYS, F.col("pings").alias("n"))
    after = measure(raw_trips(pings, p, strict, counts)).agg(
        none.alias("pings"), none.alias("boxed"), none.alias("fed"),
        F.count(F.lit(1)).alias("trips"),
        F.count_if(reject_reason(p).isNull()).alias("valid"),
    )
    row = before.unionByName(after).agg(*[
        F.coalesce(F.max(k), F.lit(0)).alias(k) for k in ("pings", "boxed", "fed", "trips", "valid")
    ])
    steps = (("box", "pings", "boxed"), ("speed", "boxed", "fed"), ("trips", "fed", "trips"), ("filter", "trips", "valid"))
    entries = [
        F.struct(
            F.lit(i + 1).alias("step_no"), F.lit(name).alias("step"),
            F.col(a).alias("rows_before"), F.col(b).alias("rows_after"),
            (F.col(a) - F.col(b)).alias("removed"),
            safe_ratio(F.col(a) - F.col(b), F.col(a), 100.0).alias("removal_pct"),
        )
        for i, (name, a, b) in enumerate(steps)
    ]
    return row.select(F.inline(F.array(*entries)))


def reject_counts(measured: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """Trips per first failed rule, every reason listed."""
    counts = measured.select(reject_reason(p).alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    table = bins_table(measured.sparkSession, REJECT_REASONS).toDF("reason_no", "reason")
    return table.join(F.broadcast(counts), "reason", "left").select(
        "reason_no", "reason", F.coalesce("n", F.lit(0)).alias("n")
    )
