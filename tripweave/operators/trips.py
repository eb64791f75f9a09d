"""Passenger trips from occupied/vacant changes, their measures and the trip filter.

Status 0 is occupied, 1 is vacant: a 1 -> 0 change starts a trip, 0 -> 1 ends it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tripweave.functions.clock import elapsed_seconds, hour_of
from tripweave.functions.geo import haversine_km
from tripweave.operators.clean import drop_speedless, filter_box
from tripweave.operators.sequence import KEYS, ORDER, Sequence, sequence
from tripweave.params import DEFAULTS, Params

RAW_COLUMNS = (
    "trip_id", "vehicle_id", "service_date",
    "s_sec", "s_lng", "s_lat", "e_sec", "e_lng", "e_lat",
)
# reasons in the order the trip filter tests them
REJECT_REASONS = ("no_measure", "too_short", "too_long", "too_near", "too_slow", "too_fast")


def status_changes(seq: Sequence, ends: bool = False) -> Sequence:
    """Pings where the status flips, with ``prev_status`` and ``change`` +1 or -1.

    A column ``prior_status``, where there is one, stands for the ping before the
    first of a day. ``ends`` keeps the last ping of every day and chunk as well, marked
    by ``is_end``; its ``change`` is null where the status does not flip.
    """
    w, there = seq.window(), F.lit(True)  # plain values: rows inside rows would double the work of the window
    rows = seq.df.withColumns({"prev": F.lag("open_status").over(w), "is_first": F.lag(there).over(w).isNull()})
    if ends:
        rows = rows.withColumn("is_end", F.lead(there).over(w).isNull())
    prev, cur, first = F.col("prev"), F.col("open_status"), F.col("is_first")
    if seq.split:
        boxed = F.struct(F.col("open_status").alias("status"))
        rows = seq.carry(
            rows,
            [F.max_by(boxed, F.struct(*ORDER)).alias("last_status")],
            lambda before, after: [{"carried": F.last("last_status").over(before)}],
        ).withColumns({
            "prev": F.when(first, F.col("carried.status")).otherwise(prev), "is_first": first & F.col("carried").isNull(),
        }).drop("carried")
    if "prior_status" in seq.df.columns:
        prev = F.when(first, F.col("prior_status")).otherwise(prev)
    change = F.when((prev == 1) & (cur == 0), 1).when((prev == 0) & (cur == 1), -1)
    rows = rows.withColumns({"prev_status": prev, "change": change}).drop("prev", "is_first")
    return seq.on(rows.where(F.col("change").isNotNull() | F.col("is_end") if ends else F.col("change").isNotNull()))


def _end_of(sec: str = "sec_of_day") -> Column:
    return F.struct(
        F.col(sec).alias("e_sec"), F.col("lng").alias("e_lng"), F.col("lat").alias("e_lat")
    )


def _shape(starts: DataFrame) -> DataFrame:
    return starts.select(
        F.col("seq").alias("trip_id"), "vehicle_id", "service_date",
        F.col("sec_of_day").alias("s_sec"), F.col("lng").alias("s_lng"), F.col("lat").alias("s_lat"),
        "end.e_sec", "end.e_lng", "end.e_lat",
    )


def started_trips(changes: Sequence) -> DataFrame:
    """Every start with the next end, or nulls where the day ends first.

    Exact for two-valued status, where changes alternate.
    """
    end = _end_of()
    rows = changes.df.withColumn("end", F.lead(end).over(changes.window()))
    if changes.split:
        rows = changes.carry(
            rows,
            [F.min_by(end, F.struct(*ORDER)).alias("first_change")],
            lambda before, after: [{"later": F.last("first_change").over(after)}],
        ).withColumn("end", F.coalesce("end", "later")).drop("later")
    return _shape(rows.where(F.col("change") == 1))


def started_trips_fifo(changes: Sequence) -> DataFrame:
    """Starts paired first-in-first-out with ends, for status with foreign values.

    With S starts and E ends so far, an end finds an open start unless S - E falls
    below its earlier minimum (and below 0). The n-th start belongs to the n-th end
    that found one.
    """
    w = changes.window()
    upto, earlier = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, -1)
    start, end = (F.col("change") == 1).cast("long"), (F.col("change") == -1).cast("long")
    rows = changes.df.withColumns({"s": F.sum(start).over(upto), "e": F.sum(end).over(upto)})
    rows = rows.withColumn("d", F.col("s") - F.col("e"))
    rows = rows.withColumn("low", F.min("d").over(earlier))
    if changes.split:
        rows = changes.carry(
            rows,
            [F.max("s").alias("n_s"), F.max("e").alias("n_e"), F.min("d").alias("min_d")],
            lambda before, after: [
                {"s0": F.coalesce(F.sum("n_s").over(before), F.lit(0)),
                 "e0": F.coalesce(F.sum("n_e").over(before), F.lit(0))},
                {"s0": F.col("s0"), "e0": F.col("e0"),
                 "low0": F.min(F.col("s0") - F.col("e0") + F.col("min_d")).over(before)},
            ],
        )
        s0, e0 = F.coalesce("s0", F.lit(0)), F.coalesce("e0", F.lit(0))
        rows = rows.withColumns({
            "s": F.col("s") + s0,
            "e": F.col("e") + e0,
            "d": F.col("d") + s0 - e0,
            "low": F.least(F.col("low") + s0 - e0, F.col("low0")),
        }).drop("s0", "e0", "low0")
    floor = F.least(F.lit(0), F.col("low"))  # least() skips nulls
    opened = F.col("change") == 1
    matched = (F.col("change") == -1) & (F.col("d") >= floor)
    # ends that found a start so far: all ends minus the depth of the minimum
    rank = F.when(opened, F.col("s")).when(matched, F.col("e") + floor)
    # one start and at most one end per rank; plain numbers keep this a hash aggregation
    first = lambda side, c: F.max(F.when(side, F.col(c)))
    pairs = (
        rows.withColumn("rank", rank)
        .where(F.col("rank").isNotNull())
        .groupBy(*KEYS, "rank")
        .agg(
            first(opened, "seq").alias("trip_id"), first(opened, "sec_of_day").alias("s_sec"),
            first(opened, "lng").alias("s_lng"), first(opened, "lat").alias("s_lat"),
            first(~opened, "sec_of_day").alias("e_sec"),
            first(~opened, "lng").alias("e_lng"), first(~opened, "lat").alias("e_lat"),
        )
    )
    return pairs.select(*RAW_COLUMNS)


def pair_trips(changes: Sequence, strict: bool = True) -> DataFrame:
    """Closed trips."""
    started = started_trips(changes) if strict else started_trips_fifo(changes)
    return started.where(F.col("e_sec").isNotNull())


def unclosed_trips(changes: Sequence, strict: bool = True) -> DataFrame:
    """One row: starts, starts without an end."""
    started = started_trips(changes) if strict else started_trips_fifo(changes)
    return started.agg(
        F.count(F.lit(1)).alias("starts"),
        F.count_if(F.col("e_sec").isNull()).alias("unclosed"),
    )


def raw_trips(
    pings: DataFrame, p: Params = DEFAULTS, strict: bool = True, counts: DataFrame | None = None
) -> DataFrame:
    """Rules 1 to 4: pings to unfiltered trips. One shuffle of pings."""
    ordered = sequence(filter_box(pings, p), p, pings, counts)
    return pair_trips(status_changes(drop_speedless(ordered)), strict)


def measure(trips: DataFrame) -> DataFrame:
    """Duration, distance, mean speed and start hour of raw trips.

    The distance comes out of an array of one: filters on it and on the speed are not pushed
    below, where each would work it out again and the generated code grows too large to be compiled.
    """
    duration = elapsed_seconds(F.col("s_sec"), F.col("e_sec"))
    minutes = F.col("duration_s") / F.lit(60.0)
    km = haversine_km(F.col("s_lng"), F.col("s_lat"), F.col("e_lng"), F.col("e_lat"))
    kmh = F.when(F.col("duration_s") > 0, F.col("distance_km") / (F.col("duration_min") / F.lit(60.0)))
    return (
        trips.withColumn("duration_s", duration)
        .withColumn("duration_min", minutes)
        .select("*", F.explode(F.array(km)).alias("distance_km"), hour_of(F.col("s_sec")).alias("hour"))
        .withColumn("avg_speed", kmh.otherwise(F.lit(0.0)))
    )


def reject_reason(p: Params = DEFAULTS) -> Column:
    """First condition of rule 5 a measured trip fails; null for a valid trip."""
    dur, km, kmh = F.col("duration_min"), F.col("distance_km"), F.col("avg_speed")
    return (
        F.when(dur.isNull() | km.isNull() | kmh.isNull(), "no_measure")
        .when(dur < p.trip_minutes_min, "too_short")
        .when(dur > p.trip_minutes_max, "too_long")
        .when(km < p.trip_km_min, "too_near")
        .when(kmh < p.trip_kmh_min, "too_slow")
        .when(kmh > p.trip_kmh_max, "too_fast")
    )


def filter_trips(measured: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """Rule 5, all bounds inclusive."""
    return measured.where(
        F.col("duration_min").between(p.trip_minutes_min, p.trip_minutes_max)
        & (F.col("distance_km") >= p.trip_km_min)
        & F.col("avg_speed").between(p.trip_kmh_min, p.trip_kmh_max)
    )


def clean_trips(od: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """Rule 5 alone, for input that already holds one row per trip."""
    return filter_trips(measure(od), p)


def trips_from_pings(pings: DataFrame, p: Params = DEFAULTS, strict: bool = True) -> DataFrame:
    """All five rules."""
    return clean_trips(raw_trips(pings, p, strict), p)


def rule5_rejects(measured: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """How many trips fail each condition by itself; one may fail several."""
    dur, km, kmh = F.col("duration_min"), F.col("distance_km"), F.col("avg_speed")
    return measured.agg(
        F.count(F.lit(1)).alias("trips"),
        F.count_if(dur < p.trip_minutes_min).alias("too_short"),
        F.count_if(dur > p.trip_minutes_max).alias("too_long"),
        F.count_if(km < p.trip_km_min).alias("too_near"),
        F.count_if(kmh < p.trip_kmh_min).alias("too_slow"),
        F.count_if(kmh > p.trip_kmh_max).alias("too_fast"),
    )
