"""Cleaning of pings: box filter and speed repair, lazily and without counting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tripweave.functions.geo import in_box
from tripweave.operators.sequence import ORDER, Sequence, sequence
from tripweave.params import DEFAULTS, Params


def filter_box(pings: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """Rule 1. Keeps pings inside the box, bounds included; reaches the scan."""
    return pings.where(in_box(F.col("lng"), F.col("lat"), p))


def valid_speed(speed: Column, p: Params = DEFAULTS) -> Column:
    """Rule 2a. The speed if plausible, else null."""
    return F.when(speed.between(p.speed_min, p.speed_max), speed)


def mark_speed(pings: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    return pings.withColumn("speed", valid_speed(F.col("speed"), p))


def repair_speed(seq: Sequence, method: str = "linear") -> Sequence:
    """Rules 2b and 2c. Fills implausible speeds inside a vehicle's day.

    ``linear`` interpolates by row between the nearest plausible neighbours and
    takes the nearest one at both ends; ``ffill`` takes the previous plausible
    speed, else the next. Days without any plausible speed are dropped.
    """
    if method not in ("linear", "ffill"):
        raise ValueError(f"unknown fill method {method!r}")
    marked = mark_speed(seq.df, seq.params)
    rows = marked.withColumn("rn", F.row_number().over(seq.window()).cast("long"))
    known = F.when(F.col("speed").isNotNull(), F.struct(F.col("speed").alias("v"), F.col("rn").alias("r")))
    upto = (Window.unboundedPreceding, 0)
    rows = rows.withColumns({
        "prev": F.last(known, True).over(seq.window().rowsBetween(*upto)),
        "next": F.last(known, True).over(seq.backward().rowsBetween(*upto)),
    })
    if seq.split:
        when_known = F.when(F.col("speed").isNotNull(), F.struct(*ORDER))
        ends = F.struct(F.col("speed").alias("v"), F.col("rn").alias("r"))
        shifted = lambda c: F.struct(
            F.col(f"{c}.v").alias("v"), (F.col(f"{c}.r") + F.col("shift")).alias("r")
        )
        held = lambda c: F.when(F.col(c).isNotNull(), shifted(c))
        rows = seq.carry(
            rows,
            [
                F.count(F.lit(1)).alias("n"),
                F.max_by(ends, when_known).alias("chunk_last"),
                F.min_by(ends, when_known).alias("chunk_first"),
            ],
            lambda before, after: [
                {"shift": F.coalesce(F.sum("n").over(before), F.lit(0))},
                {
                    "shift": F.col("shift"),
                    "prev_chunks": F.last(held("chunk_last"), True).over(before),
                    "next_chunks": F.last(held("chunk_first"), True).over(after),
                },
            ],
        ).withColumn("shift", F.coalesce("shift", F.lit(0)))
        rows = rows.withColumns({
            "prev": F.coalesce(held("prev"), "prev_chunks"),
            "next": F.coalesce(held("next"), "next_chunks"),
            "rn": F.col("rn") + F.col("shift"),
        }).drop("shift", "prev_chunks", "next_chunks")
    before, after = F.col("prev.v"), F.col("next.v")
    if method == "ffill":
        filled = F.coalesce("speed", before, after)
    else:
        width = F.col("next.r") - F.col("prev.r")
        between = before + (after - before) * (F.col("rn") - F.col("prev.r")) / F.when(width > 0, width)
        filled = F.coalesce("speed", between, before, after)
    fixed = rows.withColumn("speed", filled).where(F.col("speed").isNotNull())
    return seq.on(fixed.drop("prev", "next", "rn"))


def drop_speedless(seq: Sequence) -> Sequence:
    """The rows rule 2 keeps, without repairing: days with any plausible speed.

    Trips hold no ping speed, so the trip pipeline needs only this.
    """
    known = valid_speed(F.col("speed"), seq.params).isNotNull().cast("int")
    rows = seq.df.withColumn("speeds", F.max(known).over(seq.frame()))
    if seq.split:
        rows = seq.carry(
            rows,
            [F.max("speeds").alias("s")],
            lambda before, after: [{"other_speeds": F.greatest(F.max("s").over(before), F.max("s").over(after))}],
        ).withColumn("speeds", F.greatest("speeds", "other_speeds")).drop("other_speeds")
    return seq.on(rows.where(F.col("speeds") == 1).drop("speeds"))


def clean_pings(pings: DataFrame, p: Params = DEFAULTS, fill: str = "linear") -> Sequence:
    """Rules 1 and 2 in order."""
    return repair_speed(sequence(filter_box(pings, p), p, pings), fill)
