"""Time of day without a date: parsed once to seconds, formatted at the end."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

DAY_S = 86_400


def parse_seconds(text: Column) -> Column:
    """``H:mm:ss`` or ``HH:mm:ss`` to seconds of the day; null for anything else."""
    t = F.try_to_timestamp(F.trim(text), F.lit("H:mm:ss"))
    return (F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)).cast("long")


def format_seconds(sec: Column) -> Column:
    return F.format_string(
        "%02d:%02d:%02d", F.floor(sec / 3600), F.floor(sec % 3600 / 60), sec % 60
    )


def seconds_of(ts: Column) -> Column:
    return (F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)).cast("long")


def hour_of(sec: Column) -> Column:
    return F.floor(sec / 3600).cast("int")


def hour_label(hour: Column) -> Column:
    return F.format_string("%02d:00", hour)


def elapsed_seconds(start: Column, end: Column) -> Column:
    """Seconds from start to end; an end before the start is on the next day."""
    return end - start + F.when(end < start, DAY_S).otherwise(0)
