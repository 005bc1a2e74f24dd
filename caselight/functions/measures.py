"""Ratios, deviations, ages and clock arithmetic."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F


def moment(value: Column | str | dt.datetime) -> Column:
    """A zone-less timestamp column from text, a datetime or a column."""
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    if isinstance(value, dt.datetime):
        value = value.isoformat(sep=" ")
    return F.lit(value).cast("timestamp_ntz")


def percent(part: Column, whole: Column) -> Column:
    """``part / whole * 100``; null when the whole is zero or null."""
    return F.when(whole != 0, part / whole * 100)


def deviation(current: Column, baseline: Column) -> Column:
    """Absolute relative deviation. Against a zero baseline any rows at all count as a full deviation."""
    return (
        F.when(baseline == 0, F.when(current > 0, 1.0).otherwise(0.0))
        .otherwise(F.abs(current - baseline) / baseline)
    )


def seconds_between(start: Column, end: Column) -> Column:
    """Seconds with microseconds as a double. Both are zone-less, so the session time zone plays no part."""
    span = end.cast("timestamp_ntz") - start.cast("timestamp_ntz")
    return span.cast("interval second").cast("decimal(20,6)").cast("double")


def minutes_between(start: Column, end: Column) -> Column:
    return seconds_between(start, end) / 60


def hours_between(start: Column, end: Column) -> Column:
    return seconds_between(start, end) / 3600


def local_time(utc: Column, pattern: str = "yyyy-MM-dd hh:mm a", zone: str = "America/New_York") -> Column:
    """UTC timestamp rendered on the wall clock of a zone, daylight saving included."""
    return F.date_format(F.convert_timezone(F.lit("UTC"), F.lit(zone), utc.cast("timestamp_ntz")), pattern)
