"""Time buckets and calendar features.  All of them assume a UTC session."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values
RUSH_HOURS = (6, 7, 8, 9, 16, 17, 18, 19)


def hour_of(ts: Column) -> Column:
    return F.date_trunc("hour", ts)


def floor_minutes(ts: Column, minutes: int) -> Column:
    """Start of the ``minutes``-wide bucket, aligned to the epoch."""
    width = minutes * 60
    return F.timestamp_seconds(F.floor(F.unix_seconds(ts) / F.lit(width)) * F.lit(width))


def date_key(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def is_weekend_iso(ts: Column) -> Column:
    """Saturday and Sunday (the feature table's weekend)."""
    return F.weekday(ts).isin(5, 6)


def is_weekend_cairo(day: Column) -> Column:
    """Friday and Saturday (the calendar dimension's weekend)."""
    return F.weekday(day).isin(4, 5)


def is_rush_hour(ts: Column) -> Column:
    return F.hour(ts).isin(*RUSH_HOURS)


def cycle(value: Column, period: int) -> tuple[Column, Column]:
    """sin and cos of a periodic value, so that its last and first step are neighbours."""
    angle = value * F.lit(2 * math.pi / period)
    return F.sin(angle), F.cos(angle)
