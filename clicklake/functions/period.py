"""Calendar labels used as group keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PERIODS = ("daily", "weekly", "monthly")
GRANULARITIES = ("hour", "day", "week", "month")


def period_label(ts: Column, period: str) -> Column:
    """Date for ``daily``, Monday/Sunday text for ``weekly``, yyyy-MM for ``monthly``.

    ``hour``, ``day``, ``week`` and ``month`` give the start of the bucket instead.
    """
    if period in GRANULARITIES:
        return bucket_start(ts, period)
    day = F.to_date(ts)
    if period == "daily":
        return day
    if period == "weekly":
        monday = F.trunc(day, "week")
        return F.concat_ws("/", monday.cast("string"), F.date_add(monday, 6).cast("string"))
    if period == "monthly":
        return F.date_format(day, "yyyy-MM")
    raise ValueError(f"unsupported period {period!r}; expected one of {PERIODS + GRANULARITIES}")


def bucket_start(ts: Column, granularity: str) -> Column:
    """Start of the hour, day, week or month that holds ``ts`` (zone-less)."""
    day = F.to_date(ts)
    if granularity == "hour":
        return F.timestamp_add("HOUR", F.hour(ts), day.cast("timestamp_ntz"))
    if granularity == "day":
        return day.cast("timestamp_ntz")
    if granularity in ("week", "month"):
        return F.trunc(day, granularity).cast("timestamp_ntz")
    raise ValueError(f"unsupported granularity {granularity!r}; expected one of {GRANULARITIES}")


def time_of_day(ts: Column) -> Column:
    """night 0-5, morning 6-11, afternoon 12-17, evening 18-23."""
    hour = F.hour(ts)
    return (
        F.when(hour < 6, "night")
        .when(hour < 12, "morning")
        .when(hour < 18, "afternoon")
        .otherwise("evening")
    )
