"""Column helpers that pin down rounding, ratios and clock arithmetic."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def half_even(column: Column, digits: int | None) -> Column:
    """Round half to even; ``None`` leaves the value alone.

    The scaled value is cleaned of float noise first, so a tie is decided the same
    way whatever the order in which partitions were added up.
    """
    if digits is None:
        return column
    scale = F.lit(float(10**digits))
    return F.rint(F.round(column * scale, 6)) / scale


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` with 0 where the denominator is not positive."""
    return F.when(denominator > 0, numerator / denominator).otherwise(F.lit(0.0))


def mean_of_flag(flag: Column) -> Column:
    """Share of true among the non-null flags."""
    return F.avg(flag.cast("int"))


def epoch_micros(ts: Column) -> Column:
    """Microseconds since 1970 of a zone-less timestamp, whatever the session zone."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)


def seconds_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(1e6)


def capped(column: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(float(low)), F.least(F.lit(float(high)), column))


def merge_measures(frames: Sequence[DataFrame], by: Sequence[str] = ()) -> DataFrame:
    """Put the measures of frames with one row per ``by`` value side by side."""
    merged = frames[0]
    for frame in frames[1:]:
        merged = merged.unionByName(frame, allowMissingColumns=True)
    measures = [F.max(c).alias(c) for c in merged.columns if c not in by]
    return merged.groupBy(*by).agg(*measures) if by else merged.agg(*measures)
