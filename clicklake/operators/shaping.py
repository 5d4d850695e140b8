"""Sampling, sessionisation, length limits and filters applied before metrics."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clicklake.functions.numeric import seconds_between
from clicklake.functions.period import time_of_day
from clicklake.functions.scan import SLICE_ROWS, scan_slices, sliced_keys
from clicklake.operators.engagement import user_engagement_segments


def sample_sessions(log: DataFrame, rate: float, key: str = "session_id") -> DataFrame:
    """Keep whole sessions with probability ``rate``, the same ones on every run and in every engine.

    A session stays if the first 8 digits of the MD5 of its key, as text, are below the rate's share of 16^8.
    """
    if not 0 <= rate <= 1:
        raise ValueError("rate must lie between 0 and 1")
    if rate == 1:
        return log
    draw = F.conv(F.substring(F.md5(F.col(key).cast("string").cast("binary")), 1, 8), 16, 10).cast("long")
    return log.where(draw < round(rate * 16**8))


def sessionize(
    log: DataFrame,
    timeout_seconds: float = 1800,
    user: str = "user_id",
    tie_break: str = "event_id",
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Add ``session_number`` (0-based per user): a new one after a long pause.

    ``tie_break`` is any column of the log; rows of one time lie in one session whatever it says.
    """
    order = ["timestamp", tie_break]
    rows = log.where(F.col(user).isNotNull())
    sliced = sliced_keys(rows, [user], order, slice_rows)
    spaced = scan_slices(sliced, [user], order, previous={"_before": F.col("timestamp")})
    starts = F.col("_before").isNotNull() & (
        seconds_between(F.col("_before"), F.col("timestamp")) > timeout_seconds
    )
    return scan_slices(
        spaced, [user], order, sums={"session_number": starts.cast("int")}
    ).drop("_before", "_large", "_slice")


def limit_session_length(
    queries: DataFrame,
    min_queries: int = 2,
    max_queries: int | None = 50,
    order: Sequence[str] = ("timestamp", "query_id"),
) -> DataFrame:
    """Sessions with at least ``min_queries``, and of those the first ``max_queries``.

    The cap is the feature here (long sessions are outliers). It is a top-n per
    session, which Spark applies on the map side before the shuffle.
    """
    rows = queries.where(F.col("session_id").isNotNull())
    if max_queries is not None:
        along = Window.partitionBy("session_id").orderBy(*order)
        rows = (
            rows.withColumn("_nth", F.row_number().over(along))
            .where(F.col("_nth") <= max_queries)
            .drop("_nth")
        )
    if min_queries > 1:
        long_enough = (
            queries.groupBy("session_id")
            .agg(F.count(F.lit(1)).alias("_n"))
            .where(F.col("_n") >= min_queries)
            .select("session_id")
        )
        rows = rows.join(long_enough, "session_id", "left_semi")
    return rows


def with_user_type(sessions: DataFrame, start: str = "session_start") -> DataFrame:
    """Add ``user_type``: 'new' for the first session of a user, else 'returning'."""
    firsts = (
        sessions.where(F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(F.min_by("session_id", F.struct(start, "session_id")).alias("_first"))
    )
    kind = F.when(F.col("session_id") == F.col("_first"), "new").otherwise(F.lit("returning"))
    return sessions.join(firsts, "user_id").withColumn("user_type", kind).drop("_first")


# Engagement levels offered as a filter and the classes behind them.
ENGAGEMENT_LEVELS = {
    "high engagement": ["highly_engaged"],
    "medium engagement": ["moderately_engaged"],
    "low engagement": ["low_engaged", "disengaged"],
}


@dataclass(frozen=True)
class LogFilter:
    """Optional conditions on a log; None or 'All' means no condition.

    ``engagement`` picks users by their engagement class over the whole log.
    ``location`` and ``query_type`` need a column of that name.
    """

    start: dt.date | str | None = None
    end: dt.date | str | None = None
    device: str | None = None
    location: str | None = None
    query_type: str | None = None
    user_type: str | None = None
    time_of_day: str | None = None
    segment: str | None = None
    engagement: str | None = None

    def apply(self, events: DataFrame) -> DataFrame:
        kept = events
        day = F.to_date("timestamp")
        if self.start is not None:
            kept = kept.where(day >= F.lit(str(self.start)).cast("date"))
        if self.end is not None:
            kept = kept.where(day <= F.lit(str(self.end)).cast("date"))
        for column, wanted in (
            ("device_type", self.device),
            ("location", self.location),
            ("query_type", self.query_type),
            ("user_segment", self.segment),
        ):
            if _given(wanted):
                kept = kept.where(F.lower(column) == wanted.lower())
        if _given(self.time_of_day):
            kept = kept.where(time_of_day(F.col("timestamp")) == self.time_of_day.lower())
        if _given(self.user_type):
            spans = events.groupBy("user_id", "session_id").agg(
                F.min("timestamp").alias("session_start")
            )
            chosen = with_user_type(spans).where(F.col("user_type") == self.user_type.lower())
            kept = kept.join(chosen.select("user_id", "session_id"), ["user_id", "session_id"], "left_semi")
        if _given(self.engagement):
            classes = ENGAGEMENT_LEVELS[self.engagement.lower()]
            chosen = user_engagement_segments(events).where(
                F.col("engagement_segment").isin(classes)
            )
            kept = kept.join(chosen.select("user_id"), "user_id", "left_semi")
        return kept


def _given(value: str | None) -> bool:
    return value is not None and value.lower() != "all"
