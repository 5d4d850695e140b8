"""Engagement metrics from an event log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicklake.functions.numeric import (
    half_even,
    mean_of_flag,
    merge_measures,
    ratio_or_zero,
    seconds_between,
)
from clicklake.functions.period import period_label
from clicklake.functions.quantiles import exact_percentile
from clicklake.operators.sessions import (
    QUERY_KEY,
    clicks,
    event_order,
    searches,
    session_base,
    session_totals,
)


def _with_period(rows: DataFrame, by: Sequence[str], period: str | None) -> tuple[DataFrame, list]:
    """Add ``period`` (unless None) and drop rows with a null group key."""
    keys = list(by)
    if period is not None:
        rows = rows.withColumn("period", period_label(F.col("timestamp"), period))
        keys = ["period", *keys]
    for key in keys:
        rows = rows.where(F.col(key).isNotNull())
    return rows, keys


def click_through_rate(
    events: DataFrame,
    by: Sequence[str] = (),
    period: str | None = "daily",
    click_timeout: float | None = None,
) -> DataFrame:
    """Searches, clicked searches and their ratio, per period and ``by``.

    A clicked search counts in the period of its *click*; groups without a search
    do not appear. ``period=None`` gives the rate per ``by`` only, or overall.
    ``click_timeout`` keeps only clicks at most that many seconds after the search.
    """
    shown, keys = _with_period(searches(events), by, period)
    hit, _ = _with_period(clicks(events), by, period)
    for key in QUERY_KEY:
        hit = hit.where(F.col(key).isNotNull())
    if click_timeout is not None:
        # The shortest wait is from the last search to the first click; one row per
        # query on either side, however many clicks it has.
        hit = hit.groupBy(*keys, *QUERY_KEY).agg(F.min("timestamp").alias("_clicked_at"))
        asked = searches(events).groupBy(*QUERY_KEY).agg(F.max("timestamp").alias("_asked"))
        late = seconds_between(F.col("_asked"), F.col("_clicked_at"))
        hit = hit.join(asked, QUERY_KEY).where(late <= click_timeout)
    rate = F.col("searches_with_clicks") / F.col("total_searches")
    if not keys:
        totals = merge_measures(
            [
                shown.agg(F.count(F.lit(1)).alias("total_searches")),
                hit.agg(F.count_distinct(F.struct(*QUERY_KEY)).alias("searches_with_clicks")),
            ]
        ).where(F.col("total_searches") > 0)
        return totals.select(
            "*", rate.alias("click_through_rate"), (rate * 100).alias("ctr_percentage")
        )
    asked_count = shown.groupBy(*keys).agg(F.count(F.lit(1)).alias("total_searches"))
    hit_count = hit.groupBy(*keys).agg(
        F.count_distinct(F.struct(*QUERY_KEY)).alias("searches_with_clicks")
    )
    return (
        asked_count.join(hit_count, keys, "left")
        .withColumn("searches_with_clicks", F.coalesce("searches_with_clicks", F.lit(0).cast("long")))
        .select(
            *keys,
            "total_searches",
            "searches_with_clicks",
            rate.alias("click_through_rate"),
            (rate * 100).alias("ctr_percentage"),
        )
    )


def zero_click_rate(events: DataFrame, by: Sequence[str]) -> DataFrame:
    """Share of searches without a click, per group."""
    return click_through_rate(events, by, period=None).select(
        *by, "total_searches", (1 - F.col("click_through_rate")).alias("zero_click_rate")
    )


def search_click_pairs(events: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Each click joined to its search, with the seconds between them.

    The search side has one row per key, so a query with very many clicks makes
    only the click side of the join uneven, which the runtime splits.
    """
    asked = searches(events).select(
        *QUERY_KEY, F.col("timestamp"), *[F.col(c).alias(f"{c}_search") for c in by]
    )
    hit = clicks(events).select(*QUERY_KEY, F.col("timestamp").alias("clicked_at"))
    return asked.join(hit, QUERY_KEY).withColumn(
        "time_to_click", seconds_between(F.col("timestamp"), F.col("clicked_at"))
    )


def mean_time_to_first_click(events: DataFrame) -> DataFrame:
    """One row: mean seconds from a search to its first click, over clicked searches."""
    first = clicks(events).groupBy(*QUERY_KEY).agg(F.min("timestamp").alias("_clicked_at"))
    asked = searches(events).select(*QUERY_KEY, "timestamp")
    wait = seconds_between(F.col("timestamp"), F.col("_clicked_at"))
    return asked.join(first, QUERY_KEY).agg(F.avg(wait).alias("avg_time_to_first_click"))


def time_to_click(
    events: DataFrame,
    by: Sequence[str] = (),
    period: str = "daily",
    digits: int | None = 2,
    max_seconds: float | None = None,
    keep_below_percentile: float | None = None,
) -> DataFrame:
    """Mean, exact median and deviation over *all* clicks, by the search's period.

    Group columns come out as ``<name>_search``. ``max_seconds`` drops slower
    clicks; ``keep_below_percentile`` then drops clicks above that percentile of
    their period.
    """
    pairs, keys = _with_period(
        search_click_pairs(events, by), [f"{c}_search" for c in by], period
    )
    if max_seconds is not None:
        pairs = pairs.where(F.col("time_to_click") <= max_seconds)
    if keep_below_percentile is not None:
        bar = exact_percentile(
            pairs, ["period"], F.col("time_to_click"), keep_below_percentile, "_bar"
        )
        pairs = pairs.join(bar, "period").where(F.col("time_to_click") <= F.col("_bar"))
    stats = pairs.groupBy(*keys).agg(
        F.avg("time_to_click").alias("_mean"),
        F.stddev_samp("time_to_click").alias("_std"),
        F.count("time_to_click").alias("total_clicks"),
        F.count_distinct("session_id").alias("unique_sessions"),
    )
    medians = exact_percentile(pairs, keys, F.col("time_to_click"), 0.5, "_median")
    return stats.join(medians, keys, "left").select(
        *keys,
        half_even(F.col("_mean"), digits).alias("avg_time_to_click_seconds"),
        half_even(F.col("_median"), digits).alias("median_time_to_click_seconds"),
        half_even(F.col("_std"), digits).alias("std_time_to_click_seconds"),
        "total_clicks",
        "unique_sessions",
    )


def _score(queries: Column, hits: Column, seconds: Column, repeats: Column) -> Column:
    """Weighted 0-1 engagement score of a session, rounded to 3 places."""

    def up_to(column: Column, full: float) -> Column:
        return F.least(column / F.lit(full), F.lit(1.0))

    # 5 queries, 10 clicks and 300 seconds count as full marks.
    return half_even(
        up_to(queries, 5.0) * 0.2
        + up_to(hits, 10.0) * 0.4
        + up_to(seconds, 300.0) * 0.3
        + F.greatest(F.lit(0.0), 1 - repeats) * 0.1,
        3,
    )


def session_engagement(events: DataFrame, period: str = "daily") -> DataFrame:
    """One row per session with the period of its start and an engagement score."""
    return session_base(events).select(
        "session_id",
        "user_id",
        "user_segment",
        "device_type",
        period_label(F.col("session_start"), period).alias("period"),
        "session_duration_seconds",
        "num_queries",
        "num_clicks",
        "unique_queries",
        "reformulation_rate",
        _score(
            F.col("num_queries"),
            F.col("num_clicks"),
            F.col("session_duration_seconds"),
            F.col("reformulation_rate"),
        ).alias("engagement_score"),
    )


def click_position_metrics(
    events: DataFrame,
    by: Sequence[str] = (),
    period: str = "daily",
    digits: int | None = 2,
) -> DataFrame:
    """Click positions per period: mean, median, deviation, share in the top 1, 3, 5.

    Positions come from one result page, so the median's value map stays tiny.
    """
    hit, keys = _with_period(clicks(events), by, period)
    position = F.col("click_position")
    return hit.groupBy(*keys).agg(
        half_even(F.avg(position), digits).alias("avg_click_position"),
        half_even(F.median(position), digits).alias("median_click_position"),
        half_even(F.stddev_samp(position), digits).alias("std_click_position"),
        F.count("session_id").alias("total_clicks"),
        *[
            (F.count_if(position <= top) / F.count(F.lit(1)) * 100).alias(
                f"top_{top}_click_percentage"
            )
            for top in (1, 3, 5)
        ],
    )


def result_engagement(
    events: DataFrame, period: str = "daily", digits: int | None = 2
) -> DataFrame:
    """Time on result and satisfaction per period and result type."""
    hit, keys = _with_period(clicks(events), ["result_type"], period)
    seconds = F.col("time_on_result_seconds")
    stats = hit.groupBy(*keys).agg(
        F.avg(seconds).alias("_mean"),
        F.stddev_samp(seconds).alias("_std"),
        mean_of_flag(F.col("is_satisfied")).alias("_satisfied"),
        F.count("session_id").alias("total_clicks"),
    )
    medians = exact_percentile(hit, keys, seconds, 0.5, "_median")
    return stats.join(medians, keys, "left").select(
        *keys,
        half_even(F.col("_mean"), digits).alias("avg_time_on_result"),
        half_even(F.col("_median"), digits).alias("median_time_on_result"),
        half_even(F.col("_std"), digits).alias("std_time_on_result"),
        half_even(F.col("_satisfied"), digits).alias("satisfaction_rate"),
        "total_clicks",
    )


def user_engagement_segments(events: DataFrame) -> DataFrame:
    """Users with a search, their totals, and an engagement class."""
    place = event_order(events)
    per_session = (
        searches(events)
        .where(F.col("user_id").isNotNull())
        .groupBy("user_id", "session_id")
        .agg(
            F.count(F.lit(1)).alias("_searches"),
            seconds_between(F.min("timestamp"), F.max("timestamp")).alias("_seconds"),
            F.min_by("user_segment", place).alias("_segment"),
            F.min(place).alias("_first"),
        )
    )
    users = per_session.groupBy("user_id").agg(
        F.min_by("_segment", "_first").alias("user_segment"),
        F.sum("_searches").alias("total_searches"),
        F.count("session_id").alias("unique_sessions"),
        F.avg(F.when(F.col("session_id").isNotNull(), F.col("_seconds"))).alias(
            "avg_session_duration"
        ),
    )
    hits = clicks(events).groupBy("user_id").agg(
        F.count(F.lit(1)).alias("total_clicks"),
        mean_of_flag(F.col("is_satisfied")).alias("satisfaction_rate"),
    )
    rate, satisfied = F.col("click_through_rate"), F.col("satisfaction_rate")
    return (
        users.join(hits, "user_id", "left")
        .select(
            "user_id",
            "user_segment",
            "total_searches",
            F.coalesce("total_clicks", F.lit(0).cast("long")).alias("total_clicks"),
            "unique_sessions",
            (F.coalesce("total_clicks", F.lit(0)) / F.col("total_searches")).alias(
                "click_through_rate"
            ),
            "avg_session_duration",
            F.when(F.col("total_clicks").isNull(), F.lit(0.0))
            .otherwise(F.col("satisfaction_rate"))
            .alias("satisfaction_rate"),
        )
        .withColumn(
            "engagement_segment",
            # Lower bounds on click-through and satisfaction.
            F.when((rate >= 0.7) & (satisfied >= 0.6), "highly_engaged")
            .when((rate >= 0.4) & (satisfied >= 0.3), "moderately_engaged")
            .when(rate >= 0.1, "low_engaged")
            .otherwise("disengaged"),
        )
    )


def engagement_summary(events: DataFrame) -> DataFrame:
    """One row of overall click-through, click time, position and session means.

    Everything is summed per query, then per session, then overall.
    """
    seconds, repeats = F.col("session.seconds"), F.col("session.repeats")
    session = F.col("session").isNotNull()
    score = _score(F.col("searches"), F.col("clicks"), seconds, repeats)
    return session_totals(events).agg(
        ratio_or_zero(F.sum("clicked_queries"), F.sum("searches")).alias("overall_ctr"),
        F.try_divide(F.sum("pair_micros").cast("double"), F.sum("pairs") * 1e6).alias(
            "avg_time_to_click"
        ),
        F.try_divide(F.sum("position_sum"), F.sum("position_count")).alias("avg_click_position"),
        F.try_divide(F.sum("top_3"), F.sum("clicks")).alias("top_3_click_rate"),
        F.avg(seconds).alias("avg_session_duration"),
        F.avg(F.when(session, F.col("searches"))).alias("avg_queries_per_session"),
        F.avg(F.when(session, score)).alias("avg_engagement_score"),
    )
