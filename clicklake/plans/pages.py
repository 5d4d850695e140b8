"""Data sets behind the report pages: one function per page, a dict of DataFrames."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicklake.operators import series
from clicklake.plans import reports
from clicklake.plans.star import Star

Page = dict[str, DataFrame]


def overview_kpis(daily: DataFrame) -> DataFrame:
    """Unweighted means over the rows of the daily table."""
    return daily.agg(
        F.avg("avg_ctr").alias("ctr"),
        F.avg("zero_click_rate").alias("zero_click_rate"),
        F.avg("avg_time_to_first_click").alias("time_to_click"),
        (F.avg("avg_queries_per_session") - 1).alias("reformulation_rate"),
    )


def mean_ndcg(daily: DataFrame) -> DataFrame:
    return daily.agg(F.avg("avg_ndcg").alias("ndcg"))


def ctr_series(daily: DataFrame) -> DataFrame:
    """One row per date: clicked queries over queries, across segments and devices."""
    clicked = F.sum(F.col("avg_ctr") * F.col("total_queries"))
    return daily.groupBy("date").agg(
        F.try_divide(clicked, F.sum("total_queries")).alias("ctr")
    )


def ctr_anomalies(
    daily: DataFrame, raw_rows: bool = False, window: int = 7, threshold: float = 3.0
) -> DataFrame:
    """CTR with anomaly flags per date; ``raw_rows`` keeps one row per table row."""
    if raw_rows:
        keys = ["user_segment", "device_type"]
        rows = daily.select("date", *keys, F.col("avg_ctr").alias("ctr"))
        return series.detect_anomalies(
            rows, "ctr", window=window, threshold=threshold, tie_break=keys
        )
    return series.detect_anomalies(ctr_series(daily), "ctr", window=window, threshold=threshold)


def overview(star: Star, start: str, end: str) -> Page:
    daily = reports.daily_rows(star.daily_metrics, start, end)
    return {
        "kpis": overview_kpis(daily),
        "daily": daily.orderBy("date"),
        "top_queries": reports.top_queries(star.search_queries, start, end, 10),
        "devices": reports.device_type_distribution(star.search_sessions, start, end),
    }


def query_analysis(star: Star, start: str, end: str) -> Page:
    queries = star.search_queries
    return {
        "top_queries": reports.top_queries(queries, start, end, 20),
        "reformulations": reports.reformulation_patterns(queries, start, end, 10),
        "zero_click": reports.zero_click_stats(queries, star.search_sessions, start, end),
        "complexity": reports.query_complexity_stats(queries, start, end),
    }


def user_engagement(star: Star, start: str, end: str) -> Page:
    return {
        "daily": reports.daily_metrics(star.daily_metrics, start, end),
        "positions": reports.engagement_by_position(star.search_results, start, end),
    }


def result_quality(star: Star, start: str, end: str) -> Page:
    daily = reports.daily_rows(star.daily_metrics, start, end)
    return {
        "ndcg": mean_ndcg(daily),
        "ndcg_trend": series.trend_line(
            daily.select("date", "user_segment", "device_type", "avg_ndcg"),
            "avg_ndcg",
            tie_break=["user_segment", "device_type"],
        ),
        "positions": reports.engagement_by_position(star.search_results, start, end),
    }


def session_analysis(star: Star, start: str, end: str) -> Page:
    daily = reports.daily_metrics(star.daily_metrics, start, end)
    return {
        "sessions": daily.select("date", "user_segment", "device_type", "total_sessions"),
        "segments": reports.user_segment_distribution(star.search_sessions, start, end),
    }


def segmentation(star: Star, start: str, end: str) -> Page:
    return {
        "segments": reports.user_segment_distribution(star.search_sessions, start, end),
        "devices": reports.device_type_distribution(star.search_sessions, start, end),
    }


def trends_anomalies(star: Star, start: str, end: str) -> Page:
    daily = reports.daily_rows(star.daily_metrics, start, end)
    return {"ctr": ctr_anomalies(daily)}


def ab_testing(star: Star, test_id: str) -> Page:
    if star.ab_test_results is None:
        raise ValueError("the star has no ab_test_results table")
    return {"results": reports.ab_test_results(star.ab_test_results, test_id)}


PAGES: dict[str, Callable[..., Page]] = {
    "Overview": overview,
    "Query Analysis": query_analysis,
    "User Engagement": user_engagement,
    "Result Quality": result_quality,
    "Session Analysis": session_analysis,
    "Segmentation": segmentation,
    "Trends & Anomalies": trends_anomalies,
    "A/B Testing": ab_testing,
}


def page(name: str, star: Star, *args: str) -> Page:
    """Data of a page by name."""
    try:
        return PAGES[name](star, *args)
    except KeyError:
        raise ValueError(f"unknown page {name!r}; expected one of {tuple(PAGES)}") from None
