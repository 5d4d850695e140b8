"""Session, query, daily and segment metrics from an event log.

The log is only ever grouped by (session, query index) or (session, query text)
before it is grouped by session, so rows are combined on the map side and a
session with a large share of the log is spread over its queries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clicklake.functions.numeric import (
    epoch_micros,
    half_even,
    ratio_or_zero,
    seconds_between,
)

QUERY_KEY = ["session_id", "query_index_in_session"]


def event_order(events: DataFrame) -> Column:
    """What comes first: by time, then by ``event_id`` where the log has one.

    Otherwise events of one time stand in the order of their query and of the user columns, which decides
    alike on every run.
    """
    ties = ["event_id"] if "event_id" in events.columns else [QUERY_KEY[1], "user_id", "user_segment", "device_type"]
    return F.struct("timestamp", *ties)


def searches(events: DataFrame) -> DataFrame:
    return events.where(F.col("event_type") == "search")


def clicks(events: DataFrame) -> DataFrame:
    return events.where(F.col("event_type") == "click")


def _exact(number: Column) -> Column:
    """Decimal form of a whole number, so that sums over many rows cannot overflow."""
    return number.cast("decimal(18,0)")


def _per_query(events: DataFrame) -> DataFrame:
    """Searches and clicks of one (session, query index), folded in a single pass.

    Searches that share a key are all counted, each against the same first click.
    """
    is_search, is_click = F.col("event_type") == "search", F.col("event_type") == "click"
    ts = F.col("timestamp")
    first = F.when(is_search, event_order(events))
    return (
        events.where(is_search | is_click)
        .groupBy(*QUERY_KEY)
        .agg(
            F.count_if(is_search).alias("searches"),
            F.min(F.when(is_search, ts)).alias("first_search"),
            F.max(F.when(is_search, ts)).alias("last_search"),
            F.sum(F.when(is_search, _exact(epoch_micros(ts)))).alias("search_micros"),
            F.sum(F.when(is_search, F.col("query_length"))).alias("length_sum"),
            F.count(F.when(is_search, F.col("query_length"))).alias("length_count"),
            F.min_by(F.struct("user_id", "user_segment", "device_type"), first).alias("who"),
            F.min(first).alias("first_key"),
            F.count_if(is_click).alias("clicks"),
            F.count_if(is_click & F.col("is_satisfied")).alias("satisfied"),
            F.min(F.when(is_click, ts)).alias("first_click"),
            F.sum(F.when(is_click, _exact(epoch_micros(ts)))).alias("click_micros"),
            F.sum(F.when(is_click, F.col("click_position"))).alias("position_sum"),
            F.count(F.when(is_click, F.col("click_position"))).alias("position_count"),
            F.count_if(is_click & (F.col("click_position") <= 3)).alias("top_3"),
        )
    )


def _session_rows(events: DataFrame) -> DataFrame:
    """Sums per session id, also for ids without a search and for the null id.

    ``waited`` and ``answered`` are over searches and their first click,
    ``pair_micros`` and ``pairs`` over all pairs of a search and a click of one query.
    """
    keyed = F.col("session_id").isNotNull() & F.col(QUERY_KEY[1]).isNotNull()
    matched = keyed & (F.col("searches") > 0) & (F.col("clicks") > 0)
    shown, hit = _exact(F.col("searches")), _exact(F.col("clicks"))
    waited = shown * _exact(epoch_micros(F.col("first_click"))) - F.col("search_micros")
    apart = shown * F.col("click_micros") - hit * F.col("search_micros")
    sums = [
        "searches", "clicks", "satisfied", "length_sum", "length_count", "position_sum",
        "position_count", "top_3",
    ]
    return (
        _per_query(events)
        .groupBy("session_id")
        .agg(
            F.min_by("who", "first_key").alias("who"),
            F.min("first_search").alias("session_start"),
            F.max("last_search").alias("session_end"),
            *[F.sum(c).alias(c) for c in sums],
            F.sum(F.when(matched, waited)).alias("waited_micros"),
            F.sum(F.when(matched, F.col("searches"))).alias("answered"),
            F.count_if(keyed & (F.col("clicks") > 0)).alias("clicked_queries"),
            F.sum(F.when(matched, apart)).alias("pair_micros"),
            F.sum(F.when(matched, F.col("searches") * F.col("clicks"))).alias("pairs"),
        )
    )


def session_totals(events: DataFrame) -> DataFrame:
    """``_session_rows`` with the distinct texts, and ``session``: null unless it has a search."""
    texts = searches(events).groupBy("session_id").agg(
        F.count_distinct("query").alias("unique_queries")
    )
    queries = F.col("searches")
    return _session_rows(events).join(texts, "session_id", "left").select(
        "*",
        F.when(
            F.col("session_id").isNotNull() & (queries > 0),
            F.struct(
                seconds_between(F.col("session_start"), F.col("session_end")).alias("seconds"),
                ((queries - F.col("unique_queries")) / queries).alias("repeats"),
            ),
        ).alias("session"),
    )


def session_base(events: DataFrame) -> DataFrame:
    """Counts, clock span and first-row attributes of sessions with a search."""
    return (
        session_totals(events)
        .where(F.col("session").isNotNull())
        .select(
            "session_id",
            F.col("who.user_id").alias("user_id"),
            F.col("who.user_segment").alias("user_segment"),
            F.col("who.device_type").alias("device_type"),
            "session_start",
            F.col("session.seconds").alias("session_duration_seconds"),
            F.col("searches").alias("num_queries"),
            F.col("clicks").alias("num_clicks"),
            "satisfied",
            F.try_divide("length_sum", "length_count").alias("avg_query_length"),
            "unique_queries",
            F.col("session.repeats").alias("reformulation_rate"),
            (F.col("waited_micros").cast("double") / F.col("answered") / F.lit(1e6)).alias(
                "avg_time_to_click"
            ),
        )
    )


def session_metrics(events: DataFrame) -> DataFrame:
    """One row per session with at least one search."""
    return session_base(events).select(
        "session_id",
        "user_id",
        "user_segment",
        "device_type",
        "session_start",
        "session_duration_seconds",
        "num_queries",
        "num_clicks",
        (F.col("num_clicks") / F.col("num_queries")).alias("click_through_rate"),
        ratio_or_zero(F.col("satisfied"), F.col("num_clicks")).alias("satisfaction_rate"),
        "avg_query_length",
        "unique_queries",
        "reformulation_rate",
        "avg_time_to_click",
        F.to_date("session_start").alias("date"),
    )


def time_to_first_click(events: DataFrame) -> DataFrame:
    """Mean seconds from search to its first click, per session (null without clicks)."""
    return session_base(events).select("session_id", "avg_time_to_click")


def clicks_per_query(events: DataFrame) -> DataFrame:
    """Click figures for each (session, query index) that was clicked."""
    return (
        clicks(events)
        .groupBy(*QUERY_KEY)
        .agg(
            F.count(F.lit(1)).alias("num_clicks"),
            F.avg("click_position").alias("avg_click_position"),
            F.min("click_position").alias("first_click_position"),
            F.avg("time_on_result_seconds").alias("avg_time_on_result"),
            F.coalesce(F.bool_or("is_satisfied"), F.lit(False)).alias("has_satisfied_click"),
        )
    )


def query_metrics(events: DataFrame) -> DataFrame:
    """One row per search with its clicks folded in; click figures null without clicks."""
    carried = [
        "session_id", "user_id", "query", "query_index_in_session", "user_segment",
        "device_type", "timestamp", "query_length", "query_words", "results_returned",
        "search_latency_ms",
    ]
    return (
        searches(events)
        .select(*carried)
        .join(clicks_per_query(events), QUERY_KEY, "left")
        .select(
            *carried,
            F.coalesce("num_clicks", F.lit(0).cast("long")).alias("num_clicks"),
            F.col("num_clicks").isNotNull().alias("has_click"),
            "avg_click_position",
            "first_click_position",
            "avg_time_on_result",
            F.coalesce("has_satisfied_click", F.lit(False)).alias("has_satisfied_click"),
            F.to_date("timestamp").alias("date"),
        )
    )


_QUERY_MEANS = {
    "click_through_rate": "has_click",
    "satisfaction_rate": "has_satisfied_click",
    "avg_search_latency_ms": "search_latency_ms",
    "avg_query_length": "query_length",
    "avg_first_click_position": "first_click_position",
}


def _query_rollup(
    queries: DataFrame, keys: list[str], means: dict[str, str], digits: int | None
) -> DataFrame:
    """Distinct sessions and users, query count and means, per key.

    Rows are folded to one per (key, session, user) first; the distinct counts
    then run over that, and means are sums over counts.
    """
    named = queries
    for key in keys:
        named = named.where(F.col(key).isNotNull())
    folded = named.groupBy(*keys, "session_id", "user_id").agg(
        F.count("query").alias("_queries"),
        *[F.sum(F.col(c).cast("double")).alias(f"_s_{n}") for n, c in means.items()],
        *[F.count(c).alias(f"_n_{n}") for n, c in means.items()],
    )
    totals = folded.groupBy(*keys).agg(
        F.count_distinct("session_id").alias("unique_sessions"),
        F.count_distinct("user_id").alias("unique_users"),
        F.sum("_queries").alias("total_queries"),
        *[F.sum(f"_s_{n}").alias(f"_s_{n}") for n in means],
        *[F.sum(f"_n_{n}").alias(f"_n_{n}") for n in means],
    )
    return totals.select(
        *keys,
        "unique_sessions",
        "unique_users",
        "total_queries",
        *[half_even(F.try_divide(f"_s_{n}", f"_n_{n}"), digits).alias(n) for n in means],
    )


def daily_aggregates(queries: DataFrame, digits: int | None = 4) -> DataFrame:
    """``query_metrics`` rolled up by date; means are rounded unless ``digits`` is None."""
    means = {**_QUERY_MEANS, "avg_time_on_result": "avg_time_on_result"}
    return _query_rollup(queries, ["date"], means, digits)


def segment_aggregates(queries: DataFrame, digits: int | None = 4) -> DataFrame:
    """``query_metrics`` rolled up by user segment and date."""
    return _query_rollup(queries, ["user_segment", "date"], _QUERY_MEANS, digits)


# Share of each normalised daily figure in the quality score.
POSITIVE_WEIGHTS = {"click_through_rate": 0.3, "satisfaction_rate": 0.4, "avg_time_on_result": 0.1}
NEGATIVE_WEIGHTS = {"avg_search_latency_ms": 0.1, "avg_first_click_position": 0.1}


def quality_score(daily: DataFrame) -> DataFrame:
    """Weighted 0-100 score per date, each figure relative to its largest value."""
    everything = Window.partitionBy()  # one row per date

    def share(name: str) -> Column:
        return F.try_divide(F.col(name), F.max(name).over(everything))

    score = sum(
        (share(n) * F.lit(w) for n, w in POSITIVE_WEIGHTS.items()), start=F.lit(0.0)
    ) + sum(((1 - share(n)) * F.lit(w) for n, w in NEGATIVE_WEIGHTS.items()), start=F.lit(0.0))
    return daily.select("date", (score * 100).alias("search_quality_score"))


def summary_statistics(queries: DataFrame) -> DataFrame:
    """One row: totals, distinct sessions and users, means and the date range."""
    folded = queries.groupBy("session_id", "user_id").agg(
        F.count(F.lit(1)).alias("_rows"),
        F.count_if("has_click").alias("_clicked"),
        F.count_if("has_satisfied_click").alias("_satisfied"),
        F.sum("search_latency_ms").alias("_latency"),
        F.count("search_latency_ms").alias("_latencies"),
        F.min("date").alias("_first"),
        F.max("date").alias("_last"),
    )
    return folded.agg(
        F.sum("_rows").alias("total_queries"),
        F.count_distinct("session_id").alias("unique_sessions"),
        F.count_distinct("user_id").alias("unique_users"),
        F.try_divide(F.sum("_clicked"), F.sum("_rows")).alias("overall_ctr"),
        F.try_divide(F.sum("_satisfied"), F.sum("_rows")).alias("overall_satisfaction"),
        F.try_divide(F.sum("_latency"), F.sum("_latencies")).alias("avg_search_latency"),
        F.date_format(F.min("_first"), "yyyy-MM-dd").alias("date_start"),
        F.date_format(F.max("_last"), "yyyy-MM-dd").alias("date_end"),
    )


