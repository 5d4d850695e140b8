"""Parameterised reports over the reporting tables.

Values come in as parameters, never as SQL text; column names are checked against
a list. Date bounds are inclusive. Limits are part of the report and carry a full
tie-break, so the same rows come out on every run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clicklake import schemas
from clicklake.plans.star import MONTH, PREVIOUS_MONTH, QUERY_MONTH, TIME_COLUMNS

SERIES_METRICS = tuple(
    f.name for f in schemas.DAILY_METRICS if f.name not in ("date", "user_segment", "device_type")
)
SERIES_GROUPS = ("user_segment", "device_type")


def _between(day: Column, start: str, end: str) -> Column:
    return day.between(F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date"))


def _dated(df: DataFrame, ts: str, start: str, end: str) -> DataFrame:
    """Rows with ``ts`` in the date range; tables stored by month are pruned by it."""
    rows = df.where(_between(F.to_date(ts), start, end))
    if MONTH in df.columns and ts in TIME_COLUMNS.values():
        rows = rows.where(F.col(MONTH).between(str(start)[:7], str(end)[:7]))
    return rows


def _linked(df: DataFrame, months: str, start: str, end: str) -> DataFrame:
    """Of tables stored by the month of related rows, the folders of related rows in the date range."""
    return df.where(F.col(months).between(str(start)[:7], str(end)[:7])) if months in df.columns else df


def daily_rows(daily: DataFrame, start: str, end: str, segment: str | None = None) -> DataFrame:
    """Rows of the daily table in a date range, in no particular order."""
    rows = _dated(daily, "date", start, end)
    if segment:
        rows = rows.where(F.col("user_segment") == segment)
    return rows.select(*schemas.DAILY_METRICS.fieldNames())


def daily_metrics(
    daily: DataFrame, start: str, end: str, segment: str | None = None
) -> DataFrame:
    return daily_rows(daily, start, end, segment).orderBy("date")


def session_details(sessions: DataFrame, queries: DataFrame, session_id: str) -> DataFrame:
    """A session with its queries in time order; one row of nulls without queries."""
    asked = queries.where(F.col("session_id") == session_id).select(
        "session_id", "query_id", "query_text", "timestamp", "result_count", "has_click",
        "time_to_first_click",
    )
    return (
        sessions.where(F.col("session_id") == session_id)
        .join(asked, "session_id", "left")
        .select(
            *schemas.SEARCH_SESSIONS.fieldNames(),
            "query_id", "query_text", "timestamp", "result_count", "has_click",
            "time_to_first_click",
        )
        .orderBy("timestamp", "query_id")
    )


def query_results(results: DataFrame, query_id) -> DataFrame:
    return (
        results.where(F.col("query_id") == F.lit(query_id))
        .select("result_id", "position", "document_id", "clicked", "click_time", "dwell_time")
        .orderBy("position")
    )


def user_sessions(sessions: DataFrame, user_id, limit: int = 10) -> DataFrame:
    """Latest sessions of a user."""
    return (
        sessions.where(F.col("user_id") == F.lit(user_id))
        .select(
            "session_id", "start_time", "end_time", "session_duration", "device_type", "browser",
            "total_queries", "total_clicks",
        )
        .orderBy(F.col("start_time").desc(), "session_id")
        .limit(limit)
    )


def top_queries(queries: DataFrame, start: str, end: str, limit: int = 10) -> DataFrame:
    """Most frequent texts with click rate (a true ratio) and mean time to first click."""
    return (
        _dated(queries, "timestamp", start, end)
        .groupBy("query_text")
        .agg(
            F.count(F.lit(1)).alias("query_count"),
            F.count_if("has_click").alias("click_count"),
            (F.count_if("has_click") / F.count(F.lit(1))).alias("click_rate"),
            F.avg("time_to_first_click").alias("avg_time_to_click"),
        )
        .orderBy(F.col("query_count").desc(), "query_text")
        .limit(limit)
    )


def reformulation_patterns(
    queries: DataFrame, start: str, end: str, limit: int = 10
) -> DataFrame:
    """Most frequent pairs of a query text and the text that replaced it.

    Of stored tables only queries that replace one of the range's months are read.
    """
    before = _dated(queries, "timestamp", start, end).select(
        "session_id",
        F.col("query_id").alias("reformulation_of"),
        F.col("query_text").alias("original_query"),
    )
    after = _linked(queries, PREVIOUS_MONTH, start, end).where(F.col("reformulation_of").isNotNull()).select(
        "session_id", "reformulation_of", F.col("query_text").alias("reformulated_query")
    )
    pair = ["original_query", "reformulated_query"]
    new, old = F.length("reformulated_query"), F.length("original_query")
    return (
        before.join(after, ["session_id", "reformulation_of"])
        .groupBy(*pair)
        .agg(F.count(F.lit(1)).alias("frequency"))
        .select(
            *pair,
            "frequency",
            F.when(new > old, "expanded")
            .when(new < old, "narrowed")
            .otherwise("rephrased")
            .alias("reformulation_type"),
        )
        .orderBy(F.col("frequency").desc(), *pair)
        .limit(limit)
    )


def engagement_by_position(
    results: DataFrame,
    start: str,
    end: str,
    segment: str | None = None,
    sessions: DataFrame | None = None,
    date_basis: str = "click",
    queries: DataFrame | None = None,
) -> DataFrame:
    """Impressions, clicks, rate and dwell for the first 20 positions.

    ``date_basis='click'`` filters on the click time, so only clicked results
    remain and the rate is 1; ``'query'`` filters on the time of the query.
    """
    if date_basis == "click":
        rows = _dated(results, "click_time", start, end)
    elif date_basis == "query":
        if queries is None:
            raise ValueError("date_basis='query' needs the queries table")
        asked = _dated(queries, "timestamp", start, end).select("query_id")
        rows = _linked(results, QUERY_MONTH, start, end).join(asked, "query_id", "left_semi")
    else:
        raise ValueError(f"date_basis must be 'click' or 'query', not {date_basis!r}")
    measures = {
        "impression_count": F.count(F.lit(1)),
        "click_count": F.count_if("clicked"),
        "_dwell": F.sum("dwell_time"),
        "_dwells": F.count("dwell_time"),
    }
    if segment:
        if sessions is None:
            raise ValueError("a segment filter needs the sessions table")
        chosen = sessions.where(F.col("user_segment") == segment).select("session_id")
        # Fold per session before the join, so a session with many results is small.
        rows = (
            rows.groupBy("session_id", "position")
            .agg(*[m.alias(n) for n, m in measures.items()])
            .join(chosen, "session_id", "left_semi")
        )
        measures = {n: F.sum(n) for n in measures}
    return (
        rows.groupBy("position")
        .agg(*[m.alias(n) for n, m in measures.items()])
        .select(
            "position",
            "impression_count",
            "click_count",
            (F.col("click_count") / F.col("impression_count")).alias("ctr"),
            F.try_divide("_dwell", "_dwells").alias("avg_dwell_time"),
        )
        .orderBy("position")
        .limit(20)
    )


def ab_test_results(ab_tests: DataFrame, test_id: str) -> DataFrame:
    return (
        ab_tests.where(F.col("test_id") == test_id)
        .select(*schemas.AB_TEST_RESULTS.fieldNames())
        .orderBy("metric", "variant")
    )


def metric_timeseries(
    daily: DataFrame,
    metric: str,
    start: str,
    end: str,
    group_by: str = "user_segment",
    device_type: str | None = None,
) -> DataFrame:
    """Date, group and metric as stored, without aggregation."""
    if metric not in SERIES_METRICS:
        raise ValueError(f"unknown metric {metric!r}; expected one of {SERIES_METRICS}")
    if group_by not in SERIES_GROUPS:
        raise ValueError(f"unknown group {group_by!r}; expected one of {SERIES_GROUPS}")
    rows = daily.where(_between(F.col("date"), start, end))
    if device_type:
        rows = rows.where(F.col("device_type") == device_type)
    return rows.select("date", group_by, metric).orderBy("date", group_by)


def _distribution(sessions: DataFrame, by: str, start: str, end: str) -> DataFrame:
    counts = (
        _dated(sessions, "start_time", start, end)
        .groupBy(by)
        .agg(
            F.count(F.lit(1)).alias("session_count"),
            F.avg("total_queries").alias("avg_queries"),
            F.avg("total_clicks").alias("avg_clicks"),
            F.avg("session_duration").alias("avg_duration"),
        )
    )
    total = F.sum("session_count").over(Window.partitionBy())  # one row per value of ``by``
    return counts.select(
        by,
        "session_count",
        (F.col("session_count") * 100 / total).alias("percentage"),
        "avg_queries",
        "avg_clicks",
        "avg_duration",
    ).orderBy(F.col("session_count").desc(), by)


def user_segment_distribution(sessions: DataFrame, start: str, end: str) -> DataFrame:
    return _distribution(sessions, "user_segment", start, end)


def device_type_distribution(sessions: DataFrame, start: str, end: str) -> DataFrame:
    return _distribution(sessions, "device_type", start, end)


def low_satisfaction_queries(
    queries: DataFrame,
    results: DataFrame,
    start: str,
    end: str,
    limit: int = 20,
    dedupe: bool = False,
) -> DataFrame:
    """Texts asked at least 5 times that are rarely, slowly or deeply clicked.

    A query counts once per click (once without clicks); ``dedupe`` counts every
    query once. Clicks are folded per query, so nothing is multiplied out, and of stored tables
    only the results of queries of the range's months are read.
    """
    deep = _linked(results, QUERY_MONTH, start, end).where("clicked").groupBy("query_id").agg(
        F.count(F.lit(1)).alias("_clicks"), F.max("position").alias("_deepest")
    )
    weight = F.lit(1).cast("long") if dedupe else F.coalesce("_clicks", F.lit(1).cast("long"))
    wait = F.when(F.col("has_click"), F.col("time_to_first_click"))
    rate, slow = F.col("click_rate"), F.col("avg_time_to_click")
    return (
        _dated(queries, "timestamp", start, end)
        .join(deep, "query_id", "left")
        .withColumn("_weight", weight)
        .groupBy("query_text")
        .agg(
            F.sum("_weight").alias("query_count"),
            F.try_divide(
                F.sum(F.when(F.col("has_click"), F.col("_weight")).otherwise(0)), F.sum("_weight")
            ).alias("click_rate"),
            F.try_divide(
                F.sum(wait * F.col("_weight")), F.sum(F.when(wait.isNotNull(), F.col("_weight")))
            ).alias("avg_time_to_click"),
            F.max("_deepest").alias("deepest_click_position"),
        )
        .where(
            (F.col("query_count") >= 5)
            & ((rate < 0.3) | (slow > 10) | (F.col("deepest_click_position") > 5))
        )
        .orderBy("click_rate", F.col("query_count").desc(), "query_text")
        .limit(limit)
    )


def zero_click_stats(
    queries: DataFrame, sessions: DataFrame, start: str, end: str
) -> DataFrame:
    """Queries without clicks per date and user segment."""
    segments = sessions.select("session_id", "user_segment")
    # Fold per session and day before the join, so a session with many queries is small.
    per_session = (
        _dated(queries, "timestamp", start, end)
        .groupBy("session_id", F.to_date("timestamp").alias("date"))
        .agg(F.count(F.lit(1)).alias("_queries"), F.count_if(~F.col("has_click")).alias("_missed"))
    )
    missed = F.col("zero_click_count")
    return (
        per_session.join(segments, "session_id")
        .groupBy("date", "user_segment")
        .agg(F.sum("_queries").alias("query_count"), F.sum("_missed").alias("zero_click_count"))
        .withColumn("zero_click_percentage", missed * 100 / F.col("query_count"))
        .orderBy("date", "user_segment")
    )


def query_complexity_stats(queries: DataFrame, start: str, end: str) -> DataFrame:
    """Click rate and time by number of words (spaces plus one)."""
    text = F.col("query_text")
    words = F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit(""))) + 1
    bucket = (
        F.when(words.between(1, 2), F.struct(F.lit(1), F.lit("1-2 words")))
        .when(words.between(3, 4), F.struct(F.lit(2), F.lit("3-4 words")))
        .when(words.between(5, 7), F.struct(F.lit(3), F.lit("5-7 words")))
        .otherwise(F.struct(F.lit(4), F.lit("8+ words")))
    )
    return (
        _dated(queries, "timestamp", start, end)
        .groupBy(bucket.alias("_bucket"))
        .agg(
            F.count(F.lit(1)).alias("query_count"),
            (F.count_if("has_click") / F.count(F.lit(1))).alias("click_rate"),
            F.avg(F.when(F.col("has_click"), F.col("time_to_first_click"))).alias(
                "avg_time_to_click"
            ),
        )
        .orderBy("_bucket.col1")
        .select(
            F.col("_bucket.col2").alias("query_length"),
            "query_count",
            "click_rate",
            "avg_time_to_click",
        )
    )


#: Newest queries that are looked up at first, as a multiple of the limit, and at most before all are joined.
AHEAD, MOST_AHEAD = 4, 100_000


def _months_back(rows: DataFrame) -> list[str]:
    """The months a table is stored by, newest first."""
    return sorted((r[0] for r in rows.select(MONTH).distinct().collect() if r[0]), reverse=True)


def _newest(queries: DataFrame, rows: int) -> tuple[DataFrame, int, str | None]:
    """The ``rows`` newest queries, how many there are, and the oldest month read (null: all of them).

    Months are read from the newest on, twice as many each time: rows of a newer month come before
    all of an older one, so those read decide as soon as they are enough.
    """
    order = [F.col("timestamp").desc(), F.col("query_id").desc()]
    months, step = _months_back(queries), 1
    while step < len(months):
        recent = queries.where(F.col(MONTH) >= months[step - 1])
        if (found := recent.limit(rows).count()) >= rows:
            return recent.orderBy(*order).limit(rows), found, months[step - 1]
        step *= 2
    return queries.orderBy(*order).limit(rows), queries.limit(rows).count(), None


def _month_before(month: str) -> str:
    year, number = int(month[:4]), int(month[5:7])
    return f"{year - 1:04d}-12" if number == 1 else f"{year:04d}-{number - 1:02d}"


def recent_activity(queries: DataFrame, sessions: DataFrame, limit: int = 100) -> DataFrame:
    """Newest queries with the segment and device of their session.

    Tables stored by month are read from the newest month back until the rows are certain: a bounded
    number of the newest queries is looked up in the sessions of their months and the one before,
    then, where some session began earlier, in all sessions, and more queries only where sessions are missing.
    """
    order = [F.col("timestamp").desc(), F.col("query_id").desc()]
    columns = (
        "query_id", "session_id", "query_text", "timestamp", "has_click",
        "time_to_first_click", "user_segment", "device_type",
    )
    if MONTH in queries.columns and MONTH in sessions.columns:
        asked, ahead = queries.where(F.col("session_id").isNotNull()), max(1, AHEAD * limit)
        while ahead <= MOST_AHEAD:
            newest, found, since = _newest(asked, ahead)
            newest = newest.drop(MONTH, PREVIOUS_MONTH)
            for first in [_month_before(since), None] if since else [None]:
                begun = sessions.where(F.col(MONTH) >= first) if first else sessions
                attributes = begun.select("session_id", "user_segment", "device_type")
                # At most MOST_AHEAD queries travel; sessions stay where they are.
                joined = F.broadcast(newest).join(attributes, "session_id").select(*columns)
                if first and joined.select("session_id").distinct().count() < newest.select("session_id").distinct().count():
                    continue
                if found < ahead or joined.count() >= limit:
                    return joined.orderBy(*order).limit(limit)
            ahead *= 8
    attributes = sessions.select("session_id", "user_segment", "device_type")
    return queries.join(attributes, "session_id").select(*columns).orderBy(*order).limit(limit)
