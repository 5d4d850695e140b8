"""Column layouts of the logs and of the five reporting tables."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _I, _L, _D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
_B, _TS, _DT = T.BooleanType(), T.TimestampNTZType(), T.DateType()


def _layout(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# Searches and clicks in one table; columns of the other kind are null.
EVENT_LOG = _layout(
    event_id=_L, session_id=_S, user_id=_L, timestamp=_TS, event_type=_S, query=_S,
    query_length=_I, query_words=_I, query_index_in_session=_I, user_segment=_S,
    device_type=_S, results_returned=_I, search_latency_ms=_D, click_position=_I,
    result_type=_S, time_on_result_seconds=_D, is_satisfied=_B, variant=_S,
)

# As applications write it: ids of any text, and no id of the event.
PLAIN_EVENT_LOG = T.StructType([
    T.StructField(f.name, _S if f.name == "user_id" else f.dataType) for f in EVENT_LOG if f.name != "event_id"
])

# One row per shown result.
RESULT_LOG = _layout(
    result_id=_S, query_id=_L, session_id=_S, user_id=_L, query_text=_S, query_time=_TS,
    timestamp=_TS, position=_I, document_id=_L, clicked=_B, click_time=_TS, dwell_time=_D,
    time_to_click=_D, variant=_S,
)

# One row per query with arrays of shown and clicked results.
NESTED_LOG = _layout(
    session_id=_S, user_id=_L, query_id=_L, query_text=_S, timestamp=_TS,
    results=T.ArrayType(_L), clicked_results=T.ArrayType(_L),
    click_timestamps=T.ArrayType(_TS), device_type=_S, location=_S,
)

SEARCH_SESSIONS = _layout(
    session_id=_S, user_id=_L, start_time=_TS, end_time=_TS, session_duration=_D,
    device_type=_S, browser=_S, user_segment=_S, total_queries=_L, total_clicks=_L,
)
SEARCH_QUERIES = _layout(
    query_id=_L, session_id=_S, query_text=_S, timestamp=_TS, result_count=_L,
    reformulation_of=_L, has_click=_B, time_to_first_click=_D, max_click_position=_I,
)
SEARCH_RESULTS = _layout(
    result_id=_S, query_id=_L, session_id=_S, position=_I, document_id=_L, clicked=_B,
    click_time=_TS, dwell_time=_D,
)
DAILY_METRICS = _layout(
    date=_DT, user_segment=_S, device_type=_S, total_sessions=_L, total_queries=_L,
    total_clicks=_L, avg_ctr=_D, avg_time_to_first_click=_D, avg_queries_per_session=_D,
    zero_click_rate=_D, click_depth=_D, avg_ndcg=_D,
)
AB_TEST_RESULTS = _layout(
    test_id=_S, test_name=_S, start_date=_DT, end_date=_DT, metric=_S, variant=_S,
    value=_D, sample_size=_L, p_value=_D, significant=_B,
)

STAR_TABLES = {
    "search_sessions": SEARCH_SESSIONS,
    "search_queries": SEARCH_QUERIES,
    "search_results": SEARCH_RESULTS,
    "daily_metrics": DAILY_METRICS,
    "ab_test_results": AB_TEST_RESULTS,
}
PRIMARY_KEYS = {
    "search_sessions": "session_id",
    "search_queries": "query_id",
    "search_results": "result_id",
}
