"""Tiny event and result logs."""

from __future__ import annotations

import datetime as dt

from clicklake.schemas import EVENT_LOG, RESULT_LOG

START = dt.datetime(2024, 3, 4, 10, 0, 0)  # a Monday


def at(seconds: float) -> dt.datetime:
    return START + dt.timedelta(seconds=seconds)


def event_log(spark, rows):
    """Rows as dicts; event_id is the row number."""
    base = dict.fromkeys(EVENT_LOG.fieldNames())
    full = [{**base, "event_id": n, **row} for n, row in enumerate(rows)]
    return spark.createDataFrame([tuple(r.values()) for r in full], EVENT_LOG)


def search(session, index, when, query="red shoes", user=1, **more):
    return {
        "session_id": session, "user_id": user, "timestamp": when, "event_type": "search",
        "query": query, "query_length": len(query), "query_words": len(query.split()),
        "query_index_in_session": index, "user_segment": "new_user", "device_type": "mobile",
        "results_returned": 10, "search_latency_ms": 100.0, "variant": "control", **more,
    }


def click(session, index, when, position=1, seconds=40.0, user=1, **more):
    return {
        "session_id": session, "user_id": user, "timestamp": when, "event_type": "click",
        "query": "red shoes", "query_index_in_session": index, "user_segment": "new_user",
        "device_type": "mobile", "click_position": position, "result_type": "web",
        "time_on_result_seconds": seconds, "is_satisfied": seconds > 30, "variant": "control",
        **more,
    }


def result_log(spark, rows):
    """Rows as dicts with query_id, position and clicked; the rest has defaults."""
    base = dict.fromkeys(RESULT_LOG.fieldNames())
    full = []
    for n, row in enumerate(rows):
        one = {
            **base, "result_id": str(n), "session_id": "s", "user_id": 1, "query_text": "q",
            "query_time": START, "timestamp": at(n), "document_id": n, "variant": "control", **row,
        }
        full.append(tuple(one[c] for c in RESULT_LOG.fieldNames()))
    return spark.createDataFrame(full, RESULT_LOG)


def shown(query, position, clicked=True, dwell=None, wait=None, **more):
    return {
        "query_id": query, "position": position, "clicked": clicked, "dwell_time": dwell,
        "time_to_click": wait, **more,
    }
