from __future__ import annotations

import pytest

from clicklake.plans import pages, reports, star
from clicklake.schemas import STAR_TABLES
from tests.logs_by_hand import START, at, result_log, shown

DAY = "2024-03-04"


@pytest.fixture(scope="module")
def tables(spark):
    queries = spark.createDataFrame(
        [(n, "s", 1, text, at(n * 60)) for n, text in enumerate(["cat", "cat food", "cats", "dog"] * 2)]
        + [(90, "t", 2, "cat", at(0)), (91, "t", 2, "none shown", at(5))],
        "query_id long, session_id string, user_id long, query_text string, timestamp timestamp_ntz",
    )
    results = result_log(spark, [
        *[shown(n, 1, n % 2 == 0, 5.0, 3.0, click_time=at(0) if n % 2 == 0 else None) for n in range(8)],
        shown(0, 2, True, 9.0, 1.0, click_time=at(1)), shown(0, 9, True, 9.0, 2.0, click_time=at(2)),
        shown(90, 1, False, session_id="t", user_id=2),
    ])
    users = spark.createDataFrame(
        [(1, "A", "mobile", "edge", "x"), (2, "B", "desktop", "safari", "y")],
        "user_id long, user_segment string, device_type string, browser string, location string",
    )
    return star.build(queries, results, users)


def test_facts_keep_queries_without_results(tables):
    rows = {r.query_id: r for r in tables.search_queries.collect()}
    assert rows[91].result_count == 0 and rows[91].has_click is False
    assert rows[0].time_to_first_click == 1.0 and rows[0].max_click_position == 9
    assert rows[1].reformulation_of == 0 and rows[0].reformulation_of is None
    assert rows[91].reformulation_of == 90


def test_sessions(tables):
    rows = {r.session_id: r for r in tables.search_sessions.collect()}
    assert (rows["s"].total_queries, rows["s"].total_clicks) == (8, 6)
    assert rows["s"].start_time == START and rows["s"].session_duration == 420.0
    assert rows["t"].browser == "safari"


def test_daily(tables):
    rows = {r.user_segment: r for r in tables.daily_metrics.collect()}
    assert rows["A"].avg_ctr == 0.5 and rows["A"].zero_click_rate == 0.5
    assert rows["A"].avg_queries_per_session == 8.0
    assert rows["B"].click_depth is None and rows["B"].avg_ndcg == 0.0


def test_low_satisfaction_counts_clicks_unless_deduped(spark):
    queries = spark.createDataFrame(
        [(n, "deep", n == 0, 20.0 if n == 0 else None) for n in range(5)],
        "query_id long, query_text string, has_click boolean, time_to_first_click double",
    ).withColumn("timestamp", reports.F.lit(at(0)))
    results = result_log(spark, [shown(0, p) for p in (1, 2, 7)])
    row = reports.low_satisfaction_queries(queries, results, DAY, DAY).first()
    assert (row.query_count, row.click_rate, row.deepest_click_position) == (7, pytest.approx(3 / 7), 7)
    row = reports.low_satisfaction_queries(queries, results, DAY, DAY, dedupe=True).first()
    assert (row.query_count, row.click_rate, row.avg_time_to_click) == (5, 0.2, 20.0)


def test_positions_by_click_and_by_query_date(tables):
    by_click = reports.engagement_by_position(tables.search_results, DAY, DAY).collect()
    assert all(r.ctr == 1.0 for r in by_click) and [r.position for r in by_click] == [1, 2, 9]
    by_query = reports.engagement_by_position(
        tables.search_results, DAY, DAY, date_basis="query", queries=tables.search_queries
    )
    assert by_query.first().ctr == pytest.approx(4 / 9)
    one = reports.engagement_by_position(
        tables.search_results, DAY, DAY, "B", tables.search_sessions, "query", tables.search_queries
    ).collect()
    assert [(r.position, r.impression_count) for r in one] == [(1, 1)]


def test_bad_arguments(tables):
    for call in (
        lambda: reports.metric_timeseries(tables.daily_metrics, "avg_ctr; drop", DAY, DAY),
        lambda: reports.metric_timeseries(tables.daily_metrics, "avg_ctr", DAY, DAY, "date"),
        lambda: reports.engagement_by_position(tables.search_results, DAY, DAY, date_basis="x"),
        lambda: reports.engagement_by_position(tables.search_results, DAY, DAY, "A"),
        lambda: pages.page("Nothing", tables, DAY, DAY),
        lambda: pages.page("A/B Testing", tables, "T"),
    ):
        with pytest.raises(ValueError):
            call()


def test_reports_on_small_tables(tables):
    s = tables
    top = reports.top_queries(s.search_queries, DAY, DAY, 2).collect()
    assert [(r.query_text, r.query_count) for r in top] == [("cat", 3), ("cat food", 2)]
    pair = reports.reformulation_patterns(s.search_queries, DAY, DAY).collect()
    assert (pair[0].original_query, pair[0].reformulated_query) == ("cat", "cat food")
    assert pair[0].reformulation_type == "expanded" and pair[0].frequency == 2
    assert reports.user_sessions(s.search_sessions, 1).first().session_id == "s"
    assert reports.session_details(s.search_sessions, s.search_queries, "s").count() == 8
    assert reports.recent_activity(s.search_queries, s.search_sessions, 1).first().query_id == 7
    buckets = [r.query_length for r in reports.query_complexity_stats(s.search_queries, DAY, DAY).collect()]
    assert buckets == ["1-2 words"]
    shares = reports.user_segment_distribution(s.search_sessions, DAY, DAY).collect()
    assert sum(r.percentage for r in shares) == pytest.approx(100)
    assert reports.top_queries(s.search_queries, "2030-01-01", "2030-12-31").count() == 0


def test_pages(tables):
    for name in pages.PAGES:
        if name != "A/B Testing":
            for part in pages.page(name, tables, DAY, DAY).values():
                part.collect()


def test_tables_are_reachable_by_name(spark, tables):
    tables.register()
    assert spark.sql("select count(*) n from search_sessions").first().n == 2
    for name in STAR_TABLES:
        spark.catalog.dropTempView(name)
