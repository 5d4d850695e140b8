"""Cases by hand for what the supplied tables do not show."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from clicklake.functions.numeric import half_even
from clicklake.functions.period import bucket_start, period_label, time_of_day
from clicklake.operators import engagement as eng
from clicklake.operators import sessions as ses
from tests.logs_by_hand import at, click, event_log, search


def test_click_past_midnight_counts_on_the_next_day(spark):
    late = dt.datetime(2024, 3, 4, 23, 59, 50)
    log = event_log(spark, [
        search("a", 0, late),
        click("a", 0, late + dt.timedelta(seconds=30)),
        search("b", 0, late + dt.timedelta(hours=1)),
    ])
    rows = {r.period: r for r in eng.click_through_rate(log).collect()}
    assert rows[dt.date(2024, 3, 4)].searches_with_clicks == 0
    assert rows[dt.date(2024, 3, 5)].click_through_rate == 1.0


def test_click_only_groups_and_null_keys_vanish(spark):
    log = event_log(spark, [
        search("a", 0, at(0)),
        click("a", 0, at(86400 * 3)),
        search("b", 0, at(5), user_segment=None),
    ])
    assert [r.period for r in eng.click_through_rate(log).collect()] == [dt.date(2024, 3, 4)]
    assert eng.click_through_rate(log, ["user_segment"]).first().total_searches == 1


def test_several_clicks_of_a_search_count_once(spark):
    log = event_log(spark, [search("a", 0, at(0)), search("a", 1, at(9)),
                            *[click("a", 0, at(n)) for n in (1, 2, 3)]])
    row = eng.click_through_rate(log).first()
    assert (row.total_searches, row.searches_with_clicks, row.ctr_percentage) == (2, 1, 50.0)


def test_click_timeout_and_time_cap(spark):
    log = event_log(spark, [search("a", 0, at(0)), click("a", 0, at(301)),
                            search("b", 0, at(0)), click("b", 0, at(300))])
    assert eng.click_through_rate(log, click_timeout=300).first().searches_with_clicks == 1
    assert eng.time_to_click(log, max_seconds=300).first().total_clicks == 1


def test_time_to_click_uses_all_clicks_and_single_value_has_no_deviation(spark):
    log = event_log(spark, [search("a", 0, at(0)), click("a", 0, at(4)), click("a", 0, at(10)),
                            search("b", 0, at(86400)), click("b", 0, at(86401))])
    first, second = eng.time_to_click(log, ["device_type"]).orderBy("period").collect()
    assert first.device_type_search == "mobile"
    assert (first.avg_time_to_click_seconds, first.median_time_to_click_seconds) == (7.0, 7.0)
    assert first.unique_sessions == 1 and first.total_clicks == 2
    assert second.std_time_to_click_seconds is None


def test_session_metrics(spark):
    log = event_log(spark, [
        search("a", 0, at(0), "x"), search("a", 1, at(60), "x"), search("a", 2, at(90), "y z"),
        click("a", 0, at(5)), click("a", 0, at(3), seconds=10.0), click("a", 2, at(100)),
        click("a", 9, at(200)),  # belongs to no search, still a click of the session
        click("only clicks", 0, at(1)), search("quiet", 0, at(2)),
    ])
    rows = {r.session_id: r for r in ses.session_metrics(log).collect()}
    assert set(rows) == {"a", "quiet"}
    a, quiet = rows["a"], rows["quiet"]
    assert (a.num_queries, a.num_clicks, a.unique_queries) == (3, 4, 2)
    assert a.click_through_rate == pytest.approx(4 / 3)
    assert a.satisfaction_rate == 0.75
    assert a.reformulation_rate == pytest.approx(1 / 3)
    assert a.avg_time_to_click == pytest.approx((3 + 10) / 2)
    assert a.session_duration_seconds == 90.0
    assert a.avg_query_length == pytest.approx(5 / 3)
    assert quiet.satisfaction_rate == 0 and quiet.avg_time_to_click is None


def test_first_row_attributes_come_from_the_earliest_search(spark):
    log = event_log(spark, [
        search("a", 1, at(9), device_type="desktop"), search("a", 0, at(1), device_type="tablet"),
    ])
    assert ses.session_metrics(log).first().device_type == "tablet"


def test_searches_sharing_a_key_each_wait_for_the_same_click(spark):
    log = event_log(spark, [search("a", 0, at(0)), search("a", 0, at(4)), click("a", 0, at(10))])
    row = ses.session_metrics(log).first()
    assert (row.num_queries, row.avg_time_to_click) == (2, 8.0)
    assert ses.query_metrics(log).count() == 2


def test_query_metrics_first_position_is_the_least(spark):
    log = event_log(spark, [search("a", 0, at(0)), click("a", 0, at(1), 7), click("a", 0, at(2), 2, 5.0),
                            search("a", 1, at(5))])
    clicked, missed = ses.query_metrics(log).orderBy("query_index_in_session").collect()
    assert (clicked.first_click_position, clicked.avg_click_position) == (2, 4.5)
    assert clicked.has_satisfied_click and clicked.num_clicks == 2
    assert missed.avg_time_on_result is None and missed.has_satisfied_click is False


def test_quality_score_is_null_where_a_part_is_null(spark):
    log = event_log(spark, [search("a", 0, at(0)), click("a", 0, at(1)), search("b", 0, at(86400))])
    scores = ses.quality_score(ses.daily_aggregates(ses.query_metrics(log))).orderBy("date").collect()
    assert scores[0].search_quality_score == pytest.approx(80.0)
    assert scores[1].search_quality_score is None


def test_user_classes(spark):
    def user(n, searches, clicks, good):
        rows = [search(f"s{n}", k, at(k), user=n) for k in range(searches)]
        return rows + [
            click(f"s{n}", 0, at(k), seconds=40.0 if k < good else 1.0, user=n) for k in range(clicks)
        ]

    log = event_log(spark, [
        *user(1, 10, 7, 5), *user(2, 10, 4, 2), *user(3, 10, 9, 1), *user(4, 10, 0, 0),
    ])
    found = {r.user_id: r for r in eng.user_engagement_segments(log).collect()}
    assert [found[n].engagement_segment for n in (1, 2, 3, 4)] == [
        "highly_engaged", "moderately_engaged", "low_engaged", "disengaged",
    ]
    assert found[4].satisfaction_rate == 0


def test_summary_without_clicks(spark):
    row = eng.engagement_summary(event_log(spark, [search("a", 0, at(0))])).first()
    assert row.overall_ctr == 0 and row.avg_time_to_click is None and row.top_3_click_rate is None
    assert row.avg_queries_per_session == 1


def test_empty_log_gives_empty_frames(spark):
    log = event_log(spark, [])
    assert eng.click_through_rate(log).count() == 0
    assert eng.click_position_metrics(log).count() == 0
    assert eng.result_engagement(log).count() == 0
    assert ses.session_metrics(log).count() == 0


def test_period_labels(spark):
    when = F.lit("2024-03-03 23:30:00").cast("timestamp_ntz")  # a Sunday
    row = spark.range(1).select(
        period_label(when, "daily").alias("d"), period_label(when, "weekly").alias("w"),
        period_label(when, "monthly").alias("m"), bucket_start(when, "hour").alias("h"),
        bucket_start(when, "month").alias("mo"), time_of_day(when).alias("t"),
    ).first()
    assert row.d == dt.date(2024, 3, 3)
    assert row.w == "2024-02-26/2024-03-03" and row.m == "2024-03"
    assert row.h == dt.datetime(2024, 3, 3, 23) and row.mo == dt.datetime(2024, 3, 1)
    assert row.t == "evening"
    with pytest.raises(ValueError):
        period_label(when, "yearly")


def test_rounding_is_half_to_even(spark):
    values = [0.03125, 0.00005, 2.5, 1.005, -0.125]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r[0] for r in df.select(half_even(F.col("v"), 4)).collect()][:2] == [0.0312, 0.0]
    assert [r[0] for r in df.select(half_even(F.col("v"), 0)).collect()][2] == 2.0
    assert df.select(half_even(F.col("v"), None)).first()[0] == 0.03125
