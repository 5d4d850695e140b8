from __future__ import annotations

import math

import pytest

from clicklake.operators import reformulation as ref
from clicklake.operators import relevance as rel
from clicklake.operators import shaping
from tests.logs_by_hand import at, click, event_log, result_log, search, shown


def test_repeated_clicks_on_the_first_position_pass_one(spark):
    log = result_log(spark, [shown(1, 1), shown(1, 1)])
    expected = 2 / (1 + 1 / math.log2(3))
    for gain in (None, rel.F.lit(1.0)):
        assert rel.ndcg(log, (10,), gain).first().ndcg_10 == pytest.approx(expected)


def test_ndcg_ideal_uses_clicked_gains_beyond_k(spark):
    log = result_log(spark, [shown(1, 2, dwell=30.0), shown(1, 12, dwell=90.0), shown(1, 3, False)])
    found = rel.ndcg(log, (3, 10), rel.dwell_gain()).first()
    ideal = 1.0 + 0.5 / math.log2(3)
    assert found.ndcg_10 == pytest.approx(0.5 / math.log2(3) / ideal)
    assert found.ndcg_3 == found.ndcg_10 and found.click_count == 2


def test_ndcg_zero_without_clicks_or_gain(spark):
    log = result_log(spark, [shown(1, 1, False), shown(2, 1, dwell=None)])
    assert {r.query_id: r.ndcg_10 for r in rel.ndcg(log, (10,), rel.dwell_gain()).collect()} == {
        1: 0.0, 2: 0.0,
    }


def test_satisfaction_branches(spark):
    log = result_log(spark, [
        shown(1, 1, False),
        shown(2, 1, dwell=10.0, wait=None),
        shown(3, 1, dwell=100.0, wait=1.0), shown(3, 2, dwell=100.0, wait=3.0),
        shown(3, 3, dwell=100.0, wait=9.0),
        shown(4, 20, dwell=None, wait=50.0),
    ])
    rows = {r.query_id: r for r in rel.satisfaction_score(log).collect()}
    assert rows[1].satisfaction_score == 15 and rows[1].avg_dwell_time == 0
    assert rows[2].satisfaction_score == 50 + 10 + 5 - 5
    assert rows[3].satisfaction_score == 50 + 25 + 20
    assert rows[4].satisfaction_score == 50 - 10 - 10 and rows[4].avg_dwell_time is None


def test_last_query_by_id_and_by_time_differ(spark):
    log = result_log(spark, [
        shown(2, 1, True, timestamp=at(0)), shown(1, 1, False, timestamp=at(50)),
        shown(9, 1, True, timestamp=at(0), session_id="single"),
    ])
    by_id = rel.reformulation_metrics(log).first()
    by_time = rel.reformulation_metrics(log, order_by="timestamp").first()
    assert by_id.zero_click_reformulation_rate == 0.5  # session s: query 1 missed, 2 is last
    assert by_time.zero_click_reformulation_rate == 0.0  # session s: query 1 is last
    assert by_id.avg_queries_per_session == 1.5 and by_id.reformulation_rate == 0.5
    with pytest.raises(ValueError):
        rel.reformulation_metrics(log, order_by="random")


def test_first_click_is_the_earliest(spark):
    log = result_log(spark, [
        shown(1, 1, timestamp=at(9)), shown(1, 4, timestamp=at(2)), shown(2, 1, False),
    ])
    assert rel.mean_reciprocal_rank(log).first().mrr == 0.125
    assert rel.mean_reciprocal_rank(log, count_no_click=False).first().mrr == 0.25
    quality = rel.ranking_quality(log).first()
    assert quality.successful_query_rate == 0.5 and quality.first_position_ctr == 0.5
    assert quality.avg_click_position == 2.5


def test_comparison_with_zero_baseline_is_infinite(spark):
    log = result_log(spark, [shown(1, 1, False), shown(2, 1, True, variant="experiment", session_id="t")])
    rows = {r.metric: r for r in rel.compare_relevance(log).collect()}
    assert len(rows) == 9
    assert math.isinf(rows["mrr"].relative_diff_percent) and rows["mrr"].experiment == 1.0
    assert rows["abandonment_rate"].absolute_diff == -1.0


def test_average_precision(spark):
    log = result_log(spark, [shown(1, 2), shown(1, 4), shown(1, 11), shown(2, 1, False)])
    assert rel.mean_average_precision(log).first().map_10 == pytest.approx((0.5 + 0.5) / 2 / 2)
    row = rel.precision_at(log).first()
    assert row.precision_3 == pytest.approx(1 / 3 / 2) and row.precision_5 == pytest.approx(0.2)


def _queries(spark, rows):
    return spark.createDataFrame(
        rows, "session_id string, query_id long, query_text string, timestamp timestamp_ntz"
    )


@pytest.mark.parametrize("slice_rows", [0, 10**9])
def test_previous_query_limits(spark, slice_rows):
    rows = [("a", 1, "red shoes", at(0)), ("a", 2, "red shoe", at(600)),
            ("a", 3, "red shoes", at(1300)), ("a", 4, "laptop", at(1301)), ("b", 5, "laptop", at(1302))]
    queries = _queries(spark, rows)

    def links(**limits):
        linked = ref.with_previous_query(queries, slice_rows=slice_rows, **limits)
        return {r.query_id: r.reformulation_of for r in linked.collect()}

    assert links() == {1: None, 2: 1, 3: 2, 4: 3, 5: None}
    assert links(max_gap_seconds=600, min_similarity=0.7) == {1: None, 2: 1, 3: None, 4: None, 5: None}
    rate = ref.follow_up_rate(queries, slice_rows=slice_rows).first()
    assert (rate.total_queries, rate.refined_queries, rate.reformulation_rate) == (5, 1, 0.2)


def test_diversity(spark):
    queries = _queries(spark, [("a", n, t, at(n)) for n, t in enumerate("xxyz")])
    row = ref.query_diversity(queries).first()
    assert (row.total_queries, row.unique_queries, row.diversity, row.repeated_share) == (4, 3, 0.75, 0.5)


def test_session_length_limits(spark):
    queries = _queries(spark, [("a", n, "q", at(n)) for n in range(5)] + [("b", 9, "q", at(0))])
    kept = shaping.limit_session_length(queries, 2, 3)
    assert sorted(r.query_id for r in kept.collect()) == [0, 1, 2]
    assert shaping.limit_session_length(queries, 1, None).count() == 6


def test_sampling_keeps_whole_sessions_and_repeats(spark):
    log = event_log(spark, [search(f"s{n // 4}", n % 4, at(n)) for n in range(800)])
    kept = shaping.sample_sessions(log, 0.3)
    sizes = {r["count"] for r in kept.groupBy("session_id").count().collect()}
    assert sizes == {4}
    assert 30 < kept.select("session_id").distinct().count() < 90
    again = shaping.sample_sessions(log.repartition(3), 0.3)
    assert sorted(r.event_id for r in again.collect()) == sorted(r.event_id for r in kept.collect())
    assert shaping.sample_sessions(log, 1.0).count() == 800


def test_filter(spark):
    log = event_log(spark, [
        search("a", 0, at(0), device_type="Mobile"), click("a", 0, at(1)),
        search("b", 0, at(86400), device_type="mobile"), search("c", 0, at(0), device_type="tablet", user=2),
    ])
    assert shaping.LogFilter(device="MOBILE").apply(log).count() == 3
    assert shaping.LogFilter(device="All").apply(log).count() == 4
    assert shaping.LogFilter(start="2024-03-05").apply(log).count() == 1
    assert shaping.LogFilter(end="2024-03-04", time_of_day="Morning").apply(log).count() == 3
    assert shaping.LogFilter(user_type="Returning").apply(log).first().session_id == "b"
    assert shaping.LogFilter(engagement="Low Engagement").apply(log).first().session_id == "c"
