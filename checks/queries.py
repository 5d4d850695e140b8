"""Registered queries: key -> function of the derived inputs."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from checks.inputs import END, NUDGE, START, Inputs
from clicklake.functions.period import time_of_day
from clicklake.operators import (
    engagement,
    experiments,
    profile,
    reformulation,
    relevance,
    series,
    sessions,
    shaping,
)
from clicklake.plans import pages, reports, star
from clicklake.session import shared_folder
from clicklake.sources import catalog, derived, logs

Q = Callable[[Inputs], DataFrame]


def _daily(i: Inputs) -> DataFrame:
    return reports.daily_rows(i.daily_metrics, START, END)


def _s1(i: Inputs) -> DataFrame:
    path = f"{shared_folder(i.spark)}/events_csv"
    logs.write_log(i.events, path)
    return logs.read_log(i.spark, path)


def _s2(i: Inputs) -> DataFrame:
    daily = sessions.daily_aggregates(sessions.query_metrics(i.events), digits=None)
    (path,) = logs.write_metrics({"daily": daily}, shared_folder(i.spark), "parquet")
    return i.spark.read.parquet(path)


def _s4(i: Inputs) -> DataFrame:
    i.events.createOrReplaceTempView("event_log")
    return catalog.execute(
        i.spark,
        """select user_segment, count(*) as clicks, avg(time_on_result_seconds) as avg_seconds
           from event_log
           where event_type = :kind and device_type = :device and click_position <= :top
           group by user_segment""",
        {"kind": "click", "device": "mobile", "top": 5},
    )


def _fresh_table(i: Inputs, prefix: str, columns: dict[str, str]) -> str:
    """An empty table of the catalog, of a name of its own, with its files in the shared folder."""
    name = f"{prefix}_{uuid.uuid4().hex}"
    catalog.create_table(i.spark, name, columns, location=f"{shared_folder(i.spark)}/{name}")
    return name


def _s5(i: Inputs) -> DataFrame:
    table = _fresh_table(
        i, "inserted_sessions",
        {"session_id": "TEXT", "start_time": "TIMESTAMP", "total_queries": "INTEGER",
         "session_duration": "REAL"},
    )
    columns = ["total_queries", "session_id", "session_duration", "start_time"]
    half = F.col("total_clicks") > 2
    catalog.insert_dataframe(i.search_sessions.where(half).select(*columns), table)
    catalog.insert_dataframe(i.search_sessions.where(~half).select(*columns), table)
    return i.spark.table(table)


def _s9(i: Inputs) -> DataFrame:
    table = _fresh_table(
        i, "mobile_sessions", {"session_id": "TEXT", "browser": "TEXT", "total_clicks": "INTEGER"}
    )
    i.search_sessions.createOrReplaceTempView("search_sessions")
    catalog.execute(
        i.spark,
        f"""insert into {table} select session_id, browser, total_clicks from search_sessions
            where device_type = :device""",
        {"device": "mobile"},
    )
    return i.spark.table(table)


def _s10(i: Inputs) -> DataFrame:
    i.search_sessions.createOrReplaceTempView("search_sessions")
    return catalog.execute(
        i.spark,
        """select browser, count(*) as sessions, sum(total_clicks) as clicks
           from search_sessions where total_queries > ? group by browser""",
        [1],
    )


def _segment_baseline(i: Inputs) -> DataFrame:
    """CTR and searches per segment, with sessions per day as traffic."""
    rates = engagement.click_through_rate(i.events, ["user_segment"], period=None)
    folded = sessions.searches(i.events).groupBy("user_segment", F.to_date("timestamp").alias("d"))
    traffic = (
        folded.agg(F.count_distinct("session_id").alias("n"))
        .groupBy("user_segment")
        .agg(F.avg("n").alias("daily_traffic"))
    )
    return rates.join(traffic, "user_segment")


def _x7(i: Inputs) -> DataFrame:
    rate = F.col("click_through_rate")
    return _segment_baseline(i).select(
        "user_segment",
        experiments.required_sample_size(rate, 0.02).alias("required_n"),
        experiments.required_sample_size(rate, 0.02, two_sided=False).alias("required_n_one_sided"),
    )


def _x8(i: Inputs) -> DataFrame:
    needed = experiments.required_sample_size(F.col("click_through_rate"), 0.02)
    return _segment_baseline(i).select(
        "user_segment", experiments.days_to_fill(needed, F.col("daily_traffic")).alias("days")
    )


def _x9(i: Inputs) -> DataFrame:
    return _segment_baseline(i).select(
        "user_segment",
        experiments.minimum_detectable_effect(
            F.col("click_through_rate"), F.col("total_searches")
        ).alias("mde"),
    )


def _ctr_by_day(i: Inputs) -> DataFrame:
    return engagement.click_through_rate(i.events).select(
        F.col("period").alias("date"), F.col("click_through_rate").alias("ctr")
    )


def _c12_user_type(i: Inputs) -> DataFrame:
    typed = shaping.with_user_type(sessions.session_metrics(i.events))
    return typed.groupBy("user_type").agg(
        F.count(F.lit(1)).alias("session_count"),
        F.avg("num_queries").alias("avg_queries"),
        F.avg("num_clicks").alias("avg_clicks"),
    )


def _c12_time_of_day(i: Inputs) -> DataFrame:
    tagged = i.events.withColumn("time_of_day", time_of_day(F.col("timestamp")))
    return engagement.click_through_rate(tagged, ["time_of_day"], period=None)


def _d8(i: Inputs) -> DataFrame:
    chosen = shaping.LogFilter(
        start="2024-01-05", end="2024-01-25", device="Mobile", user_type="Returning",
        time_of_day="Afternoon", engagement="Medium Engagement",
    )
    return engagement.click_through_rate(chosen.apply(i.events), ["user_segment"], period=None)


def _x2_long(i: Inputs) -> DataFrame:
    return experiments.samples(i.click_sample, ["dwell_time", "time_to_click"])


def _profiles(i: Inputs) -> DataFrame:
    return profile.session_profiles(i.profiled_queries)


def _page(name: str, part: str) -> Q:
    def run(i: Inputs) -> DataFrame:
        return pages.page(name, i.star, START, END)[part]

    return run


QUERIES: dict[str, Q] = {
    # logs derived from the supplied tables
    "a_event_log": lambda i: derived.event_log(i.spark, i.folder),
    "b_result_log": lambda i: derived.result_log(i.spark, i.folder),
    # sources, sinks, catalog
    "s1_csv_round_trip": _s1,
    "s2_saved_metrics": _s2,
    "s4_named_parameters": _s4,
    "s5_insert_dataframe": _s5,
    "s6_duplicate_keys": lambda i: catalog.duplicate_keys(i.search_results, "document_id"),
    "s9_insert_select": _s9,
    "s10_free_sql": _s10,
    # reporting tables
    "t1_search_sessions": lambda i: star.search_sessions(
        star.query_facts(i.queries, i.results), i.users
    ),
    "t2_search_queries": lambda i: star.search_queries(star.query_facts(i.queries, i.results)),
    "t2_search_queries_limited": lambda i: star.search_queries(
        i.facts, max_gap_seconds=90 * 86400, min_similarity=0.4
    ),
    "t3_search_results": lambda i: star.search_results(i.results),
    "t3_results_of_nested_log": lambda i: profile.explode_results(i.nested),
    "t4_daily_metrics": lambda i: star.daily_metrics(
        star.query_facts(i.queries, i.results), i.users
    ),
    "t5_ab_test_results": lambda i: i.ab_tests,
    # session, query and daily metrics
    "p1_session_metrics": lambda i: sessions.session_metrics(i.events),
    "p1_session_metrics_plain_log": lambda i: sessions.session_metrics(i.plain_events),
    "p2_time_to_first_click": lambda i: sessions.time_to_first_click(i.events),
    "p3_query_metrics": lambda i: sessions.query_metrics(i.events),
    "p4_daily_aggregates": lambda i: i.metrics.daily_aggregates(),
    "p4_daily_unrounded": lambda i: i.metrics.daily_aggregates(None),
    "p5_segment_aggregates": lambda i: i.metrics.segment_aggregates(),
    "p6_quality_score": lambda i: i.metrics.quality_score(),
    "p7_summary_statistics": lambda i: i.metrics.summary_statistics(),
    # engagement
    "e1_ctr_daily": lambda i: engagement.click_through_rate(i.events),
    "e1_ctr_daily_segment": lambda i: engagement.click_through_rate(i.events, ["user_segment"]),
    "e1_ctr_weekly_device": lambda i: engagement.click_through_rate(
        i.events, ["device_type"], "weekly"
    ),
    "e1_ctr_monthly": lambda i: engagement.click_through_rate(i.events, [], "monthly"),
    "e2_time_to_click_daily": lambda i: engagement.time_to_click(i.events),
    "e2_time_to_click_weekly_device": lambda i: engagement.time_to_click(
        i.events, ["device_type"], "weekly"
    ),
    "e3_session_engagement": lambda i: engagement.session_engagement(i.events),
    "e3_session_engagement_weekly": lambda i: engagement.session_engagement(i.events, "weekly"),
    "e4_click_positions_daily": lambda i: engagement.click_position_metrics(i.events),
    "e4_click_positions_monthly_segment": lambda i: engagement.click_position_metrics(
        i.events, ["user_segment"], "monthly"
    ),
    "e5_result_engagement_daily": lambda i: engagement.result_engagement(i.events),
    "e5_result_engagement_weekly": lambda i: engagement.result_engagement(i.events, "weekly"),
    "e6_user_segments": lambda i: engagement.user_engagement_segments(i.events),
    "e6_user_segments_plain_log": lambda i: engagement.user_engagement_segments(i.plain_events),
    "e9_engagement_summary": lambda i: engagement.engagement_summary(i.events),
    "e10_ctr_overall": lambda i: engagement.click_through_rate(i.events, period=None),
    "e10_ctr_by_segment": lambda i: engagement.click_through_rate(
        i.events, ["user_segment", "device_type"], period=None
    ),
    "e10_zero_click_rate": lambda i: engagement.zero_click_rate(i.events, ["device_type"]),
    "e10_time_to_first_click": lambda i: engagement.mean_time_to_first_click(i.events),
    # relevance
    "r1_ndcg": lambda i: relevance.ndcg(i.results, (10,)),
    "r1_ndcg_dwell_gain": lambda i: relevance.ndcg(i.results, (10,), relevance.dwell_gain()),
    "r2_mrr": lambda i: relevance.mean_reciprocal_rank(i.results),
    "r3_query_success": lambda i: relevance.query_success_rate(i.results),
    "r4_reformulation": lambda i: relevance.reformulation_metrics(i.results),
    "r4_reformulation_by_time": lambda i: relevance.reformulation_metrics(
        i.results, order_by="timestamp"
    ),
    "r5_satisfaction": lambda i: relevance.satisfaction_score(i.results),
    "r6_ranking_quality": lambda i: relevance.ranking_quality(i.results),
    "r7_compare_relevance": lambda i: relevance.compare_relevance(i.results),
    "r8_mrr_clicked_only": lambda i: relevance.mean_reciprocal_rank(
        i.results, count_no_click=False
    ),
    # reports
    "q1_daily_metrics": lambda i: reports.daily_metrics(i.daily_metrics, START, END),
    "q1_daily_metrics_segment": lambda i: reports.daily_metrics(
        i.daily_metrics, START, END, "MACHINERY"
    ),
    "q2_session_details": lambda i: reports.session_details(
        i.search_sessions, i.search_queries, "30-1997"
    ),
    "q3_query_results": lambda i: reports.query_results(i.search_results, 42),
    "q4_user_sessions": lambda i: reports.user_sessions(i.search_sessions, 30, 5),
    "q5_top_queries": lambda i: reports.top_queries(i.search_queries, START, END),
    "q6_reformulations": lambda i: reports.reformulation_patterns(i.search_queries, START, END),
    "q7_positions": lambda i: reports.engagement_by_position(i.search_results, START, END),
    "q7_positions_segment": lambda i: reports.engagement_by_position(
        i.search_results, START, END, "MACHINERY", i.search_sessions
    ),
    "q7_positions_by_query_date": lambda i: reports.engagement_by_position(
        i.search_results, START, END, date_basis="query", queries=i.search_queries
    ),
    "q8_ab_test_results": lambda i: reports.ab_test_results(i.ab_tests, "T-1"),
    "q8_ab_test_values": lambda i: reports.ab_test_results(i.ab_tests, "T-1").drop(
        "p_value", "significant"
    ),
    "q9_metric_timeseries": lambda i: reports.metric_timeseries(
        i.daily_metrics, "avg_ctr", START, END, device_type="mobile"
    ),
    "q10_segment_distribution": lambda i: reports.user_segment_distribution(
        i.search_sessions, START, END
    ),
    "q11_device_distribution": lambda i: reports.device_type_distribution(
        i.search_sessions, START, END
    ),
    "q12_low_satisfaction": lambda i: reports.low_satisfaction_queries(
        i.search_queries, i.search_results, START, END
    ),
    "q12_low_satisfaction_deduped": lambda i: reports.low_satisfaction_queries(
        i.search_queries, i.search_results, START, END, dedupe=True
    ),
    "q13_zero_click": lambda i: reports.zero_click_stats(
        i.search_queries, i.search_sessions, START, END
    ),
    "q14_complexity": lambda i: reports.query_complexity_stats(i.search_queries, START, END),
    "q15_recent_activity": lambda i: reports.recent_activity(i.search_queries, i.search_sessions),
    # reports over tables stored by month
    "q5_top_queries_by_month": lambda i: reports.top_queries(i.stored_star.search_queries, START, END),
    "q6_reformulations_by_month": lambda i: reports.reformulation_patterns(
        i.stored_star.search_queries, START, END
    ),
    "q7_positions_by_month": lambda i: reports.engagement_by_position(
        i.stored_star.search_results, START, END
    ),
    "q7_positions_by_query_month": lambda i: reports.engagement_by_position(
        i.stored_star.search_results, START, END, date_basis="query",
        queries=i.stored_star.search_queries,
    ),
    "q12_low_satisfaction_by_month": lambda i: reports.low_satisfaction_queries(
        i.stored_star.search_queries, i.stored_star.search_results, START, END
    ),
    "q15_recent_activity_by_month": lambda i: reports.recent_activity(
        i.stored_star.search_queries, i.stored_star.search_sessions
    ),
    "t4_daily_metrics_merged": lambda i: star.daily_rows(
        star.merged_states(
            star.daily_state(i.facts.where(f"timestamp <= '{END} 12:00:00'")),
            star.daily_state(i.facts.where(f"timestamp > '{END} 12:00:00'")),
        ),
        i.users,
    ),
    # experiments and series
    "x1_confidence_interval": lambda i: experiments.confidence_intervals(
        i.search_sample, "search_latency_ms", ["variant"]
    ),
    "x1_mean_and_error": lambda i: experiments.confidence_intervals(
        i.search_sample, "search_latency_ms", ["variant"]
    ).drop("lower", "upper"),
    "x2_arm_statistics": lambda i: experiments.arm_statistics(_x2_long(i), ["metric"]),
    "x2_arm_statistics_binary": lambda i: experiments.arm_statistics(
        experiments.samples(i.search_sample, ["has_click", "search_latency_ms"]), ["metric"]
    ),
    "x2_rank_test": lambda i: experiments.compare_arms(
        experiments.samples(i.search_sample, ["has_click"]), draws=0
    ).select("metric", "p_value", "significant", "test_type"),
    "x2_compare_arms": lambda i: experiments.compare_arms(
        experiments.samples(i.search_sample, ["has_click"])
    ),
    "x3_analyze_experiment": lambda i: experiments.analyze_experiment(
        i.click_sample, ["dwell_time", "time_to_click"]
    ),
    "x3_differences": lambda i: experiments.analyze_experiment(
        i.click_sample, ["dwell_time", "time_to_click"], draws=0
    ).select(
        "metric", "control_mean", "experiment_mean", "absolute_difference",
        "relative_difference_percent", "control_sample_size", "experiment_sample_size",
        "p_value", "significant", "test_type",
    ),
    "x4_segment_impact": lambda i: experiments.segment_impact(
        i.click_sample, "device_type", "dwell_time"
    ),
    "x4_segment_differences": lambda i: experiments.segment_impact(
        i.click_sample, "device_type", "dwell_time", draws=0
    ).select(
        "metric", "segment", "segment_size", "segment_size_percent", "control_mean",
        "experiment_mean", "absolute_difference", "control_sample_size", "experiment_sample_size",
        "p_value", "significant", "test_type",
    ),
    "x5_timeseries_intervals": lambda i: experiments.timeseries_intervals(
        i.search_sample, "search_latency_ms"
    ),
    "x5_timeseries_means": lambda i: experiments.timeseries_intervals(
        i.search_sample, "search_latency_ms"
    ).drop("search_latency_ms_lower", "search_latency_ms_upper"),
    "x6_anomalies": lambda i: series.detect_anomalies(_ctr_by_day(i), "ctr"),
    "x6_anomalies_tight": lambda i: series.detect_anomalies(
        _ctr_by_day(i), "ctr", window=11, threshold=1.5
    ),
    "x6_anomaly_rows": lambda i: series.anomalous_rows(
        series.detect_anomalies(_ctr_by_day(i), "ctr", window=11, threshold=1.5), "ctr"
    ),
    "x7_sample_size": _x7,
    "x8_test_duration": _x8,
    "x9_detectable_effect": _x9,
    "x10_trend": lambda i: series.linear_trend(_ctr_by_day(i), "ctr"),
    "x10_trend_fit": lambda i: series.linear_trend(_ctr_by_day(i), "ctr").drop("p_value"),
    "x10_trend_line": lambda i: series.trend_line(_ctr_by_day(i), "ctr"),
    # page data
    "d1_overview_kpis": lambda i: pages.overview_kpis(_daily(i)),
    "d2_mean_ndcg": lambda i: pages.mean_ndcg(_daily(i)),
    "d3_ctr_anomalies": lambda i: pages.ctr_anomalies(_daily(i)),
    "d3_ctr_anomalies_raw_rows": lambda i: pages.ctr_anomalies(_daily(i), raw_rows=True),
    "d4a_overview_devices": _page("Overview", "devices"),
    "d4b_query_analysis_top": _page("Query Analysis", "top_queries"),
    "d4c_user_engagement_positions": _page("User Engagement", "positions"),
    "d4d_ndcg_trend": _page("Result Quality", "ndcg_trend"),
    "d4e_sessions": _page("Session Analysis", "sessions"),
    "d4f_segments": _page("Segmentation", "segments"),
    "d4g_ctr": _page("Trends & Anomalies", "ctr"),
    "d4h_ab_testing": lambda i: pages.page("A/B Testing", i.star, "T-1")["results"],
    "d5_session_profiles": _profiles,
    "d5_flat_nested_log": lambda i: profile.flatten_nested(i.nested),
    "d5_profiles_of_nested_log": lambda i: profile.session_profiles(profile.flatten_nested(i.nested)),
    "d5_success_rate": lambda i: profile.session_success_rate(_profiles(i)),
    "d5_success_by_device": lambda i: profile.session_success_rate(_profiles(i), "device_type"),
    "d6_top_texts": lambda i: profile.top_texts(i.queries),
    "d7_histogram_queries": lambda i: profile.histogram(_profiles(i), "num_queries", 10),
    "d7_histogram_clicks": lambda i: profile.histogram(_profiles(i), "num_clicks", 10),
    "d7_histogram_duration": lambda i: profile.histogram(_profiles(i), "duration", 20),
    "d8_filtered_ctr": _d8,
    # declared options
    "c1_sample_sessions": lambda i: shaping.sample_sessions(i.events, 0.5),
    "c2_sessionize": lambda i: shaping.sessionize(i.events, 6 * 3600).select(
        "event_id", "user_id", "session_number"
    ),
    "c3_session_length": lambda i: shaping.limit_session_length(i.queries, 2, 3),
    "c4_ctr_click_timeout": lambda i: engagement.click_through_rate(
        i.events, click_timeout=4 * 3600
    ),
    "c5_time_to_click_capped": lambda i: engagement.time_to_click(
        i.events, max_seconds=36 * 3600, keep_below_percentile=0.95, digits=None
    ),
    "c6_ndcg_at": lambda i: relevance.ndcg(i.results, (3, 5, 10), relevance.dwell_gain()),
    "c7_precision_at": lambda i: relevance.precision_at(i.results),
    "c8_map": lambda i: relevance.mean_average_precision(i.results),
    "c9_follow_up_rate": lambda i: reformulation.follow_up_rate(
        i.queries, max_gap_seconds=120 * 86400, min_similarity=0.4
    ),
    "c10_query_diversity": lambda i: reformulation.query_diversity(i.queries),
    "c11_ctr_hourly": lambda i: engagement.click_through_rate(i.events, [], "hour"),
    "c11_ctr_week_start": lambda i: engagement.click_through_rate(i.events, [], "week"),
    "c12_user_type": _c12_user_type,
    "c12_time_of_day": _c12_time_of_day,
    "c12_location": lambda i: engagement.click_through_rate(
        i.events.join(i.users.select("user_id", "location"), "user_id"), ["location"], period=None
    ),
    "c13_ndcg_distribution": lambda i: relevance.ndcg_distribution(i.results),
}


def comparable(df: DataFrame) -> DataFrame:
    """Doubles rounded as in the SQL, so that the order of additions cannot show."""

    def rounded(name: str) -> Column:
        value = F.col(name) * NUDGE
        return F.when(F.abs(value) < 1e6, F.round(value, 6)).otherwise(F.round(value, 2))

    return df.select(
        *[rounded(c).alias(c) if kind == "double" else F.col(c) for c, kind in df.dtypes]
    )
