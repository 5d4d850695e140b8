"""Physical plans: pushdown, pruning, early limits, and scans without hot keys."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from checks.inputs import END, START, Inputs
from clicklake.operators import reformulation, relevance
from clicklake.plans import reports, star
from clicklake.sources import derived

FOLDER = "/root/testdata/sf0.001"
QUERIES = contract.queries()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_date_filter_and_columns_reach_the_scan(spark):
    queries = Inputs(spark, FOLDER).search_queries
    text = plan(reports.top_queries(queries, START, END))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(timestamp", text)
    (schema,) = set(re.findall(r"ReadSchema: struct<([^>]*)>", text))
    assert {c.split(":")[0] for c in schema.split(",")} == {
        "query_text", "timestamp", "has_click", "time_to_first_click",
    }
    assert "TakeOrderedAndProject" in text


def test_top_gains_are_limited_before_the_shuffle(spark):
    text = plan(relevance.ndcg(Inputs(spark, FOLDER).results, (10,), relevance.dwell_gain()))
    partial = next(n for n, line in enumerate(text.splitlines()) if "WindowGroupLimit" in line and "Partial" in line)
    assert any("Exchange" in line for line in text.splitlines()[:partial])


def test_ordinary_keys_cost_one_shuffle_of_the_rows(spark):
    """Without hot keys the runtime drops the slicing joins altogether."""
    df = QUERIES["c2_sessionize"](spark, FOLDER)
    summed = df.groupBy().sum("session_number")
    summed.collect()
    final = plan(summed).split("== Initial Plan ==")[0]
    assert "Join" not in final


def test_tables_by_month_are_pruned(spark, tmp_path):
    queries = Inputs(spark, FOLDER).search_queries
    stored = star.save_by_month(queries, str(tmp_path / "queries"), "query_id")
    report = reports.top_queries(stored, START, END)
    text = plan(report)
    assert re.search(r"PartitionFilters: \[[^\]]*month", text)
    plain = reports.top_queries(queries, START, END)
    counts = ["query_text", "query_count", "click_count"]
    assert report.select(counts).collect() == plain.select(counts).collect()
    assert [r.avg_time_to_click for r in report.collect()] == pytest.approx(
        [r.avg_time_to_click for r in plain.collect()]
    )
    assert stored.count() == queries.count()


def test_all_tables_are_stored_by_month_and_pruned(spark, tmp_path):
    built = Inputs(spark, FOLDER).star
    stored = built.save(str(tmp_path))
    for name in star.TIME_COLUMNS:
        assert getattr(stored, name).count() == getattr(built, name).count()
    daily = reports.daily_rows(stored.daily_metrics, START, END)
    assert re.search(r"PartitionFilters: \[[^\]]*month", plan(daily))
    assert daily.count() == reports.daily_rows(built.daily_metrics, START, END).count()
    clicks = reports._dated(stored.search_results, "click_time", START, END)
    assert re.search(r"PartitionFilters: \[[^\]]*month", plan(clicks))
    assert clicks.count() == reports._dated(built.search_results, "click_time", START, END).count()


def month_filters(text: str, column: str) -> list[str]:
    return [m for m in re.findall(r"PartitionFilters: \[([^\]]*)\]", text) if re.search(rf"\b{column}#", m)]


@pytest.fixture(scope="module")
def by_month(spark):
    return Inputs(spark, FOLDER).stored_star


def test_dates_of_queries_reach_the_other_side(spark, by_month):
    s = by_month
    pairs = plan(reports.reformulation_patterns(s.search_queries, START, END))
    assert len(month_filters(pairs, "previous_month")) == 1 and len(month_filters(pairs, "month")) >= 1
    shown = plan(reports.engagement_by_position(s.search_results, START, END, date_basis="query", queries=s.search_queries))
    assert len(month_filters(shown, "query_month")) == 1
    low = plan(reports.low_satisfaction_queries(s.search_queries, s.search_results, START, END))
    assert len(month_filters(low, "query_month")) == 1


def test_recent_activity_reads_the_newest_months(spark, by_month):
    queries, sessions = by_month.search_queries, by_month.search_sessions
    text = plan(reports.recent_activity(queries, sessions, 3))
    months = reports._months_back(queries)
    bounds = {m for found in month_filters(text, "month") for m in re.findall(r">= (\d{4}-\d\d)", found)}
    assert len(months) > 20 and bounds and min(bounds) >= months[8]
    plain = Inputs(spark, FOLDER)
    for limit in (1, 3, 100, 10**6):
        wanted = reports.recent_activity(plain.search_queries, plain.search_sessions, limit)
        assert reports.recent_activity(queries, sessions, limit).collect() == wanted.collect()


def test_recent_activity_with_early_and_missing_sessions(spark, tmp_path):
    asked = [(n, f"s{n % 7}" if n % 3 else f"none{n}", "q", f"2024-{1 + n % 12:02d}-05 00:00:{n % 60:02d}") for n in range(400)]
    queries = spark.createDataFrame(asked, "query_id long, session_id string, query_text string, time string").select(
        "query_id", "session_id", "query_text", F.col("time").cast("timestamp_ntz").alias("timestamp"),
        F.lit(True).alias("has_click"), F.lit(1.0).alias("time_to_first_click"),
    )
    queries = queries.union(queries.limit(1).select(F.lit(-1), F.lit("s1"), "query_text", F.lit(None), "has_click", "time_to_first_click"))
    begun = [(f"s{n}", "2020-01-01 00:00:00" if n < 5 else "2024-12-01 00:00:00", "A", "m") for n in range(7)]
    sessions = spark.createDataFrame(begun, "session_id string, time string, user_segment string, device_type string").select(
        "session_id", F.col("time").cast("timestamp_ntz").alias("start_time"), "user_segment", "device_type"
    )
    stored = star.save_by_month(queries, f"{tmp_path}/q", "query_id"), star.save_by_month(sessions, f"{tmp_path}/s", "session_id", "start_time")
    for limit in (0, 1, 40, 300, 1000):
        assert reports.recent_activity(*stored, limit).collect() == reports.recent_activity(queries, sessions, limit).collect()
    empty = [df.where("false") for df in stored]
    assert reports.recent_activity(*empty).count() == reports.recent_activity(stored[0], empty[1]).count() == 0


def test_daily_table_joins_folded_rows_and_takes_a_new_day(spark):
    inputs = Inputs(spark, FOLDER)
    facts, users = inputs.facts, inputs.users
    text = plan(star.daily_metrics(facts, users))
    below = text[text.index("Join") :]
    assert re.search(r"HashAggregate\(keys=\[[^\]]*session_id#[^\]]*user_id#", below) and "Expand" not in text
    days = F.to_date("timestamp")
    last = facts.agg(F.max(days)).first()[0]
    late = (days == F.lit(last)) | (F.col("query_id") % 5 == 0)
    grown = star.merged_states(star.daily_state(facts.where(~late)), star.daily_state(facts.where(late)))
    found = {tuple(r[:3]): r[3:] for r in star.daily_rows(grown, users).collect()}
    wanted = {tuple(r[:3]): r[3:] for r in star.daily_metrics(facts, users).collect()}
    assert found.keys() == wanted.keys() and len(found) > 50
    assert all(found[k] == pytest.approx(wanted[k], nan_ok=True) for k in wanted if None not in wanted[k])
    assert all([x is None for x in found[k]] == [x is None for x in wanted[k]] for k in wanted)


@pytest.fixture
def no_small_tables(spark):
    """Joins as they are planned where no table is small enough to travel by itself."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def test_queries_get_their_texts_without_a_shuffle(spark, no_small_tables):
    text = plan(derived.query_log(spark, FOLDER))
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text


def test_rows_are_shuffled_before_they_get_texts(spark, no_small_tables):
    for log in (derived.result_log, derived.nested_log):
        first_shuffle = next(n for n, line in enumerate(plan(log(spark, FOLDER)).splitlines()) if "hashpartitioning" in line)
        assert all("p_name" not in line for line in plan(log(spark, FOLDER)).splitlines()[first_shuffle:] if "Exchange hash" in line)
        named = next(n for n, line in enumerate(plan(log(spark, FOLDER)).splitlines()) if "BroadcastHashJoin" in line)
        assert named < first_shuffle


def test_lists_of_results_are_not_shuffled_by_user(spark, no_small_tables):
    text = plan(derived.nested_log(spark, FOLDER))
    assert "hashpartitioning(o_custkey" in text and "hashpartitioning(user_id" not in text


def test_only_what_limits_need_is_looked_at_of_the_previous_query(spark):
    facts = Inputs(spark, FOLDER).facts
    assert "query_text, query_text" not in plan(reformulation.with_previous_query(facts))
    assert "query_text, query_text" in plan(reformulation.with_previous_query(facts, min_similarity=0.4))


def test_rows_that_name_no_query_are_not_joined_in_one_task(spark):
    rows = spark.range(400, numPartitions=4).selectExpr("id", "if(id < 390, null, id) as of")
    months = spark.sql("select 395L as _asked, '1997-03' as _month")
    found = star._with_month(rows, "of", months, "before")
    assert sorted(map(tuple, found.where("before is not null").collect())) == [(395, 395, "1997-03")]
    assert found.count() == 400 and found.columns == ["id", "of", "before"]
    sizes = found.where("of is null").groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in sizes) == 100


def test_rows_stored_by_month_are_computed_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def passed(value):
        seen.add(1)
        return value

    counted = spark.range(1000).select(F.udf(passed, "long")("id").alias("id"), F.expr("timestamp_ntz'1997-01-01' + make_dt_interval(cast(id % 90 as int))").alias("timestamp"))
    stored = star.save_by_month(counted, f"{tmp_path}/once", "id")
    assert seen.value == 1000
    assert sorted(r.id for r in stored.collect()) == list(range(1000))
