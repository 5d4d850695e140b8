"""Inputs that the supplied tables do not have: other header orders, null sessions, rates without variance."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from clicklake import session
from clicklake.operators import experiments, reformulation
from clicklake.operators.engagement import user_engagement_segments
from clicklake.operators.sessions import session_metrics
from clicklake.schemas import PLAIN_EVENT_LOG
from clicklake.sources import logs
from clicklake.sources.logs import read_log
from tests.logs_by_hand import at, click, event_log, search


def test_csv_is_read_by_header(spark, tmp_path):
    (tmp_path / "log.csv").write_text("query,extra,session_id\nred shoes,1,s1\n")
    schema = "session_id string, query string"
    wanted = spark.createDataFrame([], schema).schema
    row = logs.read_log(spark, str(tmp_path / "log.csv"), wanted).first()
    assert (row.session_id, row.query) == ("s1", "red shoes")
    (tmp_path / "short.csv").write_text("query\nred shoes\n")
    with pytest.raises(ValueError, match="session_id"):
        logs.read_log(spark, str(tmp_path / "short.csv"), wanted)


def test_queries_without_a_session_follow_no_other(spark):
    rows = [(1, None, "a", "2020-01-01 00:00:00"), (2, None, "a", "2020-01-01 00:00:01"), (3, "s", "a", "2020-01-01 00:00:00"), (4, "s", "a", "2020-01-01 00:00:02")]
    frame = spark.createDataFrame(rows, "query_id long, session_id string, query_text string, timestamp string")
    frame = frame.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    found = {r.query_id: r.reformulation_of for r in reformulation.with_previous_query(frame).collect()}
    assert found == {1: None, 2: None, 3: None, 4: 3}
    assert reformulation.follow_up_rate(frame).first().reformulation_rate == 0.25


def test_power_columns_without_variance_or_rows(spark):
    frame = spark.createDataFrame([(0.0, 0), (1.0, 10), (0.5, 10), (None, 10)], "rate double, n long")
    rows = frame.select(
        experiments.required_sample_size(F.col("rate"), 0.1).alias("size"),
        experiments.required_sample_size(F.col("rate"), F.lit(0.0)).alias("none"),
        experiments.minimum_detectable_effect(F.col("rate"), F.col("n")).alias("mde"),
    ).collect()
    assert [r["size"] for r in rows] == [0, 0, 197, None]
    assert rows[2].none is None and rows[0].mde is None and rows[1].mde == 0


def test_a_cluster_must_name_its_shared_folder(spark, monkeypatch):
    class Bare:
        master, applicationId = "spark://host:7077", "x"

        def getConf(self):  # noqa: N802
            return {}

    class Unnamed:
        sparkContext, conf = Bare(), {}  # noqa: N815

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(Unnamed())
    Bare.master = "local[4]"
    assert session.shared_folder(Unnamed())


def test_logs_without_ids_of_events_and_with_users_as_text(spark, tmp_path):
    rows = [
        search("s", 0, at(0), user=2), click("s", 0, at(3), user=2), search("s", 1, at(9), user=2),
        search("t", 1, at(0), user=1, device_type="tablet"), search("t", 0, at(0), user=1, device_type="mobile"),
    ]
    log = event_log(spark, rows)
    named = log.drop("event_id").withColumn("user_id", F.concat(F.lit("user_"), "user_id"))
    named.write.option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(str(tmp_path / "log"))
    plain = read_log(spark, str(tmp_path / "log"), PLAIN_EVENT_LOG)
    assert plain.schema["user_id"].dataType.simpleString() == "string"

    def shown(frame):
        return sorted(tuple(r) for r in frame.collect())

    by_id = [(s, f"user_{u}", *rest) for s, u, *rest in shown(session_metrics(log))]
    found = shown(session_metrics(plain))
    assert [r for r in found if r[0] == "s"] == [r for r in by_id if r[0] == "s"]
    # At one time the earlier query of the session says who it is; with ids it is the earlier event.
    device = {r.session_id: r.device_type for r in session_metrics(plain).collect()}
    assert device == {"s": "mobile", "t": "mobile"}
    assert {r.session_id: r.device_type for r in session_metrics(log).collect()} == {"s": "mobile", "t": "tablet"}
    users = {r.user_id: r.total_searches for r in user_engagement_segments(plain).collect()}
    assert users == {"user_1": 2, "user_2": 2}
