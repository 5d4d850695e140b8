"""Logs and reporting tables derived from one folder of supplied tables."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicklake.operators import experiments
from clicklake.operators.sessions import query_metrics
from clicklake.plans import star
from clicklake.plans.metrics import MetricTables
from clicklake.sources import derived
from clicklake.sources.stages import Stages

START, END = "1997-01-01", "1997-12-31"

# Both sides of a comparison are scaled by this before rounding, so
# that an exact half (a mean of two microsecond counts) is not decided by the last
# bit, which depends on the order of additions in either engine.
NUDGE = 1 + 1e-13


class Inputs:
    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def _stored(self, name: str, build) -> DataFrame:
        return derived.stored(self.spark, self.folder, name, build)

    @cached_property
    def events(self) -> DataFrame:
        return self._stored("event_log", lambda: derived.event_log(self.spark, self.folder))

    @cached_property
    def plain_events(self) -> DataFrame:
        """The event log with users as text and without ids of events."""
        return self.events.drop("event_id").withColumn("user_id", F.concat(F.lit("user_"), F.col("user_id")))

    @cached_property
    def nested(self) -> DataFrame:
        return self._stored("nested_log", lambda: derived.nested_log(self.spark, self.folder))

    @cached_property
    def metrics(self) -> MetricTables:
        return MetricTables(Stages(self.spark, [self.folder]), lambda: self.events)

    @cached_property
    def results(self) -> DataFrame:
        return self._stored("result_log", lambda: derived.result_log(self.spark, self.folder))

    @cached_property
    def queries(self) -> DataFrame:
        return derived.query_log(self.spark, self.folder)

    @cached_property
    def users(self) -> DataFrame:
        return derived.user_log(self.spark, self.folder)

    @cached_property
    def facts(self) -> DataFrame:
        return self._stored("query_facts", lambda: star.query_facts(self.queries, self.results))

    @cached_property
    def search_sessions(self) -> DataFrame:
        return self._stored("search_sessions", lambda: star.search_sessions(self.facts, self.users))

    @cached_property
    def search_queries(self) -> DataFrame:
        return self._stored("search_queries", lambda: star.search_queries(self.facts))

    @cached_property
    def search_results(self) -> DataFrame:
        return star.search_results(self.results)

    @cached_property
    def daily_metrics(self) -> DataFrame:
        return self._stored(
            "daily_metrics", lambda: star.daily_metrics(self.facts, self.users)
        )

    @cached_property
    def ab_tests(self) -> DataFrame:
        compared = experiments.analyze_experiment(
            self.click_sample, ["dwell_time", "time_to_click"], draws=0
        )
        return self._stored(
            "ab_test_results",
            lambda: experiments.stored_results(
                compared, "T-1", "ranking change", "1995-01-01", "2001-08-01"
            ),
        )

    @cached_property
    def star(self) -> star.Star:
        return star.Star(
            self.search_sessions, self.search_queries, self.search_results,
            self.daily_metrics, self.ab_tests,
        )

    @cached_property
    def stored_star(self) -> star.Star:
        """The reporting tables as ``Star.save`` stores them, by month."""
        folder = Stages(self.spark, [self.folder]).get_folder("star", self.star.save)
        return star.Star.load(self.spark, folder)

    @cached_property
    def profiled_queries(self) -> DataFrame:
        """Query rows with click counts and the device and nation of the user."""
        return self.facts.join(
            self.users.select("user_id", "device_type", "location"), "user_id", "left"
        )

    @cached_property
    def click_sample(self) -> DataFrame:
        """Clicked results: two metrics, the arm and the device of the user."""
        return self.results.where("clicked").select(
            "variant", derived.device_of(F.col("user_id")).alias("device_type"),
            "dwell_time", "time_to_click",
        )

    @cached_property
    def search_sample(self) -> DataFrame:
        """Searches: clicked or not as 0/1, latency, arm and segment."""
        return self._stored("search_sample", self._search_sample)

    def _search_sample(self) -> DataFrame:
        arms = self.events.where("event_type = 'search'").select(
            "session_id", "query_index_in_session", "variant"
        )
        return query_metrics(self.events).join(arms, ["session_id", "query_index_in_session"]).select(
            "variant", "user_segment", "date",
            F.col("has_click").cast("double").alias("has_click"), "search_latency_ms",
        )
