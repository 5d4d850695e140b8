"""The metric tables of an event log, of which the later ones read the stored query metrics."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from clicklake.operators import sessions
from clicklake.sources.stages import Stages


class MetricTables:
    """Query metrics are computed once and stored; daily, segment, quality and summary figures read them."""

    def __init__(self, stages: Stages, events: Callable[[], DataFrame]) -> None:
        self.stages, self.events = stages, events

    def query_metrics(self) -> DataFrame:
        return self.stages.get("query_metrics", lambda: sessions.query_metrics(self.events()))

    def session_metrics(self) -> DataFrame:
        return self.stages.get("session_metrics", lambda: sessions.session_metrics(self.events()))

    def daily_aggregates(self, digits: int | None = 4) -> DataFrame:
        return sessions.daily_aggregates(self.query_metrics(), digits)

    def segment_aggregates(self, digits: int | None = 4) -> DataFrame:
        return sessions.segment_aggregates(self.query_metrics(), digits)

    def quality_score(self, digits: int | None = 4) -> DataFrame:
        return sessions.quality_score(self.daily_aggregates(digits))

    def summary_statistics(self) -> DataFrame:
        return sessions.summary_statistics(self.query_metrics())
