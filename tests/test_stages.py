"""Stored results are shared while their input stays as it is."""

from __future__ import annotations

import pytest

from clicklake.plans.metrics import MetricTables
from clicklake.sources.derived import event_log
from clicklake.sources.stages import Stages

FOLDER = "/root/testdata/sf0.001"


def test_a_changed_input_is_not_served_stale(spark, tmp_path):
    source, calls = str(tmp_path / "in"), []

    def build():
        calls.append(1)
        return spark.read.parquet(source).selectExpr("sum(id) as total")

    spark.range(10).write.parquet(source)
    stages = Stages(spark, [source])
    assert [stages.get("total", build).first().total for _ in range(3)] == [45] * 3 and len(calls) == 1
    assert Stages(spark, [source]).get("total", build).first().total == 45 and len(calls) == 1
    former = stages.get("total", build).inputFiles()
    spark.range(10, 12).write.mode("append").parquet(source)
    assert stages.get("total", build).first().total == 66 and len(calls) == 2
    with pytest.raises(Exception):
        spark.read.parquet(*former).count()
    stages.drop()
    assert stages.get("total", build).first().total == 66 and len(calls) == 3


def test_later_metrics_read_the_stored_query_metrics(spark):
    asked = []

    def events():
        asked.append(1)
        return event_log(spark, FOLDER)

    tables = MetricTables(Stages(spark, [FOLDER]), events)
    tables.stages.drop()
    for later in (tables.daily_aggregates, tables.segment_aggregates, tables.quality_score, tables.summary_statistics):
        files = later().inputFiles()
        assert files and all("/query_metrics/" in file for file in files)
    assert len(asked) == 1
