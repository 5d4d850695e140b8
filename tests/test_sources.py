from __future__ import annotations

import datetime as dt

import pytest

from clicklake import schemas
from clicklake.operators import sessions as ses
from clicklake.sources import catalog, logs
from tests.logs_by_hand import at, click, event_log, search


@pytest.fixture
def log(spark):
    return event_log(spark, [search("a", 0, at(0.25), 'say "hi", you'), click("a", 0, at(3))])


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_log_round_trip(spark, log, tmp_path, fmt):
    logs.write_log(log, str(tmp_path / "log"), fmt)
    back = logs.read_log(spark, str(tmp_path / "log"), fmt=fmt)
    assert back.schema == schemas.EVENT_LOG
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, log.collect()))


def test_reading_needs_a_path_and_a_known_format(spark):
    with pytest.raises(ValueError):
        logs.read_log(spark, None)
    with pytest.raises(ValueError):
        logs.read_log(spark, "/x", fmt="xml")


def test_malformed_timestamp_fails(spark, tmp_path):
    header = ",".join(schemas.EVENT_LOG.fieldNames())
    (tmp_path / "bad.csv").write_text(f"{header}\n1,s,1,yesterday{',' * 14}\n")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|parse"):
        logs.read_log(spark, str(tmp_path / "bad.csv")).collect()


def test_metrics_are_saved_by_name(spark, log, tmp_path):
    queries = ses.query_metrics(log)
    paths = logs.write_metrics(
        {"queries": queries, "daily": ses.daily_aggregates(queries)}, str(tmp_path)
    )
    assert [p.rsplit("/", 1)[1] for p in paths] == ["queries_metrics", "daily_metrics"]
    assert spark.read.option("header", True).csv(paths[1]).first().total_queries == "1"


def test_default_tables(spark):
    catalog.initialize(spark)
    for name, layout in schemas.STAR_TABLES.items():
        assert catalog.table_exists(spark, name)
        found = catalog.table_schema(spark, name)
        assert [(f.name, f.dataType) for f in found] == [(f.name, f.dataType) for f in layout]
    catalog.create_default_tables(spark)  # again: no error
    assert catalog.describe_table(spark, "daily_metrics").first().name == "date"
    for name in schemas.STAR_TABLES:
        spark.sql(f"drop table {name}")
    with pytest.raises(ValueError):
        catalog.table_schema(spark, "daily_metrics")


def test_insert_modes_and_counts(spark):
    df = spark.range(5).selectExpr("id", "cast(id as string) as name")
    assert catalog.insert_dataframe(df, "things") == 5
    assert catalog.insert_dataframe(df.select("name", "id"), "things") == 5  # matched by name
    assert spark.table("things").count() == 10
    assert catalog.insert_dataframe(df.limit(2), "things", "replace") == 2
    assert spark.table("things").count() == 2
    with pytest.raises(Exception, match="exists"):
        catalog.insert_dataframe(df, "things", "fail")
    with pytest.raises(ValueError):
        catalog.insert_dataframe(df, "things", "merge")
    spark.sql("drop table things")


def test_created_table_takes_literal_rows_and_reports_duplicate_keys(spark):
    catalog.create_table(
        spark, "visits", {"visit_id": "TEXT", "seconds": "REAL", "day": "DATE"}, "visit_id"
    )
    day = dt.date(2024, 1, 1)
    assert catalog.insert_rows(spark, "visits", [("a", 1.5, day), ("b", None, day), ("a", 2.0, None)]) == 3
    duplicates = catalog.duplicate_keys(spark.table("visits"), "visit_id").collect()
    assert [(r.visit_id, r.rows) for r in duplicates] == [("a", 2)]
    with pytest.raises(ValueError):
        catalog.create_table(spark, "v2", {"a": "TEXT"}, "b")
    spark.sql("drop table visits")


def test_sql_parameters(spark):
    spark.range(10).createOrReplaceTempView("numbers")
    assert catalog.execute(spark, "select count(*) n from numbers where id < ?", [4]).first().n == 4
    named = catalog.execute(spark, "select count(*) n from numbers where id >= :low", {"low": 7})
    assert named.first().n == 3
    hostile = catalog.execute(spark, "select count(*) n from numbers where cast(id as string) = :x", {"x": "1' or '1'='1"})
    assert hostile.first().n == 0
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
        catalog.execute(spark, "select * from nowhere")


def test_schema_text(spark):
    catalog.initialize(
        spark, "create table one (a int) using parquet;\ncreate table two (b string) using parquet;\n"
    )
    assert catalog.table_exists(spark, "one") and catalog.table_exists(spark, "two")
    spark.sql("drop table one")
    spark.sql("drop table two")


def test_names_and_folders_with_quotes(spark, tmp_path):
    folder = tmp_path / "it's"
    catalog.create_table(spark, "quoted_names", {"a`b": "TEXT"}, "a`b", location=str(folder))
    catalog.insert_rows(spark, "quoted_names", [("x",)])
    assert [tuple(r) for r in spark.table("quoted_names").collect()] == [("x",)]
    assert list(folder.glob("*.parquet"))
    spark.sql("drop table quoted_names")
