"""Reporting tables from query, result and user logs.

Everything starts from one row per query (``query_facts``): results are folded by
query before the join, so a query with very many results costs one row.
"""

from __future__ import annotations

from dataclasses import dataclass

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from clicklake import schemas
from clicklake.functions.numeric import seconds_between
from clicklake.operators.reformulation import with_previous_query
from clicklake.operators.relevance import share_of_ideal, unit_dcg, unit_ideal


# Column by which ``save_by_month`` partitions, and per table the time it is taken from
# and the column that spreads a month's rows over writers.
MONTH = "month"
# Results are partitioned by the month of their query as well, queries by that of the query they replace, so
# that a range of dates on those reaches the other side of the join.
QUERY_MONTH, PREVIOUS_MONTH = "query_month", "previous_month"
LINKED_MONTHS = {"search_results": ("query_id", QUERY_MONTH), "search_queries": ("reformulation_of", PREVIOUS_MONTH)}
TIME_COLUMNS = {
    "search_sessions": "start_time",
    "search_queries": "timestamp",
    "search_results": "click_time",
    "daily_metrics": "date",
    "ab_test_results": "start_date",
}
SPREAD_COLUMNS = {**schemas.PRIMARY_KEYS, "daily_metrics": "date", "ab_test_results": "test_id"}


@dataclass(frozen=True)
class Star:
    search_sessions: DataFrame
    search_queries: DataFrame
    search_results: DataFrame
    daily_metrics: DataFrame
    ab_test_results: DataFrame | None = None

    def register(self) -> None:
        """Make the tables available to SQL text under their names."""
        for name in schemas.STAR_TABLES:
            frame = getattr(self, name)
            if frame is not None:
                frame.createOrReplaceTempView(name)

    def save(self, folder: str) -> Star:
        """Write every table in folders by month below ``folder`` and read them back."""
        months = self.search_queries.select(
            F.col("query_id").alias("_asked"), F.date_format("timestamp", "yyyy-MM").alias("_month")
        )
        stored = {}
        for name, time_column in TIME_COLUMNS.items():
            frame, linked = getattr(self, name), ()
            if frame is None:
                continue
            if name in LINKED_MONTHS:
                key, column = LINKED_MONTHS[name]
                frame, linked = _with_month(frame, key, months, column), (column,)
            path = f"{folder.rstrip('/')}/{name}"
            stored[name] = save_by_month(frame, path, SPREAD_COLUMNS[name], time_column, linked)
        return Star(**stored)

    @staticmethod
    def load(spark: SparkSession, folder: str) -> Star:
        """The tables that ``save`` wrote below ``folder``; ``ab_test_results`` may be missing."""

        def read(name: str) -> DataFrame:
            months = [LINKED_MONTHS[name][1]] if name in LINKED_MONTHS else []
            return _by_month(spark, f"{folder.rstrip('/')}/{name}", schemas.STAR_TABLES[name], months)

        path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/ab_test_results")
        tests = path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
        return Star(**{name: read(name) for name in TIME_COLUMNS if tests or name != "ab_test_results"})


def query_facts(queries: DataFrame, results: DataFrame) -> DataFrame:
    """One row per query with its result and click figures and NDCG@10 (none shown: zeros)."""
    clicked = F.col("clicked")
    shown = results.groupBy("query_id").agg(
        F.count(F.lit(1)).alias("_results"),
        F.count_if(clicked).alias("_clicks"),
        F.min(F.when(clicked, F.col("time_to_click"))).alias("time_to_first_click"),
        F.max(F.when(clicked, F.col("position"))).alias("max_click_position"),
        unit_dcg(10).alias("_dcg"),
    )
    zero = F.lit(0).cast("long")
    return queries.join(shown, "query_id", "left").select(
        *queries.columns,
        F.coalesce("_results", zero).alias("result_count"),
        F.coalesce("_clicks", zero).alias("click_count"),
        (F.coalesce("_clicks", zero) > 0).alias("has_click"),
        "time_to_first_click",
        "max_click_position",
        F.coalesce(
            share_of_ideal(F.col("_dcg"), unit_ideal(F.col("_clicks"), 10)), F.lit(0.0)
        ).alias("ndcg_10"),
    )


def search_sessions(facts: DataFrame, users: DataFrame) -> DataFrame:
    first = F.struct("timestamp", "query_id")
    spans = facts.where(F.col("session_id").isNotNull()).groupBy("session_id").agg(
        F.min_by("user_id", first).alias("user_id"),
        F.min("timestamp").alias("start_time"),
        F.max("timestamp").alias("end_time"),
        F.count(F.lit(1)).alias("total_queries"),
        F.sum("click_count").alias("total_clicks"),
    )
    attributes = users.select("user_id", "device_type", "browser", "user_segment")
    return (
        spans.join(attributes, "user_id", "left")
        .withColumn("session_duration", seconds_between(F.col("start_time"), F.col("end_time")))
        .select(*schemas.SEARCH_SESSIONS.fieldNames())
    )


def search_queries(
    facts: DataFrame, max_gap_seconds: float | None = None, min_similarity: float | None = None
) -> DataFrame:
    """Queries with ``reformulation_of``, the previous query of the session."""
    linked = with_previous_query(
        facts, max_gap_seconds=max_gap_seconds, min_similarity=min_similarity
    )
    return linked.select(*schemas.SEARCH_QUERIES.fieldNames())


def search_results(results: DataFrame) -> DataFrame:
    return results.select(*schemas.SEARCH_RESULTS.fieldNames())


DAY_KEYS = ("date", "session_id", "user_id")


def daily_state(facts: DataFrame) -> DataFrame:
    """Per date, session and user: sums and counts that add up, from which the daily table is made.

    States of different batches of queries are put together by ``merged_states``: a new day, or
    queries of a known day that come late, need no second look at earlier queries.
    """
    return facts.groupBy(F.to_date("timestamp").alias("date"), "session_id", "user_id").agg(
        F.count(F.lit(1)).alias("queries"),
        F.count_if("has_click").alias("clicked"),
        F.sum("click_count").alias("clicks"),
        F.sum("time_to_first_click").alias("wait"),
        F.count("time_to_first_click").alias("waits"),
        F.sum("max_click_position").alias("depth"),
        F.count("max_click_position").alias("depths"),
        F.sum("ndcg_10").alias("ndcg"),
        F.count("ndcg_10").alias("ndcgs"),
    )


def _summed(df: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in measures])


def merged_states(*states: DataFrame) -> DataFrame:
    """One state of all; each query may be in one of them only."""
    union = states[0]
    for state in states[1:]:
        union = union.unionByName(state)
    return _summed(union, DAY_KEYS, [c for c in union.columns if c not in DAY_KEYS])


def daily_rows(state: DataFrame, users: DataFrame) -> DataFrame:
    """The daily table of a state. Users join folded rows, and a session is one row per group before it is counted."""
    measures = [c for c in state.columns if c not in DAY_KEYS]
    attributes = users.select("user_id", "user_segment", "device_type")
    rows = state.join(attributes, "user_id", "left")
    keys = ["date", "user_segment", "device_type"]
    for key in keys:
        rows = rows.where(F.col(key).isNotNull())
    sessions = _summed(rows, [*keys, "session_id"], measures)
    totals = sessions.groupBy(*keys).agg(
        F.count("session_id").alias("total_sessions"), *[F.sum(c).alias(c) for c in measures]
    )
    ctr = F.col("clicked") / F.col("queries")
    return totals.select(
        *keys,
        "total_sessions",
        F.col("queries").alias("total_queries"),
        F.col("clicks").alias("total_clicks"),
        ctr.alias("avg_ctr"),
        F.try_divide("wait", "waits").alias("avg_time_to_first_click"),
        F.try_divide("queries", "total_sessions").alias("avg_queries_per_session"),
        (1 - ctr).alias("zero_click_rate"),
        F.try_divide("depth", "depths").alias("click_depth"),
        F.try_divide("ndcg", "ndcgs").alias("avg_ndcg"),
    )


def daily_metrics(facts: DataFrame, users: DataFrame) -> DataFrame:
    """Per date, user segment and device: totals, means over queries and mean NDCG@10."""
    return daily_rows(daily_state(facts), users)


def build(
    queries: DataFrame, results: DataFrame, users: DataFrame, ab_tests: DataFrame | None = None
) -> Star:
    facts = query_facts(queries, results)
    return Star(
        search_sessions(facts, users),
        search_queries(facts),
        search_results(results),
        daily_metrics(facts, users),
        ab_tests,
    )


def _with_month(df: DataFrame, key: str, months: DataFrame, column: str) -> DataFrame:
    """``df`` with the ``_month`` of the query (``_asked``) that ``key`` names as ``column``.

    Rows that name none stay out of the join, where all of them would be in one task.
    """
    named = df.where(F.col(key).isNotNull()).join(months, F.col(key) == F.col("_asked"), "left")
    none = df.where(F.col(key).isNull()).select("*", F.lit(None).cast("string").alias(column))
    return named.select(*df.columns, F.col("_month").alias(column)).union(none)


def save_by_month(
    df: DataFrame, path: str, id_column: str, time_column: str = "timestamp", linked: Sequence[str] = ()
) -> DataFrame:
    """Write a table in folders by the month of ``time_column`` and read it back.

    Reports add a month condition for such tables, so only the folders of the
    wanted range are listed and read. Spark spreads the rows by folder and
    splits what is large, so a month with a large share of the rows is written by many tasks; unlike
    ranges, that needs no sample, for which all rows would be computed twice. Without adaptive execution
    rows are spread by (month, id) ranges. Rows without a time, as results without a click, have a folder of their own. ``linked`` names columns of ``df``
    that hold months of related rows; they become folders too.
    """
    dated = df.withColumn(MONTH, F.date_format(time_column, "yyyy-MM"))
    folders = [MONTH, *linked]
    adaptive = df.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true"
    spread = dated.hint("rebalance", *folders) if adaptive else dated.repartitionByRange(*folders, id_column)
    spread.write.partitionBy(*folders).option("compression", "zstd").parquet(path)
    kept = StructType([f for f in df.schema if f.name not in linked])
    return _by_month(df.sparkSession, path, kept, linked)


def _by_month(spark: SparkSession, path: str, schema: StructType, linked: Sequence[str]) -> DataFrame:
    full = StructType(list(schema.fields))
    for column in (MONTH, *linked):
        full = full.add(column, StringType())
    return spark.read.schema(full).parquet(path)
