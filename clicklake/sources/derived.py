"""Search logs derived from the supplied relational tables.

``events`` becomes an event log (views, sign-ups and errors are searches, clicks
and purchases are clicks on the latest search of the session), ``orders`` and
``lineitem`` become a log of shown results. All ordered steps go through the
hot-key-safe scan, so a user or an order that holds a large share of the rows
does not end up in one task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clicklake.functions.scan import scan
from clicklake.sources.stages import Stages


def stored(
    spark: SparkSession, folder: str, name: str, build: Callable[[], DataFrame]
) -> DataFrame:
    """The frame as a table in the shared folder, written once while the files of ``folder`` stay as they are.

    Reports then read a stored log, as they would in service.
    """
    return Stages(spark, [folder]).get(name, build)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _phrased(selector: Column, subject: Column) -> Column:
    """Query text: the subject in one of five phrasings."""
    return (
        F.when(selector == 0, subject)
        .when(selector == 1, F.concat(F.lit("how to "), subject))
        .when(selector == 2, F.concat(subject, F.lit(" best practices guide")))
        .when(selector == 3, F.concat(F.lit("what is the best "), subject, F.lit(" for beginner")))
        .otherwise(F.concat(F.lit("tutorial on choosing the right "), subject, F.lit(" online free")))
    )


def _choice(selector: Column, *labels: str) -> Column:
    *head, last = labels
    picked = F.when(selector == 0, head[0])
    for at, label in enumerate(head[1:], start=1):
        picked = picked.when(selector == at, label)
    return picked.otherwise(F.lit(last))


def device_of(user: Column) -> Column:
    return _choice(user % 3, "desktop", "mobile", "tablet")


def variant_of(user: Column) -> Column:
    return F.when(user % 8 < 4, "control").otherwise(F.lit("experiment"))


def event_log(spark: SparkSession, folder: str) -> DataFrame:
    """Searches and clicks; a session is one user in one ISO week."""
    raw = table(spark, folder, "events").select(
        "event_id",
        F.col("ts").alias("timestamp"),
        "user_id",
        "value",
        F.get_json_object("props", "$.k").cast("int").alias("_k"),
        F.col("event_type").isin("view", "signup", "error").alias("_search"),
        F.concat_ws(
            "-", F.col("user_id").cast("string"), F.trunc(F.to_date("ts"), "week").cast("string")
        ).alias("session_id"),
    )
    numbered = scan(
        raw,
        ["session_id"],
        ["timestamp", "event_id"],
        sums={"_searches": F.col("_search").cast("int")},
        carried={"_topic": F.when(F.col("_search"), F.col("_k"))},
    ).where(F.col("_searches") > 0)
    parts = table(spark, folder, "part").select("p_partkey", "p_name")
    topic, user, k = F.col("_topic"), F.col("user_id"), F.col("_k")
    is_search, is_click = F.col("_search"), ~F.col("_search")
    query = _phrased(topic % 5, F.col("p_name"))
    return (
        numbered.join(parts, F.col("p_partkey") == topic)
        .withColumn("query", query)
        .select(
            "event_id",
            "session_id",
            "user_id",
            "timestamp",
            F.when(is_search, "search").otherwise(F.lit("click")).alias("event_type"),
            "query",
            F.when(is_search, F.length("query")).alias("query_length"),
            F.when(is_search, word_count(F.col("query"))).alias("query_words"),
            (F.col("_searches") - 1).cast("int").alias("query_index_in_session"),
            _choice(user % 4, "new_user", "regular_user", "power_user", "enterprise_user").alias(
                "user_segment"
            ),
            device_of(user).alias("device_type"),
            F.when(is_search, k % 46 + 5).alias("results_returned"),
            F.when(is_search, F.col("value") * 2).alias("search_latency_ms"),
            F.when(is_click, k % 10 + 1).alias("click_position"),
            F.when(
                is_click, _choice(k % 6, "web", "video", "image", "pdf", "stackoverflow", "github")
            ).alias("result_type"),
            F.when(is_click, F.col("value")).alias("time_on_result_seconds"),
            F.when(is_click, F.col("value") > 30).alias("is_satisfied"),
            variant_of(user).alias("variant"),
        )
    )


def word_count(text: Column) -> Column:
    """Spaces plus one."""
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit(""))) + 1


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")


def _named(spark: SparkSession, folder: str, rows: DataFrame) -> DataFrame:
    """Rows with the columns of ``_orders``: these give way to the id, session, user, text and time of the query.

    Texts and sessions are long, so rows are shuffled before they get them. Remainders of 100 match few
    parts, which travel to the rows.
    """
    parts = table(spark, folder, "part").select("p_partkey", "p_name").where(F.col("p_partkey").between(-99, 99))
    order = ("o_orderkey", "o_custkey", "o_orderdate")
    return rows.join(F.broadcast(parts), F.col("p_partkey") == F.col("o_orderkey") % 100).select(
        F.col("o_orderkey").alias("query_id"),
        F.concat_ws("-", F.col("o_custkey").cast("string"), F.year("o_orderdate").cast("string")).alias(
            "session_id"
        ),
        F.col("o_custkey").alias("user_id"),
        _phrased(F.col("o_orderkey") % 5, F.col("p_name")).alias("query_text"),
        F.col("o_orderdate").alias("timestamp"),
        *[c for c in rows.columns if c not in order],
    )


def query_log(spark: SparkSession, folder: str) -> DataFrame:
    """One row per query (order), also those without any shown result."""
    return _named(spark, folder, _orders(spark, folder))


def result_log(spark: SparkSession, folder: str) -> DataFrame:
    """One row per shown result (line item), positions counted within the order."""
    items = table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_extendedprice",
        "l_quantity",
        (F.col("l_returnflag") == "R").alias("clicked"),
    )
    placed = scan(
        items,
        ["l_orderkey"],
        ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"],
        sums={"_place": F.lit(1)},
    )
    clicked, late = F.col("clicked"), (F.col("l_partkey") % 600).cast("int")
    shown_at = F.timestamp_add("SECOND", late, F.col("query_time"))
    shown = _orders(spark, folder).join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
    return _named(spark, folder, shown).withColumnRenamed("timestamp", "query_time").select(
        F.concat_ws("-", F.col("query_id").cast("string"), F.col("_place").cast("string")).alias(
            "result_id"
        ),
        "query_id",
        "session_id",
        "user_id",
        "query_text",
        "query_time",
        shown_at.alias("timestamp"),
        F.col("_place").cast("int").alias("position"),
        F.col("l_partkey").alias("document_id"),
        "clicked",
        F.when(clicked, shown_at).alias("click_time"),
        F.when(clicked, F.col("l_quantity") * 2).alias("dwell_time"),
        F.when(clicked, (F.col("l_partkey") % 600).cast("double") / 50).alias("time_to_click"),
        variant_of(F.col("user_id")).alias("variant"),
    )


def nested_log(spark: SparkSession, folder: str) -> DataFrame:
    """One row per query with the arrays of its shown and its clicked results, null where nothing was shown."""
    shown = F.struct("position", "document_id", "clicked", "click_time")
    lists = result_log(spark, folder).groupBy("query_id").agg(F.array_sort(F.collect_list(shown)).alias("_shown"))
    clicked = F.filter("_shown", lambda r: r["clicked"])
    lists = lists.withColumnRenamed("query_id", "_query")
    users = user_log(spark, folder).select(F.col("user_id").alias("_user"), "device_type", "location")
    # Users join before the lists do, so that lists are not shuffled by user.
    asked = _orders(spark, folder).join(users, F.col("o_custkey") == F.col("_user"), "left").drop("_user")
    rows = asked.join(lists, F.col("o_orderkey") == F.col("_query"), "left").drop("_query")
    return _named(spark, folder, rows).select(
        "session_id", "user_id", "query_id", "query_text", "timestamp",
        F.transform("_shown", lambda r: r["document_id"]).alias("results"),
        F.transform(clicked, lambda r: r["document_id"]).alias("clicked_results"),
        F.transform(clicked, lambda r: r["click_time"]).alias("click_timestamps"),
        "device_type", "location",
    )


def user_log(spark: SparkSession, folder: str) -> DataFrame:
    """Attributes of users (customers)."""
    customers = table(spark, folder, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    nations = table(spark, folder, "nation").select("n_nationkey", "n_name")
    user = F.col("c_custkey")
    return customers.join(nations, F.col("n_nationkey") == F.col("c_nationkey"), "left").select(
        user.alias("user_id"),
        F.col("c_mktsegment").alias("user_segment"),
        device_of(user).alias("device_type"),
        _choice(user % 4, "chrome", "firefox", "safari", "edge").alias("browser"),
        F.col("n_name").alias("location"),
    )
