"""Session profiles from query rows: success, top texts and value histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicklake.functions.numeric import mean_of_flag, seconds_between


def flatten_nested(nested: DataFrame) -> DataFrame:
    """Nested log (arrays per query) to query rows with counts; a null array counts 0."""

    def length(column: str) -> Column:
        return F.when(F.col(column).isNull(), 0).otherwise(F.size(column)).cast("long")

    arrays = ["results", "clicked_results", "click_timestamps"]
    return nested.select(
        *[c for c in nested.columns if c not in arrays],
        length("results").alias("result_count"),
        length("clicked_results").alias("click_count"),
    )


def explode_results(nested: DataFrame) -> DataFrame:
    """Nested log to one row per shown result, with the click time if it was clicked."""
    at = F.array_position("clicked_results", F.col("document_id")).cast("int")
    clicked = F.coalesce(at > 0, F.lit(False))
    return (
        nested.select(
            "session_id", "user_id", "query_id", "query_text", "timestamp",
            "clicked_results", "click_timestamps",
            F.posexplode("results").alias("_at", "document_id"),
        )
        .select(
            F.concat_ws("-", F.col("query_id").cast("string"), (F.col("_at") + 1).cast("string")).alias(
                "result_id"
            ),
            "query_id",
            "session_id",
            (F.col("_at") + 1).alias("position"),
            "document_id",
            clicked.alias("clicked"),
            F.when(clicked, F.get("click_timestamps", at - 1)).alias("click_time"),
        )
    )


def session_profiles(queries: DataFrame) -> DataFrame:
    """One row per session from query rows with ``click_count``.

    A session succeeds with at least one click and more than 10 seconds.
    """
    first = F.struct("timestamp", "query_id")
    hits, seconds = F.col("num_clicks"), F.col("duration")
    return (
        queries.where(F.col("session_id").isNotNull())
        .groupBy("session_id")
        .agg(
            F.count("query_id").alias("num_queries"),
            F.sum("click_count").alias("num_clicks"),
            F.min_by("user_id", first).alias("user_id"),
            F.min_by("device_type", first).alias("device_type"),
            F.min("timestamp").alias("start_time"),
            F.max("timestamp").alias("end_time"),
        )
        .withColumn("duration", seconds_between(F.col("start_time"), F.col("end_time")))
        .withColumn("clicks_per_query", F.try_divide(hits, "num_queries"))
        .withColumn("success", (hits > 0) & (seconds > 10))
    )


def session_success_rate(profiles: DataFrame, by: str | None = None) -> DataFrame:
    measures = [
        F.count(F.lit(1)).alias("session_count"),
        mean_of_flag(F.col("success")).alias("success_rate"),
    ]
    return profiles.groupBy(by).agg(*measures) if by else profiles.agg(*measures)


def top_texts(queries: DataFrame, limit: int = 15, text: str = "query_text") -> DataFrame:
    """Most frequent query texts, ties by text."""
    return (
        queries.where(F.col(text).isNotNull())
        .groupBy(text)
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.col("count").desc(), text)
        .limit(limit)
    )


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Rows per equal-width bin between the least and largest value, empty bins included.

    The last bin includes its upper bound. A constant column spans value +- 0.5.
    """
    value = F.col(column).cast("double")
    span = df.agg(
        F.struct(F.min(value).alias("low"), F.max(value).alias("high"))
    ).scalar()
    low, high = F.col("_span")["low"], F.col("_span")["high"]
    flat = low == high
    start = F.when(flat, low - 0.5).otherwise(low)
    width = F.when(flat, F.lit(1.0)).otherwise(high - low) / bins
    slot = F.least(F.floor((F.col("_v") - start) / width), F.lit(bins - 1)).cast("int")
    counts = (
        df.where(F.col(column).isNotNull())
        .select(value.alias("_v"), span.alias("_span"))
        .groupBy(slot.alias("bin"))
        .agg(F.count(F.lit(1)).alias("count"))
    )
    ladder = (
        df.sparkSession.range(bins)
        .select(F.col("id").cast("int").alias("bin"), span.alias("_span"))
        .select(
            "bin",
            (start + width * F.col("bin")).alias("bin_start"),
            (start + width * (F.col("bin") + 1)).alias("bin_end"),
        )
    )
    return ladder.join(counts, "bin", "left").select(
        "bin", "bin_start", "bin_end", F.coalesce("count", F.lit(0).cast("long")).alias("count")
    )
