"""Follow-up queries within a session and the variety of query texts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicklake.functions.numeric import seconds_between
from clicklake.functions.scan import SLICE_ROWS, scan


def text_similarity(left: Column, right: Column) -> Column:
    """1 minus edit distance over the longer length; 1 for two empty texts."""
    longest = F.greatest(F.length(left), F.length(right))
    return F.when(longest > 0, 1 - F.levenshtein(left, right) / longest).otherwise(F.lit(1.0))


def with_previous_query(
    queries: DataFrame,
    query_id: str = "query_id",
    text: str = "query_text",
    max_gap_seconds: float | None = None,
    min_similarity: float | None = None,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Add ``reformulation_of``: the previous query of the session, by time then id.

    With limits, the previous query counts only if it is at most
    ``max_gap_seconds`` older and at least ``min_similarity`` alike. A query without a
    session follows no other; follow_up_rate counts it among all queries.
    """
    looked_at = [query_id]
    if max_gap_seconds is not None:
        looked_at.append("timestamp")
    if min_similarity is not None:
        looked_at.append(text)
    unnamed = queries.where(F.col("session_id").isNull())
    before = scan(
        queries.where(F.col("session_id").isNotNull()),
        ["session_id"],
        ["timestamp", query_id],
        previous={"_before": F.struct(*looked_at)},
        slice_rows=slice_rows,
    )
    related = F.col("_before").isNotNull()
    if max_gap_seconds is not None:
        gap = seconds_between(F.col("_before")["timestamp"], F.col("timestamp"))
        related = related & (gap <= max_gap_seconds)
    if min_similarity is not None:
        related = related & (
            text_similarity(F.col("_before")[text], F.col(text)) >= min_similarity
        )
    linked = before.select(
        *queries.columns, F.when(related, F.col("_before")[query_id]).alias("reformulation_of")
    )
    none = F.lit(None).cast(queries.schema[query_id].dataType)
    return linked.union(unnamed.select(*queries.columns, none.alias("reformulation_of")))


def follow_up_rate(
    queries: DataFrame,
    query_id: str = "query_id",
    text: str = "query_text",
    max_gap_seconds: float = 600,
    min_similarity: float = 0.7,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Share of queries that are followed by a related query of the same session."""
    linked = with_previous_query(
        queries, query_id, text, max_gap_seconds, min_similarity, slice_rows
    )
    return linked.agg(
        F.count(F.lit(1)).alias("total_queries"),
        F.count("reformulation_of").alias("refined_queries"),
        F.try_divide(F.count("reformulation_of"), F.count(F.lit(1))).alias("reformulation_rate"),
    )


def query_diversity(
    queries: DataFrame, text: str = "query_text", by: Sequence[str] = ()
) -> DataFrame:
    """Distinct texts over queries, and the share of queries whose text recurs."""
    counts = queries.where(F.col(text).isNotNull()).groupBy(*by, text).agg(
        F.count(F.lit(1)).alias("_n")
    )
    measures = [
        F.sum("_n").alias("total_queries"),
        F.count(F.lit(1)).alias("unique_queries"),
        F.try_divide(F.count(F.lit(1)), F.sum("_n")).alias("diversity"),
        F.try_divide(F.sum(F.when(F.col("_n") > 1, F.col("_n")).otherwise(0)), F.sum("_n")).alias(
            "repeated_share"
        ),
    ]
    return counts.groupBy(*by).agg(*measures) if by else counts.agg(*measures)
