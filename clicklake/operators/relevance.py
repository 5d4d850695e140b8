"""Relevance metrics from a log of shown results (one row per result and query).

Every function takes ``by``: optional columns (an experiment arm, a device) that
are constant within a query and a session, to get one result per value.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clicklake.functions.numeric import capped, mean_of_flag, merge_measures


def _totals(df: DataFrame, by: Sequence[str], *measures: Column) -> DataFrame:
    return df.groupBy(*by).agg(*measures) if by else df.agg(*measures)


def dwell_gain(column: str = "dwell_time") -> Column:
    """Gain of a click: seconds on the result over 60, at most 1; unknown counts 0."""
    return F.least(F.coalesce(F.col(column), F.lit(0.0)) / 60.0, F.lit(1.0))


def _found(gain: Column, k: int) -> Column:
    hit = F.col("clicked") & (F.col("position") <= k)
    return F.when(hit, gain / F.log2(F.col("position") + 1)).otherwise(F.lit(0.0))


def unit_dcg(k: int) -> Column:
    """Aggregate over the results of a query: DCG at k when every click gains 1."""
    return F.sum(_found(F.lit(1.0), k))


def unit_ideal(clicks: Column, k: int) -> Column:
    """Ideal DCG at k of a query with that many clicks, each gaining 1."""
    ladder = [sum(1.0 / math.log2(i + 2) for i in range(n)) for n in range(k + 1)]
    return F.element_at(
        F.array(*[F.lit(v) for v in ladder]), F.least(clicks, F.lit(k)).cast("int") + 1
    )


def share_of_ideal(dcg: Column, ideal: Column) -> Column:
    return F.when(ideal > 0, dcg / ideal).otherwise(F.lit(0.0))


def ndcg(
    results: DataFrame,
    ks: Sequence[int] = (10,),
    gain: Column | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """NDCG at each k per query, over its clicked results; 0 without clicks.

    The ideal order sorts the *clicked* gains, so several clicks on one position
    can give more than 1. With unit gain the ideal depends on the number of
    clicks only. With a ``gain`` column, only the ``max(ks)`` largest gains of a
    query matter; that limit is applied before the shuffle.
    """
    known = results.where(F.col("query_id").isNotNull())
    if gain is not None:
        return _graded(known, ks, gain, by)
    per_query = known.groupBy(*by, "query_id").agg(
        F.count_if("clicked").alias("click_count"),
        *[unit_dcg(k).alias(f"_dcg_{k}") for k in ks],
    )
    clicks = F.col("click_count")
    return per_query.select(
        *by,
        "query_id",
        "click_count",
        *[share_of_ideal(F.col(f"_dcg_{k}"), unit_ideal(clicks, k)).alias(f"ndcg_{k}") for k in ks],
    )


def _graded(
    results: DataFrame,
    ks: Sequence[int],
    gain: Column,
    by: Sequence[str],
    extra: Mapping[str, Column] | None = None,
) -> DataFrame:
    """NDCG with a gain column per query, plus ``extra`` aggregates over its results.

    The largest gains join the results as additional rows whose other columns are
    null, so one grouping by query yields everything.
    """
    key, extra = [*by, "query_id"], dict(extra or {})
    best_first = Window.partitionBy(*key).orderBy(F.col("_gain").desc())
    largest = (
        results.where("clicked")
        .select(*key, gain.alias("_gain"))
        .withColumn("_nth", F.row_number().over(best_first))
        .where(F.col("_nth") <= max(ks))
    )
    shown = results.select(
        *key, "position", "timestamp", "clicked", gain.alias("_gain"), F.lit(None).cast("int").alias("_nth")
    )
    rows = shown.unionByName(largest, allowMissingColumns=True)

    def ideal(k: int) -> Column:
        share = F.col("_gain") / F.log2(F.col("_nth") + 1)
        return F.sum(F.when(F.col("_nth") <= k, share))

    per_query = rows.groupBy(*key).agg(
        F.count_if("clicked").alias("click_count"),
        *[F.sum(_found(F.col("_gain"), k)).alias(f"_dcg_{k}") for k in ks],
        *[F.coalesce(ideal(k), F.lit(0.0)).alias(f"_ideal_{k}") for k in ks],
        *[column.alias(name) for name, column in extra.items()],
    )
    return per_query.select(
        *key,
        "click_count",
        *[share_of_ideal(F.col(f"_dcg_{k}"), F.col(f"_ideal_{k}")).alias(f"ndcg_{k}") for k in ks],
        *extra,
    )


def _first_position() -> Column:
    """Aggregate: position of the earliest click, null without clicks."""
    return F.min_by("position", F.when(F.col("clicked"), F.struct("timestamp", "position")))


def _first_positions(results: DataFrame, by: Sequence[str]) -> DataFrame:
    return (
        results.where(F.col("query_id").isNotNull())
        .groupBy(*by, "query_id")
        .agg(_first_position().alias("first_position"), F.count_if("clicked").alias("click_count"))
        .withColumn("any_click", F.col("click_count") > 0)
    )


def _reciprocal(position: Column) -> Column:
    return F.when(position > 0, 1.0 / position).otherwise(F.lit(0.0))


def mean_reciprocal_rank(
    results: DataFrame, by: Sequence[str] = (), count_no_click: bool = True
) -> DataFrame:
    """Mean of 1/position of the first click; queries without clicks count 0 or not at all."""
    firsts = _first_positions(results, by)
    if not count_no_click:
        firsts = firsts.where(F.col("any_click"))
    mean = F.avg(_reciprocal(F.col("first_position")))
    return _totals(firsts, by, F.coalesce(mean, F.lit(0.0)).alias("mrr"))


def query_success_rate(results: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Share of queries with any click."""
    return _totals(
        _first_positions(results, by),
        by,
        mean_of_flag(F.col("any_click")).alias("successful_query_rate"),
    )


def reformulation_metrics(
    results: DataFrame, by: Sequence[str] = (), order_by: str = "query_id"
) -> DataFrame:
    """Queries per session, reformulation, abandonment and zero-click reformulation.

    The last rate looks at all queries of a session but the last; ``order_by``
    says which one is last: the largest id (default) or the latest ``timestamp``.
    """
    if order_by not in ("query_id", "timestamp"):
        raise ValueError(f"order_by must be 'query_id' or 'timestamp', not {order_by!r}")
    per_query = (
        results.where(F.col("session_id").isNotNull())
        .groupBy(*by, "session_id", "query_id")
        .agg(
            F.coalesce(F.bool_or("clicked"), F.lit(False)).alias("_hit"),
            F.min("timestamp").alias("timestamp"),
        )
    )
    # A plain id keeps the aggregation hash based; a struct would need a sort.
    place = F.col("query_id") if order_by == "query_id" else F.struct("timestamp", "query_id")
    known = F.col("query_id").isNotNull()
    per_session = per_query.groupBy(*by, "session_id").agg(
        F.count("query_id").alias("_queries"),
        F.bool_or("_hit").alias("_any"),
        F.count_if(known & ~F.col("_hit")).alias("_missed"),
        F.max_by((~F.col("_hit")).cast("int"), F.when(known, place)).alias("_last_missed"),
    )
    queries = F.col("_queries")
    return _totals(
        per_session,
        by,
        F.avg(queries).alias("avg_queries_per_session"),
        mean_of_flag(queries > 1).alias("reformulation_rate"),
        mean_of_flag(~F.col("_any")).alias("abandonment_rate"),
        F.avg(
            F.when(
                queries > 1, (F.col("_missed") - F.col("_last_missed")) / (queries - 1)
            ).otherwise(F.lit(0.0))
        ).alias("zero_click_reformulation_rate"),
    )


def satisfaction_score(results: DataFrame) -> DataFrame:
    """Per query a 0-100 score from clicks, dwell time, depth and time to click."""
    clicked = F.col("clicked")
    per_query = (
        results.where(F.col("query_id").isNotNull())
        .groupBy("query_id")
        .agg(
            F.count_if(clicked).alias("click_count"),
            F.count_if(clicked & (F.col("position") <= 3)).alias("clicks_in_top_3"),
            F.avg(F.when(clicked, F.col("dwell_time"))).alias("_dwell"),
            F.max(F.when(clicked, F.col("position"))).alias("_depth"),
            F.min(F.when(clicked, F.col("time_to_click"))).alias("time_to_first_click"),
        )
    )
    has_click = F.col("click_count") > 0
    depth, wait = F.col("click_depth"), F.col("time_to_first_click")
    # Base 50 or 20, and the caps of each bonus and penalty.
    base = F.when(has_click, F.lit(50.0)).otherwise(F.lit(20.0))
    top_bonus = F.least(F.lit(25.0), F.col("clicks_in_top_3") * F.lit(10.0))
    dwell_bonus = F.least(F.lit(20.0), F.coalesce("avg_dwell_time", F.lit(0.0)) / 2)
    depth_cost = capped((depth - 3) * F.lit(2.0), 0, 10)
    wait_cost = F.when(wait.isNull(), F.lit(5.0)).otherwise(capped((wait - 2) * 2, 0, 10))
    return per_query.select(
        "query_id",
        "click_count",
        "clicks_in_top_3",
        F.when(has_click, F.col("_dwell")).otherwise(F.lit(0.0)).alias("avg_dwell_time"),
        F.when(has_click, F.col("_depth")).otherwise(F.lit(0)).alias("click_depth"),
        "time_to_first_click",
    ).withColumn(
        "satisfaction_score",
        capped(base + top_bonus + dwell_bonus - depth_cost - wait_cost, 0, 100),
    )


def ranking_quality(results: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row: MRR, NDCG@10 (dwell gain, clicked queries), success, position, first-rank CTR.

    All of it is summed per query first. Results without a query id count in the
    position figures only.
    """
    clicked, first = F.col("clicked"), F.col("position") == 1
    per_query = _graded(
        results,
        (10,),
        dwell_gain(),
        by,
        {
            "_first_position": _first_position(),
            "_positions": F.sum(F.when(clicked, F.col("position"))),
            "_first_shown": F.count_if(first & clicked.isNotNull()),
            "_first_clicked": F.count_if(first & clicked),
        },
    )
    query, any_click = F.col("query_id").isNotNull(), F.col("click_count") > 0
    return _totals(
        per_query,
        by,
        F.coalesce(
            F.avg(F.when(query, _reciprocal(F.col("_first_position")))), F.lit(0.0)
        ).alias("mrr"),
        F.coalesce(F.avg(F.when(query & any_click, F.col("ndcg_10"))), F.lit(0.0)).alias("ndcg"),
        F.avg(F.when(query, any_click.cast("int"))).alias("successful_query_rate"),
        F.coalesce(
            F.try_divide(F.sum("_positions"), F.sum("click_count")), F.lit(0.0)
        ).alias("avg_click_position"),
        F.try_divide(F.sum("_first_clicked"), F.sum("_first_shown")).alias("first_position_ctr"),
    )


COMPARED = (
    "mrr", "ndcg", "successful_query_rate", "avg_click_position", "first_position_ctr",
    "avg_queries_per_session", "reformulation_rate", "abandonment_rate",
    "zero_click_reformulation_rate",
)


def compare_relevance(
    results: DataFrame,
    variant: str = "variant",
    baseline: str = "control",
    experiment: str = "experiment",
) -> DataFrame:
    """Nine relevance metrics of two arms side by side."""
    arms = results.where(F.col(variant).isin(baseline, experiment))
    wide = merge_measures(
        [ranking_quality(arms, [variant]), reformulation_metrics(arms, [variant])], [variant]
    )
    long = wide.unpivot([variant], list(COMPARED), "metric", "value")
    sides = long.groupBy("metric").agg(
        F.max(F.when(F.col(variant) == baseline, F.col("value"))).alias("baseline"),
        F.max(F.when(F.col(variant) == experiment, F.col("value"))).alias("experiment"),
    )
    gap = F.col("experiment") - F.col("baseline")
    return sides.select(
        "metric",
        "baseline",
        "experiment",
        gap.alias("absolute_diff"),
        F.when(F.col("baseline") == 0, F.lit(float("inf")))
        .otherwise(F.try_divide(gap, "baseline") * 100)
        .alias("relative_diff_percent"),
    )


def _clicked_places(results: DataFrame, k: int) -> DataFrame:
    """Distinct clicked positions up to k: at most k rows per query."""
    return (
        results.where(F.col("clicked") & F.col("position").between(1, k))
        .groupBy("query_id", "position")
        .agg(F.count(F.lit(1)).alias("_clicks"))
    )


def precision_at(results: DataFrame, ks: Sequence[int] = (3, 5, 10)) -> DataFrame:
    """Clicked positions in the top k over k, averaged over all queries."""
    per_query = (
        results.where(F.col("query_id").isNotNull())
        .groupBy("query_id", "position")
        .agg(F.bool_or("clicked").alias("_hit"))
        .groupBy("query_id")
        .agg(
            *[
                (F.count_if(F.col("_hit") & (F.col("position") <= k)) / k).alias(f"_p_{k}")
                for k in ks
            ]
        )
    )
    return per_query.agg(*[F.avg(f"_p_{k}").alias(f"precision_{k}") for k in ks])


def mean_average_precision(results: DataFrame, k: int = 10) -> DataFrame:
    """MAP@k over all queries; a query without clicks in the top k counts 0."""
    downward = Window.partitionBy("query_id").orderBy("position")
    hits = _clicked_places(results, k).withColumn("_nth", F.row_number().over(downward))
    averages = hits.groupBy("query_id").agg(F.avg(F.col("_nth") / F.col("position")).alias("_ap"))
    queries = results.where(F.col("query_id").isNotNull()).select("query_id").distinct()
    return queries.join(averages, "query_id", "left").agg(
        F.avg(F.coalesce("_ap", F.lit(0.0))).alias(f"map_{k}")
    )


def ndcg_distribution(results: DataFrame, k: int = 10) -> DataFrame:
    """Clicked queries per NDCG range, with their share."""
    score = F.col(f"ndcg_{k}")
    # Bounds of the ranges.
    label = (
        F.when(score < 0.2, "0.0-0.2")
        .when(score < 0.4, "0.2-0.4")
        .when(score < 0.6, "0.4-0.6")
        .when(score < 0.8, "0.6-0.8")
        .when(score < 0.9, "0.8-0.9")
        .otherwise("0.9-1.0")
    )
    counts = (
        ndcg(results, (k,), dwell_gain())
        .where(F.col("click_count") > 0)
        .groupBy(label.alias("ndcg_range"))
        .agg(F.count(F.lit(1)).alias("query_count"))
    )
    everything = Window.partitionBy()  # at most six rows
    return counts.withColumn(
        "share", F.col("query_count") / F.sum("query_count").over(everything)
    )
