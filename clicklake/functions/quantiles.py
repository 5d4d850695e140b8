"""Exact interpolated percentiles without gathering a group in one task.

``median``/``percentile`` keep a map of all distinct values of a group in one
aggregation buffer. That is fine for a bounded domain (click positions) and is
used there. For continuous values a sketch first brackets the wanted rank; then
only the values inside the bracket are counted one by one, everything below it
collapses into a single count, and everything above it is not needed. The counts are summed
along the values by the scan, which cuts a group of any size into slices. Groups whose rank
lies outside its bracket take part again with a wider one, until every rank is found.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicklake.functions.scan import SLICE_ROWS, scan
from clicklake.session import materialized

ACCURACY = 10_000
# The sketch is off by at most 1/ACCURACY in rank; the first bracket is much wider.
MARGIN = 20 / ACCURACY
WIDER = 16


def exact_percentile(
    df: DataFrame,
    keys: Sequence[str],
    value: Column,
    fraction: float,
    name: str,
    *,
    accuracy: int = ACCURACY,
    margin: float = MARGIN,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """One row per key with the linearly interpolated percentile of ``value``.

    Null values are skipped; a key without values is absent from the result. The result is
    computed here and stored, a row per key.
    """
    rows = df.select(*keys, value.cast("double").alias("_x")).where(F.col("_x").isNotNull())
    left, parts = rows, []
    while True:
        found = materialized(_bracketed(left, keys, fraction, accuracy, margin, slice_rows))
        parts.append(found.where(~F.col("_missed")).select(*keys, F.col("_answer").alias(name)))
        missed = found.where("_missed").select(*keys)
        if margin >= 1 or missed.isEmpty():
            return reduce(DataFrame.union, parts)
        left, margin = rows.join(missed, list(keys), "left_semi"), margin * WIDER


def _bracketed(
    rows: DataFrame, keys: Sequence[str], fraction: float, accuracy: int, margin: float, slice_rows: int
) -> DataFrame:
    """keys, ``_answer`` and ``_missed``: the rank is not among the values in the bracket."""
    bracket = materialized(
        rows.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("_n"),
            F.percentile_approx(
                "_x", [max(0.0, fraction - margin), min(1.0, fraction + margin)], F.lit(accuracy)
            ).alias("_b"),
        )
    )
    # A bracket of a few ranks may lack the neighbour that the interpolation needs.
    whole = F.lit(margin >= 1) | (F.col("_n") * margin <= 2)
    near = (
        rows.join(bracket, list(keys))
        .where(whole | (F.col("_x") <= F.col("_b")[1]))
        .groupBy(
            *keys, "_n", F.when(whole | (F.col("_x") >= F.col("_b")[0]), F.col("_x")).alias("_v")
        )
        .agg(F.count(F.lit(1)).alias("_c"))
    )
    share = F.when(whole, F.col("_n")).otherwise(F.col("_n") * min(1.0, 2 * margin) + 1)
    loads = bracket.select(*keys, share.alias("_rows"))
    summed = scan(near, list(keys), ["_v"], sums={"_upto": F.col("_c")}, slice_rows=slice_rows, loads=loads)
    rank = (F.col("_n") - 1) * F.lit(fraction)
    found = (
        summed.withColumn("_low", F.floor(rank) + 1)
        .withColumn("_high", F.ceil(rank) + 1)
        .groupBy(*keys)
        .agg(
            F.max(rank - F.floor(rank)).alias("_part"),
            F.min(F.when(F.col("_upto") >= F.col("_low"), F.col("_v"))).alias("_a"),
            F.min(F.when(F.col("_upto") >= F.col("_high"), F.col("_v"))).alias("_z"),
            F.bool_or(F.col("_v").isNull() & (F.col("_upto") >= F.col("_low"))).alias("_below"),
        )
    )
    return found.select(
        *keys,
        (F.col("_a") + (F.col("_z") - F.col("_a")) * F.col("_part")).alias("_answer"),
        (F.col("_below") | F.col("_z").isNull()).alias("_missed"),
    )
