"""Anomaly flags and linear trend on daily series.

Input is a metric table with one row per date (and group), so its size is the
number of dates, not of log rows; the ordered windows here rely on that.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicklake.functions.tails import t_two_sided


def detect_anomalies(
    df: DataFrame,
    metric: str,
    date: str = "date",
    window: int = 7,
    threshold: float = 3.0,
    by: Sequence[str] = (),
    tie_break: Sequence[str] = (),
    include_current: bool = True,
    min_rows: int = 3,
) -> DataFrame:
    """Add rolling mean, deviation, z-score and flag over the last ``window`` rows.

    The frame includes the row itself, so with the sample deviation |z| is at most
    (n-1)/sqrt(n): a window of 7 can never pass 3. ``include_current=False``
    compares with the rows before instead.
    """
    along = Window.partitionBy(*by).orderBy(date, *tie_break)
    frame = along.rowsBetween(-(window - 1), 0) if include_current else along.rowsBetween(-window, -1)
    known = F.count(metric).over(frame) >= min_rows
    mean, std = f"{metric}_rolling_mean", f"{metric}_rolling_std"
    z, flag = f"{metric}_zscore", f"{metric}_is_anomaly"
    return (
        df.withColumns(
            {
                mean: F.when(known, F.avg(metric).over(frame)),
                std: F.when(known, F.stddev_samp(metric).over(frame)),
            }
        )
        .withColumn(z, F.try_divide(F.col(metric) - F.col(mean), F.col(std)))
        .withColumn(flag, F.coalesce(F.abs(F.col(z)) > threshold, F.lit(False)))
    )


def anomalous_rows(flagged: DataFrame, metric: str, date: str = "date") -> DataFrame:
    """0-based row numbers (by date) of the flagged rows."""
    numbered = flagged.withColumn("row_index", F.row_number().over(Window.orderBy(date)) - 1)
    return numbered.where(F.col(f"{metric}_is_anomaly")).select("row_index", date, metric)


def _indexed(df: DataFrame, date: str, metric: str, tie_break: Sequence[str]) -> DataFrame:
    along = Window.partitionBy().orderBy(date, *tie_break)
    return df.withColumn("row_index", F.row_number().over(along) - 1)


def linear_trend(
    df: DataFrame, metric: str, date: str = "date", tie_break: Sequence[str] = ()
) -> DataFrame:
    """One row: slope and intercept on the row index, r2, direction and p-value."""
    y, x = F.col(metric), F.col("row_index").cast("double")
    fit = _indexed(df, date, metric, tie_break).agg(
        F.count(y).alias("n"),
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("strength"),
    )
    fit = fit.withColumn(
        "direction",
        F.when(F.col("slope") > 0, "Upward").when(F.col("slope").isNotNull(), "Downward"),
    )
    schema = T.StructType([*fit.schema.fields, T.StructField("p_value", T.DoubleType())])
    return fit.mapInPandas(_slope_test, schema)


def _slope_test(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        batch["p_value"] = [
            _slope_p(n, r2) for n, r2 in zip(batch["n"], batch["strength"], strict=True)
        ]
        yield batch


def _slope_p(n: int, r2: float | None) -> float | None:
    if r2 is None or n < 3 or math.isnan(r2):
        return None
    if r2 >= 1.0:
        return 0.0
    return t_two_sided(math.sqrt(r2 * (n - 2) / (1 - r2)), n - 2)


def trend_line(
    df: DataFrame, metric: str, date: str = "date", tie_break: Sequence[str] = ()
) -> DataFrame:
    """Rows with their index and the fitted value of the linear trend."""
    everything = Window.partitionBy()
    y, x = F.col(metric), F.col("row_index").cast("double")
    slope = F.regr_slope(y, x).over(everything)
    intercept = F.regr_intercept(y, x).over(everything)
    return _indexed(df, date, metric, tie_break).withColumn("fitted", intercept + slope * x)


def fill_dates(df: DataFrame, start: str, end: str, date: str = "date", **defaults) -> DataFrame:
    """Every date from start to end, with ``defaults`` where the table has no row."""
    spark = df.sparkSession
    days = spark.range(1).select(
        F.explode(
            F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))
        ).alias(date)
    )
    return days.join(df, date, "left").fillna(defaults)
