from __future__ import annotations

import datetime as dt

import numpy as np
import pytest

from clicklake.operators import profile, series
from clicklake.operators.profile import explode_results, flatten_nested
from clicklake.schemas import NESTED_LOG
from tests.logs_by_hand import at


def daily(spark, values):
    day = dt.date(2024, 1, 1)
    return spark.createDataFrame(
        [(day + dt.timedelta(days=n), v) for n, v in enumerate(values)], "date date, ctr double"
    )


SPIKE = [0.3, 0.31, 0.3, 0.29, 0.3, 0.31, 0.3, 0.29, 0.3, 0.31, 0.3, 0.29, 5.0]


def flags(spark, **options):
    rows = series.detect_anomalies(daily(spark, SPIKE), "ctr", **options).orderBy("date").collect()
    return [r.ctr_is_anomaly for r in rows]


def test_seven_rows_never_reach_three_deviations(spark):
    assert not any(flags(spark))
    assert flags(spark, window=12) == [False] * 12 + [True]
    assert flags(spark, threshold=2.2) == [False] * 12 + [True]
    assert flags(spark, include_current=False)[-1]


def test_first_rows_have_no_rolling_figures(spark):
    rows = series.detect_anomalies(daily(spark, [1.0, 2.0, 3.0, None, 3.0]), "ctr").orderBy("date").collect()
    assert [r.ctr_rolling_mean for r in rows] == [None, None, 2.0, 2.0, 2.25]
    assert rows[2].ctr_rolling_std == 1.0 and rows[2].ctr_zscore == 1.0
    assert rows[3].ctr_zscore is None and rows[3].ctr_is_anomaly is False


def test_flat_series_has_no_flag(spark):
    rows = series.detect_anomalies(daily(spark, [2.0] * 6), "ctr").collect()
    assert not any(r.ctr_is_anomaly for r in rows)


def test_anomalous_row_numbers(spark):
    flagged = series.detect_anomalies(daily(spark, SPIKE), "ctr", window=12)
    assert [r.row_index for r in series.anomalous_rows(flagged, "ctr").collect()] == [12]


def test_trend(spark):
    rng = np.random.default_rng(0)
    values = 0.3 + 0.002 * np.arange(40) + rng.normal(0, 0.01, 40)
    row = series.linear_trend(daily(spark, values.tolist()), "ctr").first()
    slope, intercept = np.polyfit(np.arange(40), values, 1)
    assert row.slope == pytest.approx(slope) and row.intercept == pytest.approx(intercept)
    assert row.direction == "Upward" and row.p_value < 1e-6
    assert row.strength == pytest.approx(np.corrcoef(np.arange(40), values)[0, 1] ** 2)
    line = series.trend_line(daily(spark, values.tolist()), "ctr").orderBy("date").collect()
    assert line[-1].fitted == pytest.approx(intercept + slope * 39)
    assert series.linear_trend(daily(spark, [1.0, 2.0]), "ctr").first().p_value is None


def test_date_gaps_are_filled(spark):
    filled = series.fill_dates(daily(spark, [0.5]), "2023-12-31", "2024-01-02", ctr=0.0)
    assert [r.ctr for r in filled.orderBy("date").collect()] == [0.0, 0.5, 0.0]


def test_nested_log(spark):
    rows = [
        ("s", 1, 1, "a", at(0), [10, 11, 12], [11], [at(4)], "mobile", "x"),
        ("s", 1, 2, "b", at(9), [20], None, None, "mobile", "x"),
        ("t", 2, 3, "c", at(0), None, [], [], "desktop", "y"),
    ]
    nested = spark.createDataFrame(rows, NESTED_LOG)
    flat = {r.query_id: r for r in flatten_nested(nested).collect()}
    assert [(flat[n].result_count, flat[n].click_count) for n in (1, 2, 3)] == [(3, 1), (1, 0), (0, 0)]
    shown = explode_results(nested).orderBy("query_id", "position").collect()
    assert [(r.result_id, r.clicked, r.click_time) for r in shown] == [
        ("1-1", False, None), ("1-2", True, at(4)), ("1-3", False, None), ("2-1", False, None),
    ]
    profiles = {r.session_id: r for r in profile.session_profiles(flatten_nested(nested)).collect()}
    assert profiles["s"].num_queries == 2 and profiles["s"].clicks_per_query == 0.5
    assert profiles["s"].success is False  # 9 seconds only
    assert profiles["t"].duration == 0


def test_success_needs_a_click_and_ten_seconds(spark):
    queries = spark.createDataFrame(
        [("s", 1, 1, at(0), 1, "m"), ("s", 1, 2, at(10.5), 0, "m"), ("t", 1, 3, at(0), 0, "m"), ("t", 1, 4, at(99), 0, "m")],
        "session_id string, user_id long, query_id long, timestamp timestamp_ntz, click_count long, device_type string",
    )
    profiles = profile.session_profiles(queries)
    assert {r.session_id: r.success for r in profiles.collect()} == {"s": True, "t": False}
    assert profile.session_success_rate(profiles).first().success_rate == 0.5


def test_histogram_counts_every_row(spark):
    rng = np.random.default_rng(1)
    values = np.concatenate([rng.integers(0, 30, 500).astype(float), [30.0]])
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    rows = profile.histogram(df, "v", 10).orderBy("bin").collect()
    counts, edges = np.histogram(values, 10)
    assert [r["count"] for r in rows] == counts.tolist()
    assert [r.bin_start for r in rows] == pytest.approx(edges[:-1])
    flat = profile.histogram(df.limit(0).union(spark.createDataFrame([(2.0,)], "v double")), "v", 4)
    assert sum(r["count"] for r in flat.collect()) == 1
