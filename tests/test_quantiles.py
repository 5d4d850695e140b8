from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from clicklake.functions.quantiles import MARGIN, exact_percentile

SMALL = int(2 / MARGIN)


@pytest.fixture(scope="module")
def groups(spark):
    rng = np.random.default_rng(8)
    values = {
        "one": np.array([4.25]),
        "two": np.array([1.0, 2.0]),
        "even": rng.normal(size=SMALL),
        "odd": rng.exponential(size=SMALL + 1),
        "large": rng.lognormal(size=30_001),
        "ties": rng.integers(0, 3, size=20_000).astype(float),
        "constant": np.full(5000, 7.5),
    }
    rows = [(k, float(v)) for k, vs in values.items() for v in vs] + [("one", None), ("none", None)]
    return values, spark.createDataFrame(rows, "g string, x double").repartition(5)


@pytest.mark.parametrize("fraction", [0.0, 0.05, 0.5, 0.95, 0.999, 1.0])
def test_equals_the_sorted_answer(groups, fraction):
    values, df = groups
    found = {
        r.g: r.p for r in exact_percentile(df, ["g"], F.col("x"), fraction, "p").collect()
    }
    assert set(found) == set(values)
    for key, numbers in values.items():
        assert found[key] == pytest.approx(np.quantile(numbers, fraction), rel=1e-12), key


def test_one_group_of_all_rows_in_slices(spark):
    rng = np.random.default_rng(2)
    values = rng.lognormal(size=20_000)
    df = spark.createDataFrame([("a", float(v)) for v in values], "g string, x double").repartition(6)
    for fraction in (0.5, 0.9):
        found = exact_percentile(df, ["g"], F.col("x"), fraction, "p", slice_rows=20).collect()
        assert [r.p for r in found] == [pytest.approx(np.quantile(values, fraction), rel=1e-12)]


@pytest.mark.parametrize("accuracy", [1, 3])
def test_a_rank_outside_its_bracket_is_found_in_a_wider_one(groups, accuracy):
    values, df = groups
    found = exact_percentile(df, ["g"], F.col("x"), 0.7, "p", accuracy=accuracy, margin=0.004)
    assert {r.g: r.p for r in found.collect()} == {k: pytest.approx(np.quantile(v, 0.7), rel=1e-12) for k, v in values.items()}
