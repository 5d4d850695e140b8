"""Hot keys must not change the result of an ordered scan."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from clicklake.functions.scan import large_keys, scan, sliced_keys
from clicklake.operators.shaping import sessionize
from tests.logs_by_hand import at


@pytest.fixture(scope="module")
def skewed(spark):
    """One key with two thirds of the rows, bursts and equal times, the rest spread out."""
    rng = random.Random(3)
    rows = []
    for n in range(6000):
        key = "hot" if n % 3 else f"k{rng.randrange(300)}"
        when = int(rng.choice([rng.uniform(0, 50), rng.uniform(0, 1e6)]))
        rows.append((key, when, n, rng.randrange(5), rng.choice([None, rng.randrange(9)])))
    return spark.createDataFrame(rows, "key string, at long, id long, amount int, mark int").repartition(7)


def _plain(df):
    along = Window.partitionBy("key").orderBy("at", "id")
    so_far = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.select(
        "key", "at", "id", "amount", "mark",
        F.sum("amount").over(so_far).alias("total"),
        F.lag("mark").over(along).alias("before"),
        F.last("mark", ignorenulls=True).over(so_far).alias("latest"),
    )


def _scanned(df, slice_rows):
    return scan(
        df, ["key"], ["at", "id"],
        sums={"total": F.col("amount")}, previous={"before": F.col("mark")},
        carried={"latest": F.col("mark")}, slice_rows=slice_rows,
    )


@pytest.mark.parametrize("slice_rows", [10, 100, 10**9])
def test_scan_equals_plain_window(skewed, slice_rows):
    expected = sorted(map(tuple, _plain(skewed).collect()), key=lambda r: r[2])
    found = _scanned(skewed, slice_rows)
    assert found.columns == ["key", "at", "id", "amount", "mark", "total", "before", "latest"]
    assert sorted(map(tuple, found.collect()), key=lambda r: r[2]) == expected


def _slices(df, slice_rows):
    return {r._slice: r["count"] for r in sliced_keys(df, ["key"], ["at", "id"], slice_rows).where("_large").groupBy("_slice").count().collect()}


def test_only_large_keys_are_sliced_and_evenly(skewed):
    sliced = sliced_keys(skewed, ["key"], ["at", "id"], 100)
    assert {r.key for r in sliced.where("_large").select("key").distinct().collect()} == {"hot"}
    assert sliced.where("not _large and _slice <> 0").count() == 0
    assert sliced.count() == 6000
    assert len(_slices(skewed, 100)) == 40 and max(_slices(skewed, 100).values()) < 250


def test_slices_grow_with_the_rows_of_a_key_also_at_one_position(spark):
    for rows in (2000, 4000):
        same = spark.range(rows).selectExpr("'a' as key", "5L as at", "id")
        found = _slices(same, 100)
        assert len(found) == rows / 100 and max(found.values()) < 250


def test_carries_cross_groups_of_slices(skewed, monkeypatch):
    from clicklake.functions import scan as module

    monkeypatch.setattr(module, "GROUP", 4)
    expected = sorted(map(tuple, _plain(skewed).collect()), key=lambda r: r[2])
    assert sorted(map(tuple, _scanned(skewed, 100).collect()), key=lambda r: r[2]) == expected


def test_without_large_keys_the_plan_is_one_window(skewed):
    plan = _scanned(skewed, 10**9)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and plan.count("hashpartitioning") == 1


def test_column_of_the_same_name_is_replaced(skewed):
    again = scan(skewed, ["key"], ["at", "id"], sums={"amount": F.col("amount")})
    assert again.columns.count("amount") == 1


@pytest.mark.parametrize("slice_rows", [5, 10**9])
def test_sessionize_splits_on_long_pauses(spark, slice_rows):
    rng = random.Random(5)
    times = [at(rng.uniform(0, 4e5)) for _ in range(400)]
    log = spark.createDataFrame(
        [(n % 2, t, n) for n, t in enumerate(times)],
        "user_id long, timestamp timestamp_ntz, event_id long",
    )
    expected = {}
    for user in (0, 1):
        mine = sorted((t, n) for n, t in enumerate(times) if n % 2 == user)
        number = 0
        for place, (t, n) in enumerate(mine):
            if place and (t - mine[place - 1][0]).total_seconds() > 1800:
                number += 1
            expected[n] = number
    found = sessionize(log, 1800, slice_rows=slice_rows)
    assert {r.event_id: r.session_number for r in found.collect()} == expected


def test_keys_are_counted_only_where_a_bucket_is_above_the_limit(spark):
    rows = spark.range(5000).selectExpr("case when id < 300 then 'hot' when id < 400 then null else cast(id as string) end as key", "id")
    assert large_keys(rows, ["key"], 400) is None
    assert {tuple(r) for r in large_keys(rows, ["key"], 99).collect()} == {("hot", 300), (None, 100)}
    counted = rows.groupBy("key").count().where("count > 1")
    assert {tuple(r) for r in large_keys(rows, ["key"], 1).collect()} == {tuple(r) for r in counted.collect()}
