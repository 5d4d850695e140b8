"""Comparison of two experiment arms.

Spark does all work that grows with the data: one pass for moments and one value
histogram per metric and segment with running counts along the values, for rank
sums, medians, normal scores and resampling. What remains for each (metric, segment) is
one row of sums, finished in Python with the tail functions.

The samples are never gathered. The running counts use the hot-key-safe scan,
since one metric without segments is a single group holding every row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from fractions import Fraction
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicklake.functions.normal_scores import shapiro_p, with_score_sums
from clicklake.functions.scan import SLICE_ROWS, scan
from clicklake.functions.tails import (
    NORMAL,
    f_tail_one,
    normal_tail,
    t_quantile,
    t_two_sided,
)

# Replicates that a task works on at a time, and the group totals it holds before it hands them on.
REPLICATES, HELD = 1024, 64
# Fixed values of the mixing of 32-bit numbers.
_M1, _M2, _STEP = 0x7FEB352D, 0x846CA68B, 0x9E3779B9
NOT_ENOUGH = "Insufficient data for statistical analysis"
# Exact rank-sum tails: no ties, and a sample of at most 8 beside one of any size.
EXACT_SAMPLE = 8


def samples(
    df: DataFrame,
    metrics: Sequence[str],
    variant: str = "variant",
    control: str = "control",
    experiment: str = "experiment",
    segment: str | None = None,
) -> DataFrame:
    """Long form: metric, [segment], is_control, value; nulls and other arms dropped."""
    keep = [variant] + ([segment] if segment else [])
    wide = df.where(F.col(variant).isin(control, experiment))
    if segment:
        wide = wide.where(F.col(segment).isNotNull())
    wide = wide.select(*keep, *[F.col(m).cast("double").alias(m) for m in metrics])
    long = wide.unpivot(keep, list(metrics), "metric", "value")
    return long.where(F.col("value").isNotNull()).select(
        "metric",
        *([F.col(segment).alias("segment")] if segment else []),
        (F.col(variant) == control).alias("is_control"),
        "value",
    )


def moments(long: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Size, mean and sample variance of both arms, one row per key."""
    arm = {"c": F.col("is_control"), "e": ~F.col("is_control")}
    return long.groupBy(*keys).agg(
        *[F.count_if(flag).alias(f"n_{a}") for a, flag in arm.items()],
        *[F.avg(F.when(flag, F.col("value"))).alias(f"mean_{a}") for a, flag in arm.items()],
        *[F.var_samp(F.when(flag, F.col("value"))).alias(f"var_{a}") for a, flag in arm.items()],
    )


def ranked_values(long: DataFrame, keys: Sequence[str], slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Distinct values per key with the counts of both arms and their running totals."""
    counts = long.groupBy(*keys, "value").agg(
        F.count_if("is_control").alias("c"), F.count_if(~F.col("is_control")).alias("e")
    )
    # An estimate combines on the map side, and only says how many slices to cut.
    loads = long.groupBy(*keys).agg(F.approx_count_distinct("value").alias("_rows"))
    return scan(
        counts, list(keys), ["value"],
        sums={"upto_c": F.col("c"), "upto_e": F.col("e")}, slice_rows=slice_rows, loads=loads,
    )


def rank_sums(
    long: DataFrame, keys: Sequence[str], with_scores: bool = True, slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """One row per key: moments, U, tie sum, medians, absolute deviations, normal scores.

    ``u_control`` counts the pairs in which the control value is larger, ties
    half. ``abs_dev_*`` is the mean distance from the arm's median: the upper half
    of the sorted values minus the lower half needs no second pass.
    """
    stats = moments(long, keys)
    joined = ranked_values(long, keys, slice_rows).join(stats, list(keys))
    if with_scores:
        runs = {a: (F.col(f"upto_{a}") - F.col(a), F.col(f"upto_{a}"), F.col(f"n_{a}")) for a in "ce"}
        joined = with_score_sums(joined, {f"_score_{a}": run for a, run in runs.items()})
    both = (F.col("c") + F.col("e")).cast("double")
    wins = F.col("c") * (F.col("upto_e") - F.col("e") / 2)
    measures = [
        *[F.max(f"{m}_{a}").alias(f"{m}_{a}") for a in "ce" for m in ("n", "mean", "var")],
        F.sum(wins.cast("double")).alias("u_control"),
        F.sum(both * both * both - both).alias("tie_sum"),
    ]
    for a in "ce":
        count, upto, n = F.col(a), F.col(f"upto_{a}"), F.col(f"n_{a}")
        before, off = upto - count, F.col("value") - F.col(f"mean_{a}")
        half = F.floor(n / 2)
        low = F.greatest(F.lit(0), F.least(upto, half) - before)
        high = F.greatest(F.lit(0), upto - F.greatest(before, n - half))

        def at_rank(rank: Column, upto: Column = upto) -> Column:
            return F.min(F.when(upto >= rank, F.col("value")))

        measures += [
            at_rank(F.floor((n + 1) / 2)).alias(f"_mid_low_{a}"),
            at_rank(half + 1).alias(f"_mid_high_{a}"),
            F.sum(off * (high - low)).alias(f"_dev_{a}"),
            at_rank(F.lit(1)).alias(f"first_{a}"),
            at_rank(F.lit(2)).alias(f"second_{a}"),
            at_rank(n - 1).alias(f"before_last_{a}"),
            at_rank(n).alias(f"last_{a}"),
        ]
        if with_scores:
            measures.append(F.sum(off * F.col(f"_score_{a}")).alias(f"scores_{a}"))
    summed = joined.groupBy(*keys).agg(*measures)
    for a in "ce":
        summed = summed.withColumn(
            f"median_{a}", (F.col(f"_mid_low_{a}") + F.col(f"_mid_high_{a}")) / 2
        ).withColumn(f"abs_dev_{a}", F.try_divide(f"_dev_{a}", f"n_{a}"))
    return summed.drop(*[f"_{m}_{a}" for a in "ce" for m in ("mid_low", "mid_high", "dev")])


def arm_statistics(long: DataFrame, keys: Sequence[str], slice_rows: int = SLICE_ROWS) -> DataFrame:
    """The exact statistics behind the tests: Student, Welch, Levene and U (no tails)."""
    s = rank_sums(long, keys, with_scores=False, slice_rows=slice_rows)
    n_c, n_e = F.col("n_c"), F.col("n_e")
    gap = F.col("mean_c") - F.col("mean_e")
    err_c, err_e = F.col("var_c") / n_c, F.col("var_e") / n_e
    pooled = F.try_divide((n_c - 1) * F.col("var_c") + (n_e - 1) * F.col("var_e"), n_c + n_e - 2)
    spread = {
        a: (F.col(f"n_{a}") - 1) * F.col(f"var_{a}")
        + F.col(f"n_{a}") * (F.col(f"mean_{a}") - F.col(f"median_{a}")) ** 2
        - F.col(f"n_{a}") * F.col(f"abs_dev_{a}") ** 2
        for a in "ce"
    }
    between = (
        n_c * n_e / (n_c + n_e) * (F.col("abs_dev_c") - F.col("abs_dev_e")) ** 2
    )
    return s.select(
        *keys,
        n_c.alias("control_sample_size"),
        n_e.alias("experiment_sample_size"),
        F.col("mean_c").alias("control_mean"),
        F.col("mean_e").alias("experiment_mean"),
        F.col("var_c").alias("control_variance"),
        F.col("var_e").alias("experiment_variance"),
        F.col("median_c").alias("control_median"),
        F.col("median_e").alias("experiment_median"),
        F.try_divide(gap, F.sqrt(pooled * (1 / n_c + 1 / n_e))).alias("student_t"),
        F.try_divide(gap, F.sqrt(err_c + err_e)).alias("welch_t"),
        F.try_divide(
            (err_c + err_e) ** 2, err_c**2 / (n_c - 1) + err_e**2 / (n_e - 1)
        ).alias("welch_df"),
        F.try_divide((n_c + n_e - 2) * between, spread["c"] + spread["e"]).alias("levene_w"),
        F.col("u_control").alias("u_statistic"),
        F.col("tie_sum").alias("tie_sum"),
    )


def _levene_p(row) -> float:
    total = row.n_c + row.n_e
    within = sum(
        (n - 1) * var + n * (mean - median) ** 2 - n * dev * dev
        for n, var, mean, median, dev in (
            (row.n_c, row.var_c, row.mean_c, row.median_c, row.abs_dev_c),
            (row.n_e, row.var_e, row.mean_e, row.median_e, row.abs_dev_e),
        )
    )
    between = row.n_c * row.n_e / total * (row.abs_dev_c - row.abs_dev_e) ** 2
    if within <= 0:
        return math.nan if between == 0 else 0.0
    return f_tail_one((total - 2) * between / within, total - 2)


def _t_test(row, equal_variance: bool) -> float:
    err_c, err_e = row.var_c / row.n_c, row.var_e / row.n_e
    if equal_variance:
        df = row.n_c + row.n_e - 2
        pooled = ((row.n_c - 1) * row.var_c + (row.n_e - 1) * row.var_e) / df
        error = math.sqrt(pooled * (1 / row.n_c + 1 / row.n_e))
    else:
        error = math.sqrt(err_c + err_e)
        below = err_c**2 / (row.n_c - 1) + err_e**2 / (row.n_e - 1)
        df = (err_c + err_e) ** 2 / below if below else math.nan
    gap = row.mean_c - row.mean_e
    if error == 0:
        return math.nan if gap == 0 else 0.0
    return t_two_sided(gap / error, df)


@cache
def _partitions(parts: int) -> list[int]:
    """How many ways 0, 1, 2, ... or less are a sum of parts of 1 .. ``parts``, for parts + 1 periods.

    Along steps of the least common multiple of the parts these are polynomials of degree ``parts``.
    """
    ways = [1] * (math.lcm(*range(1, parts + 1)) * (parts + 1))
    for part in range(1, parts + 1):
        for at in range(part, len(ways)):
            ways[at] += ways[at - part]
    return ways


def _ways_upto(total: int, parts: int) -> int:
    """``_partitions`` at any total, by Newton's forward differences."""
    if total < 0:
        return 0
    table = _partitions(parts)
    period = len(table) // (parts + 1)
    steps, rest = divmod(total, period)
    known = table[rest::period]
    found = 0
    for order in range(parts + 1):
        found += math.comb(steps, order) * known[0]
        known = [b - a for a, b in zip(known, known[1:])]
    return found


def exact_rank_tail(u: int, small: int, large: int) -> Fraction:
    """P(U >= u) without ties, exact, in time that does not depend on ``large``.

    The arrangements with U <= t are the partitions of t or less into at most ``small``
    parts of at most ``large``. Their generating function is that of parts 1 .. small times
    (1 - q^(large + i)) for each i, which makes 2^small terms of ``_ways_upto``.
    """
    below = small * large - u  # by symmetry
    found = 0
    for chosen in range(1 << small):
        members = [i + 1 for i in range(small) if chosen >> i & 1]
        found += (-1) ** len(members) * _ways_upto(below - sum(large + i for i in members), small)
    return Fraction(found, math.comb(small + large, small))


def rank_sum_p(u: float, n1: int, n2: int, tie_sum: float) -> float:
    """Two-sided p-value of the Mann-Whitney test."""
    larger = max(u, n1 * n2 - u)
    if min(n1, n2) <= EXACT_SAMPLE and tie_sum == 0:
        return min(1.0, float(2 * exact_rank_tail(int(larger), *sorted((int(n1), int(n2))))))
    total = n1 + n2
    spread = n1 * n2 / 12.0 * ((total + 1) - tie_sum / (total * (total - 1.0)))
    if spread <= 0:
        return math.nan
    z = (larger - n1 * n2 / 2.0 - 0.5) / math.sqrt(spread)
    return min(1.0, 2.0 * normal_tail(z))


def _choose_and_test(row) -> tuple[str, float]:
    normal = all(
        shapiro_p(
            getattr(row, f"n_{a}"), (getattr(row, f"n_{a}") - 1) * getattr(row, f"var_{a}"),
            getattr(row, f"scores_{a}"), getattr(row, f"first_{a}"), getattr(row, f"second_{a}"),
            getattr(row, f"before_last_{a}"), getattr(row, f"last_{a}"),
        ) >= 0.05
        for a in "ce"
    )
    if not normal:
        return "Mann-Whitney U test", rank_sum_p(row.u_control, row.n_c, row.n_e, row.tie_sum)
    if _levene_p(row) >= 0.05:
        return "Student's t-test", _t_test(row, True)
    return "Welch's t-test", _t_test(row, False)


def _finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        tests = [
            _choose_and_test(row) if min(row.n_c, row.n_e) >= 2 else (None, math.nan)
            for row in batch.itertuples(index=False)
        ]
        batch["test_type"] = [name for name, _ in tests]
        batch["p_value"] = [p for _, p in tests]
        yield batch


def _mixed(x: np.ndarray) -> np.ndarray:
    """A scattering of 32-bit numbers, the same in every engine with whole numbers."""
    x = (x ^ (x >> np.uint32(16))) * np.uint32(_M1)
    x = (x ^ (x >> np.uint32(15))) * np.uint32(_M2)
    return x ^ (x >> np.uint32(16))


@cache
def _poisson(bit: int) -> np.ndarray:
    """Quantiles of the Poisson law of mean 2^bit, at the middles of 2^16 equal parts."""
    mean = 2.0**bit
    first = max(0, math.floor(mean - 8 * math.sqrt(mean)))
    at = np.arange(first, math.ceil(mean + 8 * math.sqrt(mean)) + 9, dtype=np.float64)
    logs = np.concatenate([[0.0], np.cumsum(np.log(mean / at[1:]))])
    law = np.exp(logs - logs.max())
    upto = np.cumsum(law) / law.sum()
    return first + np.searchsorted(upto, (np.arange(1 << 16) + 0.5) / (1 << 16), side="left").astype(np.float64)


def _weighted(values: np.ndarray, upto: np.ndarray, count: np.ndarray, arm: int, draws: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Weighted sums and weights of all replicates, over distinct values of one arm.

    A value that occurs c times has a weight from the Poisson law of mean c, as the sum
    of one draw for each binary digit of c.
    """
    sums, weights = np.zeros(draws), np.zeros(draws)
    for bit in range(int(count.max()).bit_length()):
        mine = np.flatnonzero((count >> bit) & 1)
        table = _poisson(bit)
        for start in range(0, len(mine), 256):
            at = mine[start : start + 256]
            place = upto[at].astype(np.uint64)
            high = ((place >> np.uint64(32)) * np.uint64(128) + np.uint64(2 * bit + arm + 7919 * seed)).astype(np.uint32)
            name = _mixed(_mixed(high) ^ place.astype(np.uint32))
            for first in range(0, draws, REPLICATES):
                step = np.arange(first, min(draws, first + REPLICATES), dtype=np.uint32) * np.uint32(_STEP)
                drawn = table[_mixed(name[:, None] + step[None, :]) >> np.uint32(16)]
                sums[first : first + REPLICATES] += values[at] @ drawn
                weights[first : first + REPLICATES] += drawn.sum(axis=0)
    return sums, weights


def _resampled(draws: int, seed: int, keys: list[str]):
    names = [*keys, "is_control", "replicate", "total", "weight"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple, tuple[np.ndarray, np.ndarray]] = {}

        def handed_on() -> pd.DataFrame:
            parts = [
                pd.DataFrame(dict(zip(names, [*key, np.arange(draws), *sums], strict=True)))
                for key, sums in held.items()
            ]
            held.clear()
            return pd.concat(parts, ignore_index=True)

        for batch in batches:
            for key, part in batch.groupby([*keys, "is_control"], sort=False, dropna=False):
                label = tuple(part[k].iloc[0] for k in [*keys, "is_control"])
                found = _weighted(
                    part["value"].to_numpy(float), part["upto"].to_numpy(np.int64), part["count"].to_numpy(np.int64),
                    int(label[-1]), draws, seed,
                )
                before = held.get(label)
                held[label] = found if before is None else (before[0] + found[0], before[1] + found[1])
                if len(held) >= HELD:
                    yield handed_on()
        if held:
            yield handed_on()

    return run


def bootstrap_intervals(
    long: DataFrame,
    keys: Sequence[str],
    alpha: float = 0.05,
    draws: int = 10_000,
    seed: int = 0,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Bootstrap percentile interval of the mean difference per key.

    A Poisson bootstrap: in each replicate every observation has a weight of mean 1, drawn by a
    hash of its rank, so samples stay where they are and tasks hand on one sum
    and weight per replicate, arm and key. Equal values draw together; weights follow
    the Poisson law to 16 bits. Replicates in which an arm has no weight are left out.
    """
    ranked = ranked_values(long, keys, slice_rows)
    arms = F.explode(
        F.array(
            F.struct(F.lit(True).alias("is_control"), F.col("c").alias("count"), F.col("upto_c").alias("upto")),
            F.struct(F.lit(False).alias("is_control"), F.col("e").alias("count"), F.col("upto_e").alias("upto")),
        )
    ).alias("arm")
    each = ranked.select(*keys, "value", arms).select(*keys, "value", "arm.*").where("count > 0")
    spark = long.sparkSession
    # The rows are few and small, the work on each is not: as many tasks as there are cores at least.
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    schema = ", ".join(f"`{k}` {long.schema[k].dataType.simpleString()}" for k in keys)
    spread = each.repartition(tasks, *keys, "value")
    partial = spread.mapInPandas(
        _resampled(draws, seed, list(keys)),
        f"{schema}, is_control boolean, replicate int, total double, weight double",
    )
    control = F.col("is_control")
    means = partial.groupBy(*keys, "replicate").agg(
        *[
            F.try_divide(F.sum(F.when(arm, F.col("total"))), F.sum(F.when(arm, F.col("weight")))).alias(name)
            for name, arm in (("mean_c", control), ("mean_e", ~control))
        ]
    )
    gap = F.col("mean_e") - F.col("mean_c")
    bounds = F.percentile(gap, F.array(F.lit(alpha / 2), F.lit(1 - alpha / 2)))
    return means.groupBy(*keys).agg(bounds.alias("_b")).select(
        *keys, F.col("_b")[0].alias("ci_lower"), F.col("_b")[1].alias("ci_upper")
    )


def compare_arms(
    long: DataFrame,
    keys: Sequence[str] = ("metric",),
    alpha: float = 0.05,
    draws: int = 10_000,
    seed: int = 0,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Full two-arm comparison, one row per key.

    The test is Student's or Welch's when both arms look normal (Shapiro-Wilk, on
    all values), else Mann-Whitney. An arm with fewer than 2 values gives an
    ``error`` and no test. ``draws=0`` leaves the interval out.
    """
    sums = rank_sums(long, keys, slice_rows=slice_rows)
    schema = T.StructType(
        [
            *sums.schema.fields,
            T.StructField("test_type", T.StringType()),
            T.StructField("p_value", T.DoubleType()),
        ]
    )
    tested = sums.mapInPandas(_finish, schema)
    gap = F.col("mean_e") - F.col("mean_c")
    enough = F.least("n_c", "n_e") >= 2
    p = F.when(F.isnan("p_value"), None).otherwise(F.col("p_value"))
    out = tested.select(
        *keys,
        F.col("mean_c").alias("control_mean"),
        F.col("mean_e").alias("experiment_mean"),
        gap.alias("absolute_difference"),
        (F.try_divide(gap, "mean_c") * 100).alias("relative_difference_percent"),
        F.col("n_c").alias("control_sample_size"),
        F.col("n_e").alias("experiment_sample_size"),
        p.alias("p_value"),
        F.coalesce(p < alpha, F.lit(False)).alias("significant"),
        "test_type",
        F.when(~enough, NOT_ENOUGH).alias("error"),
    )
    if not draws:
        return out.withColumns(
            {c: F.lit(None).cast("double") for c in ("ci_lower", "ci_upper")}
        )
    intervals = bootstrap_intervals(long, keys, alpha, draws, seed, slice_rows)
    kept = [c for c in out.columns if c not in keys]
    return out.join(intervals, list(keys), "left").select(
        *keys,
        *kept,
        *[
            F.when(F.col("error").isNull() & ~F.isnan(c), F.col(c)).alias(c)
            for c in ("ci_lower", "ci_upper")
        ],
    )


def analyze_experiment(
    df: DataFrame,
    metrics: Sequence[str],
    variant: str = "variant",
    control: str = "control",
    experiment: str = "experiment",
    **options,
) -> DataFrame:
    """Comparison of two arms for several metric columns, nulls dropped per metric."""
    return compare_arms(samples(df, metrics, variant, control, experiment), ["metric"], **options)


def segment_impact(
    df: DataFrame,
    segment: str,
    metric: str,
    variant: str = "variant",
    control: str = "control",
    experiment: str = "experiment",
    min_arm: int = 10,
    **options,
) -> DataFrame:
    """Comparison per segment; segments with an arm below ``min_arm`` values are left out.

    ``segment_size`` counts all rows of the segment, also nulls and other variants.
    """
    sizes = df.groupBy(F.col(segment).alias("segment")).agg(
        F.count(F.lit(1)).alias("segment_size")
    )
    share = F.col("segment_size") / sizes.agg(F.sum("segment_size")).scalar() * 100
    sizes = sizes.select("segment", "segment_size", share.alias("segment_size_percent"))
    long = samples(df, [metric], variant, control, experiment, segment)
    # Small segments leave before the tests and the bootstrap.
    keys = ["metric", "segment"]
    large = moments(long, keys).where(F.least("n_c", "n_e") >= min_arm).select(*keys)
    tested = compare_arms(long.join(large, keys, "left_semi"), keys, **options)
    label = F.concat(
        F.lit(f"{metric} for {segment}="), F.col("segment").cast("string")
    )
    return tested.join(sizes, "segment").withColumn("metric", label)


def stored_results(
    comparison: DataFrame, test_id: str, test_name: str, start_date: str, end_date: str
) -> DataFrame:
    """Comparison rows as stored results: one row per metric and variant."""
    sides = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(arm).alias("variant"),
                    F.col(f"{arm}_mean").alias("value"),
                    F.col(f"{arm}_sample_size").alias("sample_size"),
                )
                for arm in ("control", "experiment")
            ]
        )
    )
    return comparison.select("metric", sides.alias("_side"), "p_value", "significant").select(
        F.lit(test_id).alias("test_id"),
        F.lit(test_name).alias("test_name"),
        F.lit(start_date).cast("date").alias("start_date"),
        F.lit(end_date).cast("date").alias("end_date"),
        "metric",
        "_side.variant",
        "_side.value",
        "_side.sample_size",
        "p_value",
        "significant",
    )


def _t_half_width(confidence: float):
    @F.pandas_udf(T.DoubleType())
    def quantile(df: pd.Series) -> pd.Series:
        known = {d: t_quantile((1 + confidence) / 2, d) for d in df.unique() if d >= 1}
        return df.map(known)

    return quantile


def confidence_intervals(
    df: DataFrame, value: str, by: Sequence[str] = (), confidence: float = 0.95
) -> DataFrame:
    """Mean and t interval of ``value`` per key; bounds null below two values.

    A key whose values are all null keeps its row. Only the aggregated rows meet
    Python, for the t quantile.
    """
    measures = [
        F.avg(value).alias("mean"),
        F.count(value).alias("sample_size"),
        (F.stddev_samp(value) / F.sqrt(F.count(value))).alias("std_error"),
    ]
    rows = df
    for key in by:
        rows = rows.where(F.col(key).isNotNull())
    stats = rows.groupBy(*by).agg(*measures) if by else rows.agg(*measures)
    margin = F.col("std_error") * _t_half_width(confidence)(
        (F.col("sample_size") - 1).cast("double")
    )
    known = F.col("sample_size") >= 2
    return stats.withColumn("_margin", margin).select(
        *by,
        "mean",
        F.when(known, F.col("mean") - F.col("_margin")).alias("lower"),
        F.when(known, F.col("mean") + F.col("_margin")).alias("upper"),
        "std_error",
        "sample_size",
    )


def timeseries_intervals(
    df: DataFrame, metric: str, date: str = "date", confidence: float = 0.95
) -> DataFrame:
    """Mean, t interval and sample size of a metric for each date."""
    return confidence_intervals(df, metric, [date], confidence).select(
        date,
        F.col("mean").alias(f"{metric}_mean"),
        F.col("lower").alias(f"{metric}_lower"),
        F.col("upper").alias(f"{metric}_upper"),
        F.col("sample_size").alias(f"{metric}_sample_size"),
    )


def _z_sum(power: float, significance: float, two_sided: bool) -> float:
    tail = significance / 2 if two_sided else significance
    return NORMAL.inv_cdf(1 - tail) + NORMAL.inv_cdf(power)


def required_sample_size(
    rate: Column, effect: float | Column, power: float = 0.8, significance: float = 0.05,
    two_sided: bool = True,
) -> Column:
    """Sample size per arm to detect an absolute change of ``effect`` in a rate.

    0 at a rate of 0 or 1, which does not vary; null for an effect of 0.
    """
    change = effect if isinstance(effect, Column) else F.lit(float(effect))
    variance = rate * (1 - rate)
    scaled = F.try_divide(change, F.sqrt(variance))
    size = F.ceil(F.try_divide(F.lit(_z_sum(power, significance, two_sided)), scaled) ** 2)
    return F.when(variance <= 0, F.lit(0).cast("long")).otherwise(size)


def days_to_fill(
    sample_size: Column, daily_traffic: Column, allocation: float = 0.5
) -> Column:
    """Days until both arms are full."""
    return F.try_divide(sample_size * 2, daily_traffic * F.lit(float(allocation)))


def minimum_detectable_effect(
    rate: Column, sample_size: Column, power: float = 0.8, significance: float = 0.05,
    two_sided: bool = True,
) -> Column:
    """Smallest absolute change of a rate that a sample of this size can detect; null for size 0."""
    error = F.sqrt(rate * (1 - rate) * F.try_divide(F.lit(2.0), sample_size))
    return F.lit(_z_sum(power, significance, two_sided)) * error
