from __future__ import annotations

import itertools
import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from clicklake.functions import normal_scores, tails
from clicklake.operators import experiments as ex


def arms(spark, control, experiment, partitions=3, metric="m"):
    rows = [("control", None if v is None else float(v)) for v in control]
    rows += [("experiment", None if v is None else float(v)) for v in experiment]
    return spark.createDataFrame(rows, f"variant string, {metric} double").repartition(partitions)


def brute_shapiro(sample):
    x = np.sort(np.asarray(sample, float))
    n = len(x)
    m = np.array([tails.NORMAL.inv_cdf((i - 0.375) / (n + 0.25)) for i in range(1, n + 1)])
    centred = x - x.mean()
    at = [x[0], x[min(1, n - 1)], x[max(n - 2, 0)], x[-1]]
    return normal_scores.shapiro_p(n, float(centred @ centred), float(m @ centred), *at)


def test_t_law():
    assert tails.t_quantile(0.975, 1) == pytest.approx(12.706204736432095, rel=1e-10)
    assert tails.t_quantile(0.975, 10) == pytest.approx(2.228138851964939, rel=1e-10)
    assert tails.t_quantile(0.025, 30) == pytest.approx(-2.0422724563012373, rel=1e-10)
    assert tails.t_two_sided(2.0, 10) == pytest.approx(0.07338803477074037, rel=1e-10)
    assert tails.t_quantile(0.975, 1e12) == pytest.approx(1.959963984540054, rel=1e-9)
    for df in (3.7, 99.0, 9999.0, 10001.0, 5e5, 2e6):  # both sides of the series limits
        assert tails.t_two_sided(tails.t_quantile(0.99, df), df) == pytest.approx(0.02, rel=1e-7)


def test_shapiro_published_values():
    skewed = [0.11, 7.87, 4.61, 10.14, 7.95, 3.14, 0.46, 4.43, 0.21, 4.75,
              0.71, 1.52, 3.24, 0.93, 0.42, 4.97, 9.53, 4.55, 0.47, 6.66]
    plain = [1.36, 1.14, 2.92, 2.55, 1.46, 1.06, 5.27, -1.11, 3.48, 1.10,
             0.88, -0.51, 1.46, 0.52, 6.20, 1.69, 0.08, 3.67, 2.81, 3.49]
    assert brute_shapiro(skewed) == pytest.approx(0.042089745402336121, rel=1e-4)
    assert brute_shapiro(plain) == pytest.approx(0.52459925413131714, rel=1e-4)
    assert normal_scores.shapiro_p(2, 1.0, 1.0, 0, 1, 0, 1) == 0.0
    assert normal_scores.shapiro_p(9, 0.0, 0.0, 1, 1, 1, 1) == 1.0
    assert 0 < brute_shapiro([1.0, 2.0, 4.0]) < 1
    assert 0 < brute_shapiro([1.0, 2.0, 4.0, 4.5]) < 1


def test_normal_quantile_column(spark):
    ps = [1e-300, 1e-30, 1e-12, 1e-6, 0.01, 0.0749, 0.0751, 0.3, 0.5, 0.6, 0.925, 0.9251, 0.999, 1 - 1e-9]
    rows = normal_scores.with_normal_quantiles(spark.createDataFrame([(p,) for p in ps], "p double"), {"z": F.col("p")})
    for r in rows.collect():
        assert r.z == pytest.approx(tails.NORMAL.inv_cdf(r.p), rel=1e-13, abs=1e-15)


@pytest.mark.parametrize("n", [3, 80, 3000, 50_000])
def test_score_sums_equal_the_term_by_term_sum(spark, n):
    each = np.array([normal_scores._score(i, n) for i in range(1, n + 1)])
    assert normal_scores.square_sum(float(n)) == pytest.approx(float(each @ each), rel=1e-10)
    rng = np.random.default_rng(n)
    runs = [(0, n), (0, n // 2), (n // 3, n - 2), (n // 9, min(n, n // 9 + 70)), (1, 2), (1, 1), (n - 1, n)]
    runs += [tuple(sorted(int(x) for x in rng.integers(0, n + 1, 2))) for _ in range(40)]
    rows = spark.createDataFrame([(a, b, n) for a, b in runs], "before long, upto long, n long")
    found = normal_scores.with_score_sums(rows, {"s": tuple(map(F.col, ("before", "upto", "n")))})
    for r in found.collect():
        assert r.s == pytest.approx(math.fsum(each[r.before : r.upto]), abs=1e-9)


def test_rank_sum_exact_tail():
    males, females = [19, 22, 16, 29, 24], [20, 11, 17, 12]
    u = sum(a > b for a in males for b in females)
    assert ex.rank_sum_p(u, 5, 4, 0) == pytest.approx(1 / 9)
    # all arrangements of 3 + 4 without ties
    pooled = range(7)
    for u_seen in range(13):
        hits = total = 0
        for chosen in itertools.combinations(pooled, 3):
            rest = [v for v in pooled if v not in chosen]
            u1 = sum(a > b for a in chosen for b in rest)
            total += 1
            hits += u1 >= max(u_seen, 12 - u_seen)
        assert ex.rank_sum_p(u_seen, 3, 4, 0) == pytest.approx(min(1.0, 2 * hits / total))


def _tail_by_recurrence(u, n1, n2):
    """Numbers of arrangements for each U, by the larger member's sample."""
    ways = {(0, k): [1] for k in range(n2 + 1)} | {(k, 0): [1] for k in range(n1 + 1)}
    for a in range(1, n1 + 1):
        for b in range(1, n2 + 1):
            out = [0] * (a * b + 1)
            for at, w in enumerate(ways[a - 1, b]):
                out[at + b] += w
            for at, w in enumerate(ways[a, b - 1]):
                out[at] += w
            ways[a, b] = out
    return Fraction(sum(ways[n1, n2][u:]), math.comb(n1 + n2, n1))


@pytest.mark.parametrize("n1, n2", [(1, 1), (1, 40), (2, 9), (3, 30), (5, 20), (8, 25), (8, 8)])
def test_exact_tail_equals_the_recurrence(n1, n2):
    for u in range(0, n1 * n2 + 1, max(1, n1 * n2 // 17)):
        assert ex.exact_rank_tail(u, n1, n2) == _tail_by_recurrence(u, n1, n2)


def test_exact_tail_beside_a_sample_of_any_size():
    n = 10**6
    assert ex.exact_rank_tail(0, 8, n) == 1 and ex.exact_rank_tail(8 * n, 8, n) == Fraction(1, math.comb(n + 8, 8))
    middle = float(ex.exact_rank_tail(4 * n, 8, n))
    assert middle == pytest.approx(0.5, abs=1e-5) and middle > 0.5
    u = int(4 * n + 2.0 * math.sqrt(8 * n * (n + 9) / 12))
    # U / n is nearly a sum of 8 uniform numbers (Irwin and Hall)
    x = 8 - u / n
    tail = sum((-1) ** k * math.comb(8, k) * (x - k) ** 8 for k in range(int(x) + 1)) / math.factorial(8)
    assert float(ex.exact_rank_tail(u, 8, n)) == pytest.approx(tail, rel=1e-4)
    assert ex.rank_sum_p(u, 8, n, 0) == pytest.approx(2 * tail, rel=1e-4)
    assert 0 < ex.rank_sum_p(8 * 10**12, 8, 10**12, 0) < 1e-80


def test_rank_sum_normal_tail_with_ties():
    # continuity and tie corrected: n1 = n2 = 10, mean 50
    expected = math.erfc((70 - 50 - 0.5) / math.sqrt(100 / 12 * (21 - 600 / 380)) / math.sqrt(2))
    assert ex.rank_sum_p(30, 10, 10, 600) == pytest.approx(expected)
    assert math.isnan(ex.rank_sum_p(50, 10, 10, 20**3 - 20))


@pytest.mark.parametrize("slice_rows", [10, 10**9])
def test_statistics_equal_brute_force(spark, slice_rows):
    rng = np.random.default_rng(4)
    c, e = rng.normal(5, 2, 301).round(1), rng.exponential(5, 240).round(1)
    long = ex.samples(arms(spark, c, e), ["m"])
    row = ex.arm_statistics(long, ["metric"], slice_rows=slice_rows).first()
    assert row.control_median == np.median(c) and row.experiment_median == np.median(e)
    assert row.u_statistic == sum((a > e).sum() + 0.5 * (a == e).sum() for a in c)
    _, counts = np.unique(np.concatenate([c, e]), return_counts=True)
    assert row.tie_sum == (counts**3 - counts).sum()
    zc, ze = abs(c - np.median(c)), abs(e - np.median(e))
    every = np.concatenate([zc, ze])
    between = len(c) * (zc.mean() - every.mean()) ** 2 + len(e) * (ze.mean() - every.mean()) ** 2
    within = ((zc - zc.mean()) ** 2).sum() + ((ze - ze.mean()) ** 2).sum()
    assert row.levene_w == pytest.approx((len(every) - 2) * between / within)
    gap, vc, ve = c.mean() - e.mean(), c.var(ddof=1) / 301, e.var(ddof=1) / 240
    assert row.welch_t == pytest.approx(gap / math.sqrt(vc + ve))
    sums = ex.rank_sums(long, ["metric"], slice_rows=slice_rows).first()
    for sample, a in ((c, "c"), (e, "e")):
        found = normal_scores.shapiro_p(
            sums[f"n_{a}"], (sums[f"n_{a}"] - 1) * sums[f"var_{a}"], sums[f"scores_{a}"],
            sums[f"first_{a}"], sums[f"second_{a}"], sums[f"before_last_{a}"], sums[f"last_{a}"],
        )
        assert found == pytest.approx(brute_shapiro(sample), rel=1e-6)


def test_choice_of_test(spark):
    rng = np.random.default_rng(1)
    frames = {
        "Student's t-test": (rng.normal(0, 1, 60), rng.normal(0.2, 1, 60)),
        "Welch's t-test": (rng.normal(0, 1, 60), rng.normal(0, 9, 60)),
        "Mann-Whitney U test": (rng.exponential(1, 60), rng.normal(0, 1, 60)),
    }
    for wanted, (c, e) in frames.items():
        row = ex.analyze_experiment(arms(spark, c, e), ["m"], draws=0).first()
        assert row.test_type == wanted
        gap = e.mean() - c.mean()
        assert row.absolute_difference == pytest.approx(gap)
        assert row.relative_difference_percent == pytest.approx(gap / c.mean() * 100)
        if wanted == "Student's t-test":
            pooled = (c.var(ddof=1) + e.var(ddof=1)) / 2
            t = gap / math.sqrt(pooled * 2 / 60)
            assert row.p_value == pytest.approx(tails.t_two_sided(t, 118))


def test_too_few_values_give_an_error(spark):
    row = ex.analyze_experiment(arms(spark, [1.0, None], [1.0, 2.0, 3.0]), ["m"]).first()
    assert row.error == ex.NOT_ENOUGH and row.p_value is None and row.significant is False
    assert row.test_type is None and row.ci_lower is None
    assert (row.control_sample_size, row.experiment_sample_size) == (1, 3)


def test_constant_arms_have_no_p_value(spark):
    row = ex.analyze_experiment(arms(spark, [5.0] * 12, [5.0] * 12), ["m"], draws=200).first()
    assert row.p_value is None and row.significant is False and row.absolute_difference == 0
    assert (row.ci_lower, row.ci_upper) == (0, 0)


def test_zero_control_mean_has_no_relative_difference(spark):
    row = ex.analyze_experiment(arms(spark, [-1.0, 1.0, 0.0], [1.0, 2.0, 3.0]), ["m"], draws=0).first()
    assert row.relative_difference_percent is None and row.absolute_difference == 2


def test_bootstrap_matches_the_normal_interval_and_repeats(spark):
    rng = np.random.default_rng(2)
    c, e = rng.exponential(3, 20_000), rng.exponential(3.2, 15_000)
    found = [
        ex.bootstrap_intervals(ex.samples(arms(spark, c, e, parts), ["m"]), ["metric"], draws=4000).first()
        for parts in (1, 7)
    ]
    assert found[0].ci_lower == pytest.approx(found[1].ci_lower, abs=1e-9)
    error = math.sqrt(c.var() / len(c) + e.var() / len(e))
    gap = e.mean() - c.mean()
    assert found[0].ci_lower == pytest.approx(gap - 1.96 * error, abs=0.12 * error)
    assert found[0].ci_upper == pytest.approx(gap + 1.96 * error, abs=0.12 * error)


def test_bootstrap_of_a_small_sample_matches_plain_resampling(spark):
    rng = np.random.default_rng(6)
    c, e = rng.lognormal(0, 1, 25), rng.lognormal(0.5, 1, 30)
    found = ex.bootstrap_intervals(ex.samples(arms(spark, c, e), ["m"]), ["metric"]).first()
    plain = rng.choice(e, (20_000, 30)).mean(1) - rng.choice(c, (20_000, 25)).mean(1)
    low, high = np.percentile(plain, [2.5, 97.5])
    assert found.ci_lower == pytest.approx(low, abs=0.08) and found.ci_upper == pytest.approx(high, abs=0.08)


def test_poisson_weights_have_their_law():
    for bit in (0, 1, 5, 20, 34):
        table, mean = ex._poisson(bit), 2.0**bit
        assert table.mean() == pytest.approx(mean, rel=2e-4 / math.sqrt(mean) + 1e-6)
        assert table.var() == pytest.approx(mean, rel=3e-3)


def test_bootstrap_of_ties_equals_that_of_single_values(spark):
    """A value that occurs c times draws once per binary digit of c, with the same law."""
    rng = np.random.default_rng(7)
    c, e = rng.integers(0, 3, 700), rng.integers(0, 4, 500)
    found = ex.bootstrap_intervals(ex.samples(arms(spark, c, e), ["m"]), ["metric"]).first()
    gap, error = e.mean() - c.mean(), math.sqrt(c.var() / 700 + e.var() / 500)
    assert found.ci_lower == pytest.approx(gap - 1.96 * error, abs=0.06 * error)
    assert found.ci_upper == pytest.approx(gap + 1.96 * error, abs=0.06 * error)


def test_bootstrap_does_not_depend_on_slices(spark):
    rng = np.random.default_rng(9)
    long = ex.samples(arms(spark, rng.normal(0, 1, 300), rng.normal(0, 1, 200)), ["m"])
    found = [ex.bootstrap_intervals(long, ["metric"], draws=300, slice_rows=n).first() for n in (40, 10**9)]
    assert found[0].ci_lower == pytest.approx(found[1].ci_lower, abs=1e-12)


def test_segments(spark):
    rows = []
    for segment, n_c, n_e in (("kept", 12, 10), ("short", 30, 9), (None, 50, 50)):
        rows += [(segment, "control", float(k)) for k in range(n_c)]
        rows += [(segment, "experiment", float(k + 1)) for k in range(n_e)]
    rows += [("kept", "other", 1.0), ("kept", "control", None)]
    df = spark.createDataFrame(rows, "segment string, variant string, m double")
    (row,) = ex.segment_impact(df, "segment", "m", draws=100).collect()
    assert row.segment == "kept" and row.metric == "m for segment=kept"
    assert row.segment_size == 24
    assert row.segment_size_percent == pytest.approx(24 / len(rows) * 100)
    assert (row.control_sample_size, row.experiment_sample_size) == (12, 10)


def test_stored_results_have_a_row_per_variant(spark):
    compared = ex.analyze_experiment(arms(spark, range(20), range(1, 21)), ["m"], draws=0)
    rows = ex.stored_results(compared, "T", "name", "2024-01-01", "2024-01-31").collect()
    assert {(r.variant, r.value, r.sample_size) for r in rows} == {
        ("control", 9.5, 20), ("experiment", 10.5, 20),
    }
    assert len({r.p_value for r in rows}) == 1


def test_confidence_interval(spark):
    df = spark.createDataFrame(
        [("a", 1.0), ("a", 2.0), ("a", 4.0), ("b", 5.0), ("c", None)], "date string, m double"
    )
    rows = {r.date: r for r in ex.timeseries_intervals(df, "m").collect()}
    half = 4.302652729911275 * np.std([1, 2, 4], ddof=1) / math.sqrt(3)
    assert rows["a"].m_lower == pytest.approx(7 / 3 - half) and rows["a"].m_upper == pytest.approx(7 / 3 + half)
    assert rows["b"].m_mean == 5 and rows["b"].m_lower is None
    assert rows["c"].m_mean is None and rows["c"].m_sample_size == 0
    assert ex.confidence_intervals(df, "m").first().sample_size == 4


def test_power_columns(spark):
    row = spark.range(1).select(
        ex.required_sample_size(F.lit(0.32), 0.03).alias("n"),
        ex.days_to_fill(F.lit(1900), F.lit(1000)).alias("days"),
        ex.minimum_detectable_effect(F.lit(0.5), F.lit(200.0)).alias("mde"),
    ).first()
    z = 1.959963984540054 + 0.8416212335729143
    assert row.n == math.ceil((z / (0.03 / math.sqrt(0.32 * 0.68))) ** 2)
    assert row.days == pytest.approx(7.6) and row.mde == pytest.approx(z * 0.05)
