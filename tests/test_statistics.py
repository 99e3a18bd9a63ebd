"""Contrasts, ranks and bootstrap against brute force."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexigrain.operators import contrast, ranking


def groups(spark, one, zero):
    rows = [(1, float(v)) for v in one] + [(0, float(v)) for v in zero]
    return spark.createDataFrame(rows, "target int, value double")


def brute_u(one, zero):
    return sum((a > b) + 0.5 * (a == b) for a, b in itertools.product(one, zero))


@pytest.mark.parametrize("small_domain", [True, False])
def test_u_matches_all_pairs(spark, small_domain):
    generator = random.Random(3)
    one = [generator.randint(0, 9) for _ in range(80)]
    zero = [generator.randint(2, 12) for _ in range(60)]
    row = contrast.mann_whitney(groups(spark, one, zero), ["value"], small_domain=small_domain).first()
    assert row.u_statistic == brute_u(one, zero)
    assert row.p_greater > 0.5 > row.p_two_sided


def test_extreme_deltas_and_exact_p(spark):
    row = contrast.mann_whitney(groups(spark, [0.8, 0.9, 1.0], [0.0, 0.1, 0.2]), ["value"]).first()
    assert row.u_statistic == 9 and row.p_greater == pytest.approx(1 / 20) and row.p_two_sided == pytest.approx(0.1)
    delta = contrast.cliffs_delta(groups(spark, [0.8, 0.9], [0.0, 0.1]), ["value"]).first()
    assert delta.cliffs_delta == 1 and delta.magnitude == "grande"


def test_full_contrast(spark):
    generator = np.random.default_rng(3)
    one, zero = generator.uniform(0.2, 1.0, 300), generator.uniform(0.0, 0.8, 400)
    row = contrast.compare_groups(groups(spark, one, zero), ["value"], resamples=500).first()
    assert row.mean_difference == pytest.approx(one.mean() - zero.mean())
    assert row.median_group_1 == pytest.approx(np.median(one))
    assert row.mean_ci_low <= row.mean_difference <= row.mean_ci_high
    assert row.median_ci_low <= row.median_difference <= row.median_ci_high


def test_bootstrap_is_reproducible(spark):
    frame = groups(spark, range(40), range(5, 30))
    first, second = (contrast.bootstrap_intervals(frame, ["value"], resamples=200).first() for _ in range(2))
    assert first == second


def test_empty_group_raises(spark):
    with pytest.raises(ValueError):
        contrast.bootstrap_intervals(groups(spark, [], [1.0]), ["value"], resamples=10)


def in_order(frame, columns):
    return sorted(map(str, map(tuple, frame.select(columns).collect())))


@pytest.mark.parametrize("rows", [10**9, 200, 20, 1])
def test_ranges_give_the_same_prefix_sums(spark, monkeypatch, rows):
    monkeypatch.setattr(ranking, "ROWS_PER_RANGE", rows)
    values = [(k, float(v), v % 3 + 1, v % 5) for k in (0, 1, None) for v in range(300 if k else 40)]
    values += [(0, math.inf, 2, 0), (0, -math.inf, 2, 0), (0, math.nan, 4, 0)]
    table = spark.createDataFrame(values, "k int, value double, n long, m long")
    columns = ["k", "value", "before_n", "total_n", "lower_n", "before_m", "total_m", "lower_m"]
    for keys in (["k"], []):
        wide = ranking.prefix_sums(table, keys, ["n", "m"], neighbours=True, then=["k"])
        plain = ranking.prefix_sums(table, keys, ["n", "m"], small_domain=True, neighbours=True, then=["k"])
        assert in_order(wide, columns) == in_order(plain, columns)


def test_rows_move_once_to_their_range(spark, monkeypatch):
    monkeypatch.setattr(ranking, "ROWS_PER_RANGE", 50)
    table = spark.range(1000).select((F.col("id") % 2).alias("k"), F.col("id").cast("double").alias("value"), F.lit(1).alias("n"))
    counts = ranking.with_ranges(ranking.materialise(table), ["k"], "value")
    sizes = [row["count"] for row in counts.groupBy("k", "_range").count().collect()]
    assert len(sizes) == 32 and max(sizes) < 60  # 500 rows of each key in 16 ranges
    summed = ranking.prefix_sums(table, ["k"], ["n"])
    plan = summed._jdf.queryExecution().executedPlan().toString()
    # Besides the sums of whole ranges, which travel as one row each, one shuffle: by key and range.
    moves = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert sum("_range" in line for line in moves) == 2 and sum("Window" in line for line in plan.splitlines()) >= 2
    assert all(r.before_n == r.value // 2 and r.total_n == 500 for r in summed.collect())


@pytest.mark.parametrize("rows", [10**9, 100, 7])
def test_spearman_of_a_heavy_value(spark, monkeypatch, rows):
    """Half of the pairs share x while y is wide, and the other way round."""
    monkeypatch.setattr(ranking, "ROWS_PER_RANGE", rows)
    draw = np.random.default_rng(7)
    x = np.where(draw.random(1500) < 0.5, 3.0, draw.integers(0, 400, 1500) / 8)
    y = np.where(draw.random(1500) < 0.3, -1.0, x + draw.normal(size=1500) * 20)

    def ranks(values):
        below = np.searchsorted(np.sort(values), values, "left")
        return below + (np.searchsorted(np.sort(values), values, "right") - below + 1) / 2

    expected = np.corrcoef(ranks(x), ranks(y))[0, 1]
    frame = spark.createDataFrame(list(zip(x.tolist(), y.tolist())), "a double, b double")
    result = contrast.spearman(frame, "a", "b")
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "Join [x" not in plan and "Join [y" not in plan
    assert result.first().correlation == pytest.approx(expected)
    assert contrast.spearman(frame.limit(0), "a", "b").first().correlation is None


def test_spearman_with_ties(spark):
    generator = random.Random(5)
    pairs = [(float(generator.randint(0, 5)), float(generator.randint(0, 5))) for _ in range(60)]

    def ranks(values):
        return [sum(v < x for v in values) + (sum(v == x for v in values) + 1) / 2 for x in values]

    expected = np.corrcoef(ranks([a for a, _ in pairs]), ranks([b for _, b in pairs]))[0, 1]
    frame = spark.createDataFrame(pairs, "a double, b double")
    assert contrast.spearman(frame, "a", "b").first().correlation == pytest.approx(expected)


def test_rank_places_are_found_by_binary_search(spark, monkeypatch):
    """No row looks through all cuts, however many ranges there are."""
    monkeypatch.setattr(ranking, "ROWS_PER_RANGE", 7)
    frame = spark.createDataFrame([(float(at % 3), float(at)) for at in range(200)], "a double, b double")
    plan = contrast.spearman(frame, "a", "b")._jdf.queryExecution().optimizedPlan().toString()
    assert "slice(" not in plan and "filter(" not in plan
    cuts = F.array(*[F.lit(float(v)) for v in (1, 2, 2, 2, 5)])
    values = spark.createDataFrame([(0.0,), (1.0,), (2.0,), (3.0,), (5.0,)], "v double")
    places = [ranking.place_among(F.col("v"), cuts, 3, equal).alias(f"p{equal:d}") for equal in (False, True)]
    assert [tuple(r) for r in values.select(*places).collect()] == [(0, 0), (0, 1), (1, 4), (4, 4), (4, 5)]


def test_exact_tail_counts_arrangements():
    for m, n in ((1, 1), (2, 3), (3, 5), (4, 4), (5, 2)):
        ranks = range(m + n)
        counts = {}
        for chosen in itertools.combinations(ranks, m):
            u = sum(a > b for a in chosen for b in set(ranks) - set(chosen))
            counts[u] = counts.get(u, 0) + 1
        for u in range(m * n + 2):
            want = sum(c for value, c in counts.items() if value >= u) / sum(counts.values())
            assert contrast._exact_tail(u, m, n) == pytest.approx(want)


def test_exact_p_goes_by_the_smaller_group_alone():
    """A tie-free group of eight is exact however large the other group is."""
    two, greater = contrast._p_values(8 * 40_000, 8, 40_000, 0)
    assert greater == pytest.approx(1 / math.comb(40_008, 8)) and two == pytest.approx(2 * greater)


def test_bootstrap_of_many_values_equals_resampling(spark):
    """More distinct values than any table on the driver, against plain resampling."""
    generator = np.random.default_rng(11)
    one, zero = generator.exponential(2.0, 40_000), generator.exponential(1.5, 30_001)
    row = contrast.bootstrap_intervals(groups(spark, one, zero), ["value"], resamples=400).first()
    means, medians = [], []
    for _ in range(400):
        a, b = generator.choice(one, len(one)), generator.choice(zero, len(zero))
        means.append(a.mean() - b.mean())
        medians.append(np.median(a) - np.median(b))
    for found, draws in ((row.mean_ci_low, means), (row.median_ci_low, medians)):
        assert found == pytest.approx(np.quantile(draws, 0.025), abs=0.5 * np.std(draws))
    for found, draws in ((row.mean_ci_high, means), (row.median_ci_high, medians)):
        assert found == pytest.approx(np.quantile(draws, 0.975), abs=0.5 * np.std(draws))


def test_bootstrap_rejects_values_that_are_not_finite(spark):
    with pytest.raises(ValueError):
        contrast.bootstrap_intervals(groups(spark, [1.0, math.inf], [2.0]), ["value"], resamples=10)
