from collections import Counter

import numpy as np
import pytest

from hostpulse.operators.heavy import summaries, top_k


def rows(spark, values, parts=5):
    return spark.createDataFrame([(v, "x") for v in values], "key string, n string").repartition(parts)


def plain(values, k):
    counts = Counter(values)
    return sorted(counts.items(), key=lambda e: (-e[1], e[0] is None, e[0] or ""))[:k]


def skewed(n=6000, seed=2):
    rng = np.random.default_rng(seed)
    drawn = rng.zipf(1.3, n)
    return [None if v == 3 else f"v{v:07d}" for v in np.minimum(drawn, 3000 + rng.integers(0, 10**6, n))]


@pytest.mark.parametrize("counters, most", [(10_000, 100), (200, 5000), (200, 1), (3, 5000)])
def test_top_values_are_exact_whatever_the_summary_holds(spark, counters, most):
    """With all values in the summaries, with candidates counted again, with too many of them, and with too large an error."""
    values = skewed()
    found = top_k(rows(spark, values), "key", 10, "hits", counters, most).collect()
    assert [(r.key, r.hits) for r in found] == plain(values, 10)


@pytest.mark.parametrize("counters", [1, 7, 50])
def test_counts_lie_within_the_error_bound(spark, counters):
    values = skewed(3000)
    found = summaries(rows(spark, values, 4), "key", counters).collect()
    error = sum(r.error for r in found)
    merged = Counter()
    for r in found:
        merged[r.value] += r.n
    assert error <= len(values) / (counters + 1)
    assert len(found) <= 4 * (counters + 1)
    for value, n in Counter(values).items():
        assert merged[value] <= n <= merged[value] + error


def test_ties_repeats_few_values_and_no_rows(spark):
    ties = [f"t{i % 40:02d}" for i in range(400)]
    assert [(r.key, r.n) for r in top_k(rows(spark, ties), "key", 5, counters=4).collect()] == [(f"t{i:02d}", 10) for i in range(5)]
    assert [(r.key, r.n) for r in top_k(rows(spark, ["a", None, None]), "key", 5).collect()] == [(None, 2), ("a", 1)]
    assert top_k(rows(spark, ["a"]).limit(0), "key", 5).collect() == []


def test_a_hot_value_and_numbers(spark):
    df = spark.range(9000).selectExpr("if(id % 3 = 0, 7, 100 + id) as key")
    assert [(r.key, r.n) for r in top_k(df, "key", 1, counters=20).collect()] == [(7, 3000)]


def test_the_shuffle_holds_summaries_only(spark):
    df = rows(spark, skewed())
    plan = top_k(df, "key", 10, counters=200)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
