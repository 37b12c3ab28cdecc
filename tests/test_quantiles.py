import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from hostpulse.operators import quantiles as module
from hostpulse.operators.quantiles import quantiles

QS = [0.0, 0.05, 0.5, 0.9, 0.999, 1.0]


def check(spark, columns, **kwargs):
    rows = list(zip(*columns.values()))
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in columns)).repartition(3)
    found = quantiles(df, {c: QS for c in columns}, **kwargs)
    for c, v in columns.items():
        assert found[c] == pytest.approx(list(np.quantile(np.asarray(v), QS)), rel=1e-12, abs=1e-12)


def test_equals_numpy(spark):
    rng = np.random.default_rng(0)
    n = 3001
    check(spark, {
        "uniform": rng.random(n).tolist(), "heavy": np.exp(4 * rng.normal(size=n)).tolist(),
        "ties": rng.integers(0, 4, n).astype(float).tolist(), "constant": [2.5] * n,
        "hot": np.where(rng.random(n) < 0.9, 0.0, rng.normal(size=n) * 1e9).tolist(),
    })


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.floats(-1e12, 1e12, allow_nan=False), min_size=1, max_size=40))
def test_counting_passes_on_any_values(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    found = quantiles(df, {"x": QS}, bins=3)["x"]
    assert found == pytest.approx(list(np.quantile(np.asarray(values), QS)), rel=1e-9, abs=1e-3)


def test_nulls_and_empty(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (3.0, None)], "a double, b double")
    assert quantiles(df, {"a": [0.5], "b": [0.5]}) == {"a": [2.0], "b": [None]}


@pytest.mark.parametrize("most, reach", [(100_000, 2.0), (5, 2.0), (100_000, -0.2)])
def test_brackets_that_are_large_or_miss_their_rank(spark, monkeypatch, most, reach):
    """Values narrowed by counting, and ranks beyond the sketch's bracket, give the same values as a sort."""
    monkeypatch.setattr(module, "MOST_VALUES", most)
    monkeypatch.setattr(module, "REACH", reach)
    monkeypatch.setattr(module, "SKETCH_K", 64)
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(size=4000), np.repeat(0.25, 1500), rng.exponential(size=500) * 1e6])
    rng.shuffle(x)
    df = spark.createDataFrame([(float(v), float(int(v * 3))) for v in x], "a double, b double")
    shares = [0.0, 0.01, 0.5, 0.62, 0.999, 1.0]
    got = quantiles(df, {"a": shares, "b": shares})
    assert got["a"] == pytest.approx(np.quantile(x, shares).tolist())
    assert got["b"] == pytest.approx(np.quantile(np.trunc(x * 3), shares).tolist())
    ranks = {"a": 4321, "b": 5999}
    assert module.nth_values(df, ranks) == {"a": np.sort(x)[4321], "b": np.sort(np.trunc(x * 3))[5999]}
