import numpy as np
import pytest
from pyspark.sql import functions as F

from hostpulse.operators.ocsvm import NearestPoint, below, certificate, fit_ocsvm, solve, with_offsets

COLUMNS = [f"x{i}" for i in range(4)]
N = 4000


@pytest.fixture(scope="module")
def cloud(spark):
    x = np.random.default_rng(5).normal(size=(N, 4)) + 3
    rows = [(i, *map(float, r)) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "id long, " + ", ".join(f"{c} double" for c in COLUMNS)).cache()


def best(x, nu):
    """Closest point to the origin among means of nu-shares of the rows, by conditional gradient."""
    w, size = x.mean(0), nu * len(x)
    whole = int(size)
    for _ in range(5000):
        order = np.argsort(x @ w)
        vertex = (x[order[:whole]].sum(0) + (size - whole) * x[order[whole]]) / size
        step = vertex - w
        gain = -(w @ step)
        if gain < 1e-9:
            break
        w = w + min(1.0, gain / (step @ step)) * step
    rho = np.sort(x @ w)[whole]
    return w, w @ w / 2 - rho + np.maximum(0, rho - x @ w).mean() / nu


@pytest.mark.parametrize("nu", [0.05, 0.1, 0.0001])
def test_certified_optimum_with_the_nu_share_flagged(cloud, nu):
    solved = solve(cloud, COLUMNS, ["id"], N, [nu])[nu]
    model = with_offsets(cloud, {nu: solved[0]}, N)[nu]
    x = cloud.select(*COLUMNS).toPandas().to_numpy()
    weights, value = best(x, max(nu, 1 / N))
    ours = np.array([model[0][c] for c in COLUMNS])
    assert ours @ weights / np.linalg.norm(ours) / np.linalg.norm(weights) > 0.999
    found = certificate(cloud, model, max(nu, 1 / N)).first()
    assert solved[1] <= 1e-3 and -1e-6 <= found.gap <= 1.01e-3 * (ours @ ours) + 1e-9
    assert found.dual - 1e-6 <= value <= found.objective + 1e-6
    flagged = cloud.where(below(model)).count()
    assert flagged == int(nu * N) == round(found.share_below * N)


def test_same_labels_in_any_partitioning_and_column_order(cloud):
    want = None
    for df, columns in ((cloud.coalesce(1), COLUMNS), (cloud.repartition(9), COLUMNS), (cloud.select("id", *COLUMNS[::-1]), COLUMNS[::-1])):
        models = fit_ocsvm(df, columns, ["id"], N, [0.05, 0.1])
        flagged = {nu: {r.id for r in df.where(below(m)).select("id").collect()} for nu, m in models.items()}
        want = want or flagged
        assert flagged == want and {nu: len(f) for nu, f in flagged.items()} == {0.05: 200, 0.1: 400}


def test_ties_at_the_boundary_lie_on_it(spark):
    """A tenth of the rows share the lowest value: a share of 5 % lies among them, so none is below; a share of 20 % has them all."""
    rows = [(i, 0.1, 0.3) if i % 10 == 0 else (i, 1.0 + i / 700, 2.0 + (i * 37 % 100) / 77) for i in range(2000)]
    df = spark.createDataFrame(rows, "id long, a double, b double")
    models = fit_ocsvm(df, ["a", "b"], ["id"], 2000, [0.05, 0.2])
    assert df.where(below(models[0.05])).count() == 0
    low = df.where(below(models[0.2]))
    assert 200 <= low.count() <= 400 and low.where("id % 10 = 0").count() == 200


def test_centred_rows_have_the_zero_solution(cloud):
    centred = cloud.select("id", *[(F.col(c) - 3).alias(c) for c in COLUMNS])
    weights, _ = solve(centred, COLUMNS, ["id"], N, [0.5])[0.5]
    assert max(map(abs, weights.values())) < 0.05


def test_nearest_point_of_a_triangle_and_of_one_row():
    near = NearestPoint(np.array([3.0, 1.0]))
    near.meet(np.array([1.0, 3.0]))
    assert near.point == pytest.approx([2.0, 2.0])
    near.meet(np.array([-1.0, -1.0]))
    assert near.point == pytest.approx([0.0, 0.0], abs=1e-9)
    near = NearestPoint(np.array([2.0, 0.0]))
    near.meet(np.array([3.0, 0.0]))
    assert near.point == pytest.approx([2.0, 0.0])
