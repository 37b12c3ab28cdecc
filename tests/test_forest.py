import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from hostpulse.operators.forest import CHUNK, Forest, _grow, add_scores, average_path, fit_forest, leaf_masks, path_lengths, sample_per_tree

COLUMNS = ["a", "b", "c"]


def points(spark, n=1000, outliers=5):
    rng = np.random.default_rng(3)
    x = np.vstack([rng.normal(size=(n, 3)), 20 + rng.normal(size=(outliers, 3))])
    return spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id long, a double, b double, c double")


def scores(df, **kwargs):
    forest = fit_forest(df, COLUMNS, ["id"], df.count(), **kwargs)
    return {r.id: r.score for r in add_scores(df, forest, COLUMNS).select("id", "score").collect()}


def test_planted_outliers_score_lowest(spark):
    found = scores(points(spark), trees=50)
    assert sorted(found, key=found.get)[:5] == sorted(range(1000, 1005), key=found.get)
    assert all(-1 <= s <= 0 for s in found.values())


def test_same_scores_in_any_partitioning(spark):
    df = points(spark)
    expected = scores(df.coalesce(1), trees=20)
    for parts in (4, 16):
        assert scores(df.repartition(parts), trees=20) == expected
    assert scores(df, trees=20, seed=7) != expected


@pytest.mark.parametrize("n, trees, psi", [(50, 6, 64), (300, 7, 64), (5000, 10, 64), (40000, 10, 64)])
def test_samples_are_full_and_without_replacement(spark, n, trees, psi):
    size = min(n, psi)
    drawn = sample_per_tree(spark.range(n), ["id"], n, trees, size, 1)
    per_tree = drawn.groupBy("tree").agg(F.count("*").alias("n"), F.count_distinct("id").alias("d")).collect()
    assert sorted(r.tree for r in per_tree) == list(range(trees))
    assert {(r.n, r.d) for r in per_tree} == {(size, size)}


def test_every_row_is_equally_likely(spark):
    n, trees, psi = 400, 200, 64
    hits = sample_per_tree(spark.range(n), ["id"], n, trees, psi, 5).groupBy("id").count().toPandas()["count"]
    assert hits.sum() == trees * psi
    assert abs(hits.mean() - trees * psi / n) < 3 and hits.std() < 3 * (trees * psi / n) ** 0.5


def test_average_path():
    assert average_path(np.array([1, 2])).tolist() == [0.0, 1.0]
    assert float(average_path(256)) == pytest.approx(10.2448, abs=1e-3)


def test_path_lengths_by_hand():
    nodes = pd.DataFrame(
        [(0, 0, 0, 0.5, 1, 2, 0, 4), (0, 1, -1, np.nan, -1, -1, 1, 1), (0, 2, 1, 10.0, 5, 6, 1, 3),
         (0, 5, -1, np.nan, -1, -1, 2, 2), (0, 6, -1, np.nan, -1, -1, 2, 1)],
        columns=["tree", "node", "feature", "threshold", "left", "right", "depth", "n"],
    )
    x = np.array([[0.5, 99.0], [0.6, 10.0], [0.6, 10.1]])
    assert path_lengths(leaf_masks(Forest(nodes, 4, 1, 0), 2), x).tolist() == [[1.0, 3.0, 2.0]]


def walked(forest, x):
    """Path lengths by following every row down every tree."""
    out = []
    for _, nodes in forest.nodes.groupby("tree"):
        by_node = nodes.set_index("node").to_dict("index")
        for row in x:
            at = by_node[0]
            while at["feature"] >= 0:
                at = by_node[at["right" if row[at["feature"]] > at["threshold"] else "left"]]
            out.append(at["depth"] + float(average_path(at["n"])))
    return np.reshape(out, (forest.trees, len(x)))


@pytest.mark.parametrize("features, ties", [(1, False), (3, False), (9, True), (64, False)])
def test_bit_vectors_equal_a_walk(features, ties):
    rng = np.random.default_rng(features)
    x = rng.normal(size=(2000, features))
    if ties:
        x = np.round(x)
        x[:, 4] = 1.0
    rows = [(t, *r) for t in range(6) for r in _grow(x[rng.choice(2000, 256, replace=False)], rng, 8)]
    nodes = pd.DataFrame(rows, columns=["tree", "node", "feature", "threshold", "left", "right", "depth", "n"]).astype({"threshold": float})
    forest = Forest(nodes.sample(frac=1, random_state=1), 256, 6, 0)
    masks = leaf_masks(forest, features)
    # Rows on a threshold, beyond all of them, and without a value.
    edges = np.tile(nodes["threshold"].dropna().to_numpy()[:60, None], features)
    probe = np.vstack([x[:200], edges, np.full((1, features), np.inf), np.full((1, features), -np.inf), np.full((1, features), np.nan)])
    assert np.array_equal(path_lengths(masks, probe), walked(forest, probe))
    many = np.tile(probe, (CHUNK // len(probe) + 2, 1))
    assert np.array_equal(path_lengths(masks, many)[:, -len(probe):], path_lengths(masks, probe))
    assert path_lengths(masks, probe[:0]).shape == (6, 0)


def test_node_table_matches_its_samples(spark):
    forest = fit_forest(points(spark), COLUMNS, ["id"], 1005, trees=8)
    leaves = forest.nodes[forest.nodes.feature < 0]
    assert (leaves.groupby("tree")["n"].sum() == 256).all()
    assert forest.nodes.groupby("tree").size().max() <= 511 and forest.nodes.depth.max() <= 8


def test_constant_rows_give_one_leaf_per_tree(spark):
    df = spark.range(600).selectExpr("id", "1.0D as a", "2.0D as b", "3.0D as c")
    assert set(fit_forest(df, COLUMNS, ["id"], 600, trees=4).nodes.n) == {256}


def test_flagged_share_follows_the_cut_off(spark):
    df = points(spark, 2000, 0)
    scored = add_scores(df, fit_forest(df, COLUMNS, ["id"], 2000, trees=30), COLUMNS)
    cut = scored.agg(F.percentile("score", 0.05)).first()[0]
    assert abs(scored.filter(F.col("score") < cut).count() - 100) <= 1


def test_first_trees_equal_a_smaller_forest(spark):
    df = points(spark)
    big = add_scores(df, fit_forest(df, COLUMNS, ["id"], 1005, trees=20), COLUMNS, "s", {"half": 10})
    halves = {r.id: r.half for r in big.select("id", "half").collect()}
    forest = fit_forest(df, COLUMNS, ["id"], 1005, trees=20).first(10)
    assert {r.id: r.score for r in add_scores(df, forest, COLUMNS).collect()} == pytest.approx(halves)
