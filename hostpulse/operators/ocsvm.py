"""Linear one-class SVM, solved to a certified gap.

Objective (Schoelkopf et al. 2001): |w|^2 / 2 - rho + mean(max(0, rho - w.x)) / nu. Its dual is the point nearest to the origin
among the weighted means of rows in which no row weighs more than 1 / (nu n). Such a mean is found by Wolfe's (1976) method: the
lowest vertex in the direction of the current point is the mean of the nu share of rows with the smallest w.x, and the nearest
point of the vertices met so far is the next one.

Every shard of rows is solved on its own in a task; the size-weighted mean of the shards' answers is a feasible dual point of the
whole. From there the same method runs over all rows, where a vertex is one exact order statistic and one aggregate, until the
duality gap w.w - w.v, which bounds the distance to the optimum, is small. Several nu share all passes.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from hostpulse.config import SEED
from hostpulse.operators.quantiles import nth_values

SHARD_ROWS = 50_000
MIN_SHARDS = 8
#: Duality gap at which a solution is accepted, as a share of w.w; and steps after which the best one is taken as it is.
GAP = 1e-3
SHARD_STEPS, ROUNDS = 200, 12
#: Digits that are kept of a weight, so that the order of summation in any partitioning leaves it alone.
DIGITS = 9
#: A row lies below the boundary by more than this share of its own terms, or it does not.
TOLERANCE = 1e-9
Weights = dict[str, float]
Model = tuple[Weights, float]


class NearestPoint:
    """Point nearest to the origin among the convex combinations of the vertices met so far (Wolfe's method)."""

    def __init__(self, start: np.ndarray) -> None:
        self.vertices, self.shares = start[None, :].copy(), np.ones(1)

    @property
    def point(self) -> np.ndarray:
        return self.shares @ self.vertices

    def meet(self, vertex: np.ndarray) -> None:
        self.vertices = np.vstack([self.vertices, vertex])
        self.shares = np.append(self.shares, 0.0)
        while True:
            affine = self._affine()
            if affine.min() > -1e-12:
                self.shares = np.clip(affine, 0, None) / np.clip(affine, 0, None).sum()
                break
            # Walk towards the affine answer until a share is used up; that vertex leaves.
            falling = affine < self.shares - 1e-15
            steps = np.full(len(affine), np.inf)
            steps[falling] = self.shares[falling] / (self.shares[falling] - affine[falling])
            step = min(1.0, steps[affine <= 0].min())
            self.shares = self.shares + step * (affine - self.shares)
            stay = self.shares > 1e-14
            if stay.all():
                stay[np.argmin(self.shares)] = False
            self.vertices, self.shares = self.vertices[stay], self.shares[stay] / self.shares[stay].sum()

    def _affine(self) -> np.ndarray:
        """Shares (of any sign) of the point of the vertices' affine hull that is nearest to the origin."""
        m = len(self.shares)
        gram = self.vertices @ self.vertices.T
        system = np.ones((m + 1, m + 1))
        system[0, 0], system[1:, 1:] = 0.0, gram / max(np.trace(gram) / m, 1e-300)
        return np.linalg.lstsq(system, np.eye(m + 1)[0], rcond=None)[0][1:]


def _vertex(x: np.ndarray, w: np.ndarray, nu: float) -> np.ndarray:
    """Mean of the nu share of rows that lie lowest along w; the last of them weighs what is left."""
    size = max(nu * len(x), 1.0)
    whole = min(int(size), len(x))
    along = x @ w
    order = np.argpartition(along, min(whole, len(x) - 1))
    vertex = x[order[:whole]].sum(0)
    if size > whole:
        vertex = vertex + (size - whole) * x[order[whole]]
    return vertex / size


def _solve_shard(x: np.ndarray, nu: float) -> np.ndarray:
    near = NearestPoint(_vertex(x, x.mean(0), nu))
    for _ in range(SHARD_STEPS):
        w = near.point
        vertex = _vertex(x, w, nu)
        if w @ w - w @ vertex <= GAP / 10 * (w @ w):
            break
        near.meet(vertex)
    return near.point


def _total(weights: Mapping[str, float]) -> Column:
    """w.x, summed in the order of the column names."""
    return reduce(lambda a, b: a + b, [F.col(c).cast("double") * F.lit(float(w)) for c, w in sorted(weights.items())])


def _vertices(
    df: DataFrame, features: Sequence[str], rows: int, points: Mapping[float, np.ndarray],
) -> dict[float, np.ndarray]:
    """The lowest vertex for each nu's point: exact order statistics, then one aggregate for all."""
    totals = df.select(*features, *[_total(dict(zip(features, w))).alias(f"_t{i}") for i, w in enumerate(points.values())])
    cuts = nth_values(totals, {f"_t{i}": min(int(nu * rows), rows - 1) for i, nu in enumerate(points)})
    parts = []
    for i in range(len(points)):
        total, cut = F.col(f"_t{i}"), cuts[f"_t{i}"]
        for kind, inside in (("below", total < cut), ("tied", total == cut)):
            parts.append(F.count_if(inside).alias(f"_{kind}_n{i}"))
            parts += [F.sum(F.when(inside, F.col(c).cast("double")).otherwise(0.0)).alias(f"_{kind}_{c}_{i}") for c in features]
    found = totals.agg(*parts).first()
    out = {}
    for i, nu in enumerate(points):
        below, tied = (np.array([found[f"_{kind}_{c}_{i}"] for c in features]) for kind in ("below", "tied"))
        size = max(nu * rows, 1.0)
        out[nu] = (below + tied * (size - found[f"_below_n{i}"]) / found[f"_tied_n{i}"]) / size
    return out


def solve(
    df: DataFrame, features: Sequence[str], keys: Sequence[str], rows: int, nus: Sequence[float], seed: int = SEED,
    shard_rows: int = SHARD_ROWS, gap: float = GAP, rounds: int = ROUNDS,
) -> dict[float, tuple[Weights, float]]:
    """Per nu: the weight of each feature, and the duality gap as a share of w.w. `df` should be a written table.

    Rows go to shards by a hash of their unique key and a shard holds about `shard_rows` rows, so the group handed to a task is
    bounded, even, and the same in any partitioning of the input.
    """
    features = sorted(features)
    shards = max(MIN_SHARDS, math.ceil(rows / shard_rows))
    grid = [float(nu) for nu in nus]

    def shard_points(shard: pd.DataFrame) -> pd.DataFrame:
        x = shard.sort_values(["draw", *features])[features].to_numpy(dtype=float)
        return pd.DataFrame([_solve_shard(x, nu) for nu in grid], columns=features).assign(nu=grid, n=len(x))

    hashed = F.xxhash64(F.lit(seed), *[F.col(k) for k in keys])
    sharded = df.select(*[F.col(c).cast("double").alias(c) for c in features], hashed.alias("draw")).withColumn(
        "shard", F.pmod(F.col("draw"), F.lit(shards)).cast("int")
    )
    # Compute-bound shards: one task each while they are few, then up to 32 (some 100 MB) per task.
    tasks = min(shards, max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(shards / 32)))
    sharded = sharded.repartition(tasks, "shard")
    schema = ", ".join([*[f"`{c}` double" for c in features], "nu double", "n long"])
    weighted = [(F.sum(F.col(c) * F.col("n")) / F.sum("n")).alias(c) for c in features]
    found = sharded.groupBy("shard").applyInPandas(shard_points, schema).groupBy("nu").agg(*weighted).collect()
    near = {r["nu"]: NearestPoint(np.array([_rounded(r[c]) for c in features])) for r in found}
    best: dict[float, tuple[np.ndarray, float]] = {}
    for _ in range(rounds):
        open_ = {nu: _rounded_all(near[nu].point) for nu in grid if nu not in best or best[nu][1] > gap}
        if not open_:
            break
        for nu, vertex in _vertices(df, features, rows, open_).items():
            w = open_[nu]
            size = float(w @ w)
            left = max(0.0, size - float(w @ vertex)) / size if size else 0.0
            if nu not in best or left < best[nu][1]:
                best[nu] = w, left
            near[nu].meet(vertex)
    return {nu: (dict(zip(features, best[nu][0].tolist())), best[nu][1]) for nu in grid}


def _rounded(value: float) -> float:
    return float(f"{value:.{DIGITS - 1}e}")


def _rounded_all(values: np.ndarray) -> np.ndarray:
    return np.array([_rounded(v) for v in values])


def with_offsets(df: DataFrame, weights: Mapping[float, Weights], rows: int) -> dict[float, Model]:
    """(weights, rho) per nu: at most a nu share of the rows lies below rho, which is itself one row's w.x, bit for bit."""
    totals = {f"total_{i}": _total(w) for i, w in enumerate(weights.values())}
    ranks = {n: min(int(nu * rows), rows - 1) for n, nu in zip(totals, weights)}
    offsets = nth_values(df.select(*[t.alias(n) for n, t in totals.items()]), ranks)
    return {nu: (dict(w), offsets[f"total_{i}"]) for i, (nu, w) in enumerate(weights.items())}


def fit_ocsvm(
    df: DataFrame, features: Sequence[str], keys: Sequence[str], rows: int, nus: Sequence[float], seed: int = SEED,
    shard_rows: int = SHARD_ROWS, gap: float = GAP, rounds: int = ROUNDS,
) -> dict[float, Model]:
    """Per nu: the weight of each feature, and the offset rho."""
    solved = solve(df, features, keys, rows, nus, seed, shard_rows, gap, rounds)
    return with_offsets(df, {nu: w for nu, (w, _) in solved.items()}, rows)


def margin(model: Model) -> Column:
    """w.x - rho as a column expression over the feature columns; negative means anomalous."""
    weights, rho = model
    return _total(weights) - F.lit(float(rho))


def below(model: Model) -> Column:
    """Whether a row lies below the boundary. Rows on it do not, and rounding of a row's own terms puts none there.

    Where more rows than the nu share have the lowest value of all, the boundary is that value, and none lies below it.
    """
    weights, rho = model
    terms = reduce(lambda a, b: a + b, [F.abs(F.col(c).cast("double") * F.lit(float(w))) for c, w in sorted(weights.items())])
    return margin(model) < -F.lit(TOLERANCE) * (terms + F.lit(abs(float(rho))))


def certificate(df: DataFrame, model: Model, nu: float) -> DataFrame:
    """One row: objective of the model, dual value -|w|^2 / 2 of its weights, their gap, and the share of rows below the boundary.

    The gap bounds the distance to the optimum if the weights are a mean of rows that the dual allows, as `solve` returns.
    """
    weights, rho = model
    square = sum(w * w for w in weights.values())
    hinge = F.avg(F.greatest(F.lit(0.0), -margin(model)))
    found = df.agg(
        F.count(F.lit(1)).alias("n"), (F.lit(square / 2 - rho) + hinge / F.lit(float(nu))).alias("objective"),
        F.avg(below(model).cast("double")).alias("share_below"),
    )
    return found.select("n", "objective", F.lit(-square / 2).alias("dual"), (F.col("objective") + F.lit(square / 2)).alias("gap"), "share_below")
