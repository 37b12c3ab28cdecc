"""Isolation Forest: a sampled, grouped fit and a narrow scoring pass (Liu, Ting, Zhou 2008)."""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from hostpulse.config import SEED, SUBSAMPLE, TREES

# Rows drawn per tree before the cut to the sub-sample size; twice the size makes a short tree
# practically impossible (more than ten standard deviations), and a short tree is an error.
OVERSAMPLE = 2.0
NODE_SCHEMA = "tree int, node int, feature int, threshold double, left int, right int, depth int, n long"
_UNIT = 2.0**-53


@dataclass(frozen=True)
class Forest:
    """Node table (at most trees x 2 x psi rows, whatever the input size) and its normaliser."""

    nodes: pd.DataFrame
    psi: int
    trees: int
    seed: int

    def first(self, trees: int) -> Forest:
        """The forest of the first trees: tree seeds depend on the tree number only."""
        return Forest(self.nodes[self.nodes.tree < trees], self.psi, trees, self.seed)


def _unit_hash(*columns: Column) -> Column:
    """Uniform [0, 1) from a hash: the same row draws the same number in any partitioning."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 11) * F.lit(_UNIT)


def sample_per_tree(df: DataFrame, keys: Sequence[str], rows: int, trees: int, psi: int, seed: int) -> DataFrame:
    """Sub-samples without replacement: adds `tree` and `draw`, psi rows per tree.

    A round deals all rows to `dealt` trees by hash, enough rows for each; rounds repeat until every
    tree has been dealt to. With many rows one round does and most rows drop out before the shuffle;
    with few rows a round serves a single tree. So about 2 x trees x psi rows are ranked in any case.
    """
    dealt = max(1, min(trees, int(rows // (OVERSAMPLE * psi))))
    rounds = math.ceil(trees / dealt)
    kept_share = min(1.0, OVERSAMPLE * psi * dealt / rows) if dealt == trees else 1.0
    key = [F.col(k) for k in keys]
    drawn = (
        df.withColumn("_round", F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))) if rounds > 1 else F.lit(0))
        .withColumn("draw", _unit_hash(F.lit(seed), F.col("_round"), *key))
        .filter(F.col("draw") < kept_share)
        .withColumn("_place", F.pmod(F.xxhash64(F.lit(seed + 1), F.col("_round"), *key), F.lit(dealt)))
        .withColumn("tree", (F.col("_round") * dealt + F.col("_place")).cast("int"))
        .filter(F.col("tree") < trees)
        .drop("_round", "_place")
    )
    # A fixed partition number: growing is compute-bound, and sizing by bytes would put all trees in a few tasks.
    drawn = drawn.repartition(min(trees, df.sparkSession.sparkContext.defaultParallelism), "tree")
    order = Window.partitionBy("tree").orderBy("draw", *key)
    return drawn.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= psi).drop("_rank")


def _grow(x: np.ndarray, rng: np.random.Generator, depth_limit: int) -> list[tuple]:
    """Random splits until a node is pure, single or at the limit; heap-numbered nodes."""
    nodes = []
    waiting = [(0, 0, x)]
    while waiting:
        node, depth, part = waiting.pop()
        low, high = part.min(axis=0), part.max(axis=0)
        varying = np.flatnonzero(high > low)
        if depth == depth_limit or varying.size == 0:
            nodes.append((node, -1, None, -1, -1, depth, len(part)))
            continue
        feature = int(rng.choice(varying))
        threshold = min(float(rng.uniform(low[feature], high[feature])), float(np.nextafter(high[feature], low[feature])))
        goes_left = part[:, feature] <= threshold
        left, right = 2 * node + 1, 2 * node + 2
        nodes.append((node, feature, threshold, left, right, depth, len(part)))
        waiting += [(right, depth + 1, part[~goes_left]), (left, depth + 1, part[goes_left])]
    return nodes


def fit_forest(
    df: DataFrame,
    features: Sequence[str],
    keys: Sequence[str],
    rows: int,
    trees: int = TREES,
    psi: int = SUBSAMPLE,
    seed: int = SEED,
) -> Forest:
    """Grow all trees in one job. `keys` must identify a row; `rows` is the row count of `df`."""
    size = min(psi, rows)
    depth_limit = math.ceil(math.log2(max(size, 2)))
    features = list(features)

    def grow_tree(sample: pa.Table) -> pa.Table:
        tree = sample["tree"][0].as_py()
        if len(sample) != size:
            raise ValueError(f"tree {tree} drew {len(sample)} of {size} rows; use another seed")
        columns = [sample[c].to_numpy() for c in features]
        x = np.column_stack(columns)[np.lexsort([*columns, sample["draw"].to_numpy()])]
        grown = zip(*_grow(x, np.random.default_rng([seed, tree]), depth_limit))
        node, feature, threshold, left, right, depth, n = grown
        return pa.table([
            pa.array([tree] * len(node), pa.int32()), *[pa.array(v, pa.int32()) for v in (node, feature)],
            pa.array(threshold, pa.float64()), *[pa.array(v, pa.int32()) for v in (left, right, depth)], pa.array(n, pa.int64()),
        ], names=["tree", "node", "feature", "threshold", "left", "right", "depth", "n"])

    wanted = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in features if c not in keys])
    sample = sample_per_tree(wanted, keys, rows, trees, size, seed).select("tree", "draw", *features)
    nodes = sample.groupBy("tree").applyInArrow(grow_tree, NODE_SCHEMA).toPandas()
    if nodes["tree"].nunique() != trees:
        raise ValueError("a tree drew no rows; use another seed")
    return Forest(nodes, size, trees, seed)


def average_path(n: np.ndarray | int) -> np.ndarray:
    """Mean path length of an unsuccessful search among n rows."""
    n = np.asarray(n, dtype=float)
    safe = np.maximum(n, 3)
    long = 2 * (np.log(safe - 1) + np.euler_gamma) - 2 * (safe - 1) / safe
    return np.where(n <= 1, 0.0, np.where(n == 2, 1.0, long))


@dataclass(frozen=True)
class LeafMasks:
    """A forest as bit vectors. Plain arrays, because they are broadcast; some 2 bytes x trees x splits beside the masks.

    `cuts` holds the sorted thresholds of each feature over all trees, so that a value is ranked once for all trees. `places` holds
    per feature a number for every rank and tree; the numbers of a group's features add up to a place in that tree's masks of the
    group. A mask has a bit for each leaf that the group's features leave possible; all groups together leave one. `lengths` gives
    path lengths per tree and word by the binary exponent of that one bit, 0 where the bit is in another word.
    """

    cuts: list[np.ndarray]
    places: list[np.ndarray]
    groups: list[list[int]]
    masks: list[list[list[np.ndarray] | None]]
    lengths: list[list[np.ndarray]]


# Masks a tree may have for a group of features; more would not stay in a core's cache.
GROUP_MASKS = 8192
# Rows walked through all trees at once, for the same reason.
CHUNK = 5000
_EXPONENT = 1023  # of 1.0 as a double


def _leaf_boxes(nodes: dict[str, np.ndarray], features: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of one tree the bounds of each leaf per feature (values above `low`, up to `high`), and path lengths."""
    at = {node: i for i, node in enumerate(nodes["node"].tolist())}
    low, high = np.full((len(at), features), -np.inf), np.full((len(at), features), np.inf)
    # Nodes come in order, and children have larger numbers than their parents.
    for i, (f, threshold, left, right) in enumerate(zip(*[nodes[c].tolist() for c in ("feature", "threshold", "left", "right")])):
        if f >= 0:
            below, above = at[left], at[right]
            low[below] = low[above] = low[i]
            high[below] = high[above] = high[i]
            high[below, f] = low[above, f] = threshold
    leaf = np.flatnonzero(nodes["feature"] < 0)
    return low[leaf], high[leaf], nodes["depth"][leaf] + average_path(nodes["n"][leaf])


def _grouped(sizes: np.ndarray) -> list[list[int]]:
    """Features in groups whose sizes multiply to at most GROUP_MASKS in every tree; `sizes` is (features, trees)."""
    groups: list[tuple[list[int], np.ndarray]] = []
    for f in np.argsort(-sizes.mean(axis=1), kind="stable"):
        if sizes[f].max() == 1:
            continue
        for i, (members, product) in enumerate(groups):
            if (product * sizes[f]).max() <= GROUP_MASKS:
                groups[i] = ([*members, int(f)], product * sizes[f])
                break
        else:
            groups.append(([int(f)], sizes[f]))
    return [members for members, _ in groups]


def _words(possible: np.ndarray) -> np.ndarray:
    """Rows of bits as 64-bit words, shape (words, rows)."""
    packed = np.packbits(possible, axis=1, bitorder="little")
    padded = np.zeros((len(packed), -(-packed.shape[1] // 8) * 8), dtype=np.uint8)
    padded[:, :packed.shape[1]] = packed
    return np.ascontiguousarray(padded.view("<u8").T)


def leaf_masks(forest: Forest, features: int) -> LeafMasks:
    """Bit vectors of all trees, made once on the driver; their size depends on the forest, not on the data."""
    ordered = forest.nodes.sort_values(["tree", "node"])
    columns = {c: ordered[c].to_numpy() for c in ("tree", "node", "feature", "threshold", "left", "right", "depth", "n")}
    trees = [
        {c: v[start:end] for c, v in columns.items()}
        for start, end in itertools.pairwise(np.searchsorted(columns["tree"], np.arange(forest.trees + 1)).tolist())
    ]
    cuts = [np.unique(columns["threshold"][columns["feature"] == f]) for f in range(features)]
    own = {
        (f, t): np.unique(nodes["threshold"][nodes["feature"] == f])
        for t, nodes in enumerate(trees) for f in set(nodes["feature"].tolist()) - {-1}
    }
    sizes = np.ones((features, forest.trees), dtype=np.int64)
    for (f, t), thresholds in own.items():
        sizes[f, t] += len(thresholds)
    groups = _grouped(sizes)
    places = [np.zeros((len(c) + 1, forest.trees), dtype=np.int16) for c in cuts]
    masks, lengths = [[None] * forest.trees for _ in groups], []
    for t, nodes in enumerate(trees):
        low, high, length = _leaf_boxes(nodes, features)
        for members, of_group in zip(groups, masks):
            combined = None
            for f in members:
                thresholds = own.get((f, t))
                if thresholds is None:
                    continue
                # A value is known by how many of the tree's thresholds it is above.
                above = np.arange(len(thresholds) + 1)[:, None]
                first, last = np.searchsorted(thresholds, low[:, f], "right"), np.searchsorted(thresholds, high[:, f])
                words = _words((above >= first) & (above <= last))
                step = 1 if combined is None else combined.shape[1]
                places[f][1:, t] = np.searchsorted(thresholds, cuts[f], "right") * step
                combined = words if combined is None else (words[:, :, None] & combined[:, None, :]).reshape(len(words), -1)
            of_group[t] = None if combined is None else list(combined)
        bit = np.arange(len(length))
        by_exponent = np.zeros((-(-len(length) // 64), _EXPONENT + 64))
        by_exponent[bit // 64, _EXPONENT + bit % 64] = length
        lengths.append(list(by_exponent))
    return LeafMasks(cuts, places, groups, masks, lengths)


def path_lengths(forest: LeafMasks, x: np.ndarray) -> np.ndarray:
    """Path length per tree and row, shape (trees, rows). NaN goes left, as any value that is not above a threshold."""
    out = np.empty((len(forest.lengths), len(x)))
    for start in range(0, len(x), CHUNK):
        values = x[start:start + CHUNK].T
        values = np.where(np.isnan(values), -np.inf, values)
        at = []
        for members in forest.groups:
            place = sum(forest.places[f].take(np.searchsorted(forest.cuts[f], values[f]), axis=0, mode="clip") for f in members)
            at.append(np.ascontiguousarray(place.T))
        for t, by_exponent in enumerate(forest.lengths):
            left = None
            for of_group, place in zip(forest.masks, at):
                if of_group[t] is not None:
                    found = [word.take(place[t], mode="clip") for word in of_group[t]]
                    left = found if left is None else [np.bitwise_and(a, b, out=a) for a, b in zip(left, found)]
            if left is None:
                out[t, start:start + CHUNK] = by_exponent[0][_EXPONENT]
            else:
                exponents = [word.astype(float).view(np.int64) >> 52 for word in left]
                out[t, start:start + CHUNK] = sum(of.take(e, mode="clip") for of, e in zip(by_exponent, exponents))
    return out


def add_scores(
    df: DataFrame, forest: Forest, features: Sequence[str], name: str = "score", prefixes: dict[str, int] | None = None
) -> DataFrame:
    """Add -2^(-E[h] / c(psi)) in [-1, 0]; lower is more anomalous. A narrow pass, no shuffle.

    `prefixes` adds, under further names, the scores of the forest's first trees at no extra walk.
    """
    wanted = {name: forest.trees, **(prefixes or {})}
    normaliser = float(average_path(forest.psi)) or 1.0
    shared = df.sparkSession.sparkContext.broadcast(leaf_masks(forest, len(features)))
    fields = ", ".join(f"{n} double" for n in wanted)

    @F.pandas_udf(fields)
    def score(*columns: pd.Series) -> pd.DataFrame:
        lengths = path_lengths(shared.value, np.column_stack([c.to_numpy(dtype=float) for c in columns]))
        return pd.DataFrame({n: -np.exp2(-lengths[:k].mean(axis=0) / normaliser) for n, k in wanted.items()})

    scored = df.withColumn("_scores", score(*[F.col(c).cast("double") for c in features]))
    return scored.withColumns({n: F.col("_scores")[n] for n in wanted}).drop("_scores")
