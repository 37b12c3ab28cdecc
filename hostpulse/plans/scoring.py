"""Fit both detectors on a feature table and score every window."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Row, functions as F

from hostpulse.config import (
    CONTAMINATION, DBSCAN_EPS, DBSCAN_MIN_POINTS, FEATURES, SECONDARIES, SEED, SVM_ORIGIN, SWEEP, SWEEP_TREES, TREES,
)
from hostpulse.operators.dbscan import dbscan_noise, near_core
from hostpulse.operators.forest import Forest, add_scores, fit_forest
from hostpulse.operators.labels import label_if, risk_score, union_label, union_vs_intersection
from hostpulse.operators.ocsvm import Model as SvmModel, below, solve, with_offsets
from hostpulse.operators.quantiles import quantiles
from hostpulse.operators.scaling import moments, standardise
from hostpulse.operators.threats import classify, thresholds
from hostpulse.session import materialise

KEYS = ["host", "window_start"]
Z = [f"z_{c}" for c in FEATURES]


@dataclass(frozen=True)
class Scoring:
    """A scored table and everything fitted on the way. `scored` is lazy over a written table."""

    scored: DataFrame
    scaler: Row
    forest: Forest
    offset: float
    limits: Row
    secondary: str
    svm: SvmModel | None = None
    dbscan_core: DataFrame | None = None
    sensitivity: list[Row] = field(default_factory=list)

    def overlap(self) -> DataFrame:
        return union_vs_intersection(self.scored)


def fit_svms(z: DataFrame, rows: int, nus: Sequence[float], seed: int = SEED, origin: float = SVM_ORIGIN) -> dict[float, SvmModel]:
    """One-class SVMs per nu, as weights and offset over the standardised columns.

    A linear one-class SVM parts the rows from an origin and flags those on its side. Around the mean (`origin` 0) the optimum is
    w = 0, and from the corner of no activity it would flag the quietest windows. So rows are seen from a corner `origin`
    deviations above the mean in every feature, and the nu share on the side of that corner is flagged.
    """
    seen = z.select(*KEYS, *[(F.lit(origin) - F.col(c)).alias(c) for c in Z])
    solved = solve(seen, Z, KEYS, rows, nus, seed)
    return with_offsets(z, {nu: {c: -w for c, w in weights.items()} for nu, (weights, _) in solved.items()}, rows)


def fit_and_score(
    features: DataFrame,
    run_sensitivity: bool = True,
    contamination: float = CONTAMINATION,
    trees: int = TREES,
    seed: int = SEED,
    secondary: str = SECONDARIES[0],
    svm_origin: float = SVM_ORIGIN,
    eps: float = DBSCAN_EPS,
    min_points: int = DBSCAN_MIN_POINTS,
    sweep: Sequence[float] = SWEEP,
    sweep_trees: int = SWEEP_TREES,
) -> Scoring:
    """Feature table in, scored table and models out. `features` should be a written table.

    `secondary` names the second detector, "ocsvm" or "dbscan", whatever the size of the input.

    Jobs: moments; forest (one group per tree); second model; one written scoring pass; one quantile
    pass; one thresholds pass. Only fitted parameters come to the driver.
    """
    if secondary not in SECONDARIES:
        raise ValueError(f"unknown second detector {secondary!r}; choose from {SECONDARIES}")
    scaler = moments(features, FEATURES).first()
    rows = scaler["n"]
    if not rows:
        raise ValueError("no windows to score")
    z = standardise(features, FEATURES, scaler)
    forest = fit_forest(z, Z, KEYS, rows, trees, seed=seed)

    nus = sorted({contamination, *sweep}) if run_sensitivity else [contamination]
    core = None
    svms = fit_svms(z, rows, nus, seed, svm_origin) if run_sensitivity or secondary == "ocsvm" else {}
    scored = add_scores(z, forest, Z, "_score", {"_sweep_score": sweep_trees} if run_sensitivity else None)
    if secondary == "dbscan":
        scored, core = dbscan_noise(scored, Z, eps, min_points)
    else:
        scored = scored.withColumn("label_secondary", label_if(below(svms[contamination])))
    if run_sensitivity:
        scored = scored.withColumns({f"_svm_{i}": below(svms[nu]) for i, nu in enumerate(sweep)})
    scored = materialise(scored.drop(*Z), "scored")

    wanted = {"_score": [contamination]}
    if run_sensitivity:
        wanted["_sweep_score"] = list(sweep)
    cuts = quantiles(scored, wanted)
    offset = cuts["_score"][0]
    swept = sensitivity(scored, sweep, cuts["_sweep_score"]) if run_sensitivity else []

    labelled = scored.select(
        *features.columns,
        F.col("_score").cast("float").alias("anomaly_score_if"),
        risk_score("_score").cast("float").alias("risk_score_100"),
        label_if(F.col("_score") < offset).alias("label_if"),
        "label_secondary",
    ).withColumn("label_combined", union_label())
    limits = thresholds(labelled).first()
    return Scoring(
        classify(labelled, limits), scaler, forest, offset, limits, secondary,
        svms.get(contamination) if secondary == "ocsvm" else None,
        core,
        swept,
    )


def sensitivity(scored: DataFrame, sweep: Sequence[float], cuts: Sequence[float]) -> list[Row]:
    """Counts per contamination in one pass. One forest serves all: contamination moves only its cut-off.

    The second detector here is always the one-class SVM, whichever one labels the windows.
    """
    counts = [F.count(F.lit(1)).alias("n")]
    for i, cut in enumerate(cuts):
        a, b = F.col("_sweep_score") < cut, F.col(f"_svm_{i}")
        counts += [
            F.count_if(a).alias(f"n_if_{i}"), F.count_if(b).alias(f"n_svm_{i}"),
            F.count_if(a | b).alias(f"n_union_{i}"), F.count_if(a & b).alias(f"n_intersection_{i}"),
        ]
    found = scored.agg(*counts).first()
    fields = Row("contamination", "n_if", "if_pct", "n_svm", "svm_pct", "n_union", "union_pct", "n_intersection")
    share = lambda name: found[name] / found["n"] * 100
    return [
        fields(
            c, found[f"n_if_{i}"], share(f"n_if_{i}"), found[f"n_svm_{i}"], share(f"n_svm_{i}"),
            found[f"n_union_{i}"], share(f"n_union_{i}"), found[f"n_intersection_{i}"],
        )
        for i, c in enumerate(sweep)
    ]


def score_with(
    features: DataFrame, scaler: Row, forest: Forest, offset: float, limits: Row,
    svm: SvmModel | None = None, dbscan_core: DataFrame | None = None, eps: float = DBSCAN_EPS,
) -> DataFrame:
    """Scores, both labels, their union and the threat type for windows against fitted models.

    A narrow pass with a stored SVM; stored DBSCAN core points are met by a join on grid cells.
    """
    if (svm is None) == (dbscan_core is None):
        raise ValueError("give the SVM or the DBSCAN core points")
    scored = add_scores(standardise(features, FEATURES, scaler), forest, Z, "_score")
    if svm is not None:
        scored = scored.withColumn("label_secondary", label_if(below(svm)))
    else:
        scored = near_core(scored, dbscan_core, Z, eps)
    labelled = scored.select(
        *features.columns,
        F.col("_score").cast("float").alias("anomaly_score_if"),
        risk_score("_score").cast("float").alias("risk_score_100"),
        label_if(F.col("_score") < offset).alias("label_if"),
        "label_secondary",
    ).withColumn("label_combined", union_label())
    return classify(labelled, limits)
