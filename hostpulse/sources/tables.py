"""Stage tables, the anomaly report sink, and model tables."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from hostpulse.config import FEATURES
from hostpulse.operators.forest import Forest
from hostpulse.plans.scoring import Scoring

_FOREST_SCHEMA = "tree int, node int, feature int, threshold double, left int, right int, depth int, n long"


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of a table's Parquet files; only listed, not opened."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    return files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]


def write_report(report: DataFrame, stem: str, at: datetime | None = None) -> str:
    """CSV folder `<stem>_<YYYYmmdd_HHMMSS>`. Its part files follow the order of the report, so it
    is written in parallel and reads in order; nothing is gathered into one task."""
    path = f"{stem}_{(at or datetime.now()).strftime('%Y%m%d_%H%M%S')}"
    report.write.option("header", True).csv(path)
    return path


def save_models(spark: SparkSession, result: Scoring, folder: str) -> None:
    """Fitted parameters as small tables; their size depends on the parameters, not on the data."""

    def save(name: str, rows, schema: str) -> None:
        write_table(spark.createDataFrame(rows, schema).coalesce(1), f"{folder}/{name}")

    scaler = result.scaler
    save("scaler", [(c, scaler[f"mean_{c}"], scaler[f"std_{c}"]) for c in FEATURES], "feature string, mean double, std double")
    forest = result.forest
    save("forest", forest.nodes.astype({"threshold": "float64"}), _FOREST_SCHEMA)
    save("forest_meta", [(forest.psi, forest.trees, forest.seed, result.offset, result.secondary)],
         "psi int, trees int, seed long, offset double, secondary string")
    limits = result.limits.asDict()
    save("thresholds", [tuple(limits.values())], ", ".join(f"{c} double" for c in limits))
    if result.svm:
        weights, rho = result.svm
        save("svm", list(weights.items()), "feature string, weight double")
        save("svm_meta", [(rho,)], "offset double")
    if result.dbscan_core is not None:
        write_table(result.dbscan_core, f"{folder}/dbscan_core")


@dataclass(frozen=True)
class Models:
    """Stored models, as `score_with` takes them: `score_with(features, **vars(models))`."""

    scaler: Row
    forest: Forest
    offset: float
    limits: Row
    svm: tuple[dict[str, float], float] | None = None
    dbscan_core: DataFrame | None = None


def load_models(spark: SparkSession, folder: str) -> Models:
    """Scaler moments, forest, score offset, rule thresholds, and the second detector that the run was fitted with."""
    scaler = {}
    for r in read_table(spark, f"{folder}/scaler").collect():
        scaler |= {f"mean_{r['feature']}": r["mean"], f"std_{r['feature']}": r["std"]}
    nodes: pd.DataFrame = read_table(spark, f"{folder}/forest").toPandas()
    meta = read_table(spark, f"{folder}/forest_meta").first()
    limits = read_table(spark, f"{folder}/thresholds").first()
    svm = core = None
    if meta["secondary"] == "ocsvm":
        weights = {r["feature"]: r["weight"] for r in read_table(spark, f"{folder}/svm").collect()}
        svm = (weights, read_table(spark, f"{folder}/svm_meta").first()["offset"])
    else:
        core = read_table(spark, f"{folder}/dbscan_core")
    return Models(Row(**scaler), Forest(nodes, meta["psi"], meta["trees"], meta["seed"]), meta["offset"], limits, svm, core)
