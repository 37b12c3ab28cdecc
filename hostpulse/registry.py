"""Named queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from hostpulse import adapters
from hostpulse.config import FEATURES, LOG_COLUMNS, SWEEP, WINDOW_SECONDS
from hostpulse.operators.cleaning import clean, type_columns
from hostpulse.operators.dbscan import dbscan_clusters, dbscan_noise
from hostpulse.operators.forest import add_scores, fit_forest
from hostpulse.operators.heavy import top_k
from hostpulse.operators.labels import label_if, union_vs_intersection
from hostpulse.operators.ocsvm import Model as SvmModel, below, certificate, with_offsets
from hostpulse.operators.quantiles import quantiles
from hostpulse.operators.rollups import RELATIVE_ERROR, hourly, roll_up
from hostpulse.operators.scaling import moments, scaler_table, standardise
from hostpulse.operators.threats import classify, normal_percentiles, thresholds
from hostpulse.operators.windows import build_features
from hostpulse.plans import eda, incremental, report, stages
from hostpulse.plans.scoring import KEYS, Z, Scoring, fit_and_score, fit_svms, score_with, sensitivity
from hostpulse.session import materialise, scratch_path
from hostpulse.sources.csv_logs import detect_dialects, read_log_folder, rejected_files
from hostpulse.sources.tables import load_models, read_table, save_models, write_report

Query = Callable[[SparkSession, str], DataFrame]
DAY = 86_400
_FRACTIONS = {
    "error_4xx_rate", "error_5xx_rate", "avg_bytes", "bytes_std", "bot_ua_rate", "anomaly_score_if", "risk_score_100",
    "mean", "std", "p50", "p90", "p99", "p99_9", "min_score", "max_score", "mean_score", "max_risk", "only_if_pct",
    "only_secondary_pct", "intersection_pct", "union_pct", "lost_by_intersection_pct", "objective", "dual", "gap", "share_below",
    "score", "if_pct", "svm_pct", "union_pct",
}
#: Width of the `embedding` column; all of it is used.
DIMENSIONS = 64
_EMBEDDED = [f"e{i}" for i in range(DIMENSIONS)]


def rounded(df: DataFrame) -> DataFrame:
    """Six digits on fractional columns, so that two engines' summation orders compare equal."""
    wanted = [c for c in df.columns if c in _FRACTIONS or c.startswith("z_")]
    return df.withColumns({c: F.round(c, 6) for c in wanted}) if wanted else df


def _clean(spark: SparkSession, sf: str) -> DataFrame:
    return clean(adapters.raw_log(spark, sf), adapters.ROW_ORDER)


def _features(spark: SparkSession, sf: str, seconds: int) -> DataFrame:
    return build_features(_clean(spark, sf), seconds)


def _feature_table(spark: SparkSession, sf: str, seconds: int) -> DataFrame:
    """Features as a written stage table, for queries that read them more than once."""
    return materialise(_features(spark, sf, seconds), f"features-{seconds}")


def _labelled(spark: SparkSession, sf: str) -> DataFrame:
    return adapters.stand_in_scores(_feature_table(spark, sf, DAY))


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    labelled = _labelled(spark, sf)
    return classify(labelled, thresholds(labelled))


def _z(spark: SparkSession, sf: str, seconds: int) -> tuple[DataFrame, int]:
    features = _feature_table(spark, sf, seconds)
    model = moments(features, FEATURES).first()
    return standardise(features, FEATURES, model).select(*KEYS, *Z), model["n"]


def _fit(spark: SparkSession, sf: str, run_sensitivity: bool = False, secondary: str = "ocsvm") -> Scoring:
    return fit_and_score(_feature_table(spark, sf, WINDOW_SECONDS), run_sensitivity, secondary=secondary)


def _embeddings(spark: SparkSession, sf: str) -> DataFrame:
    table = spark.read.parquet(f"{sf}/embeddings.parquet")
    return table.select("vec_id", *[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(_EMBEDDED)])


def _csv_folder(spark: SparkSession, sf: str) -> str:
    return adapters.write_mixed_csv(spark, sf, scratch_path(spark, "csv"))


def ingest_mixed_dialects(spark: SparkSession, sf: str) -> DataFrame:
    raw = read_log_folder(spark, _csv_folder(spark, sf))
    return raw.select(*LOG_COLUMNS, F.regexp_extract("_source_file", "^[a-z]+", 0).alias("_source_file"))


def csv_dialects(spark: SparkSession, sf: str) -> DataFrame:
    files = detect_dialects(spark, _csv_folder(spark, sf))
    lines = files.groupBy("separator", "encoding", "multi_line").agg(F.sum(F.col("lines") - 1).alias("lines"))
    return lines.where("lines > 0")


def rejected_log_files(spark: SparkSession, sf: str) -> DataFrame:
    left_out = rejected_files(spark, _csv_folder(spark, sf))
    return left_out.groupBy("reason").agg(F.sum(F.col("lines") - 1).alias("rows"))


def standardised_features(spark: SparkSession, sf: str) -> DataFrame:
    features = _feature_table(spark, sf, DAY)
    return standardise(features, FEATURES, moments(features, FEATURES)).select(*KEYS, *Z)


def standardised_embeddings(spark: SparkSession, sf: str) -> DataFrame:
    vectors = _embeddings(spark, sf)
    return standardise(vectors, _EMBEDDED, moments(vectors, _EMBEDDED)).drop(*_EMBEDDED)


def thresholds_by_counting(spark: SparkSession, sf: str) -> DataFrame:
    labelled = _labelled(spark, sf)
    return thresholds(labelled)


def anomaly_report_csv(spark: SparkSession, sf: str) -> DataFrame:
    written = report.anomaly_report(_scored(spark, sf))
    path = write_report(written, scratch_path(spark, "report"))
    return spark.read.schema(written.schema).option("header", True).csv(path)


def dbscan_noise_labels(spark: SparkSession, sf: str) -> DataFrame:
    z, _ = _z(spark, sf, DAY)
    return dbscan_noise(z, Z)[0].select(*KEYS, "label_secondary")


def dbscan_cluster_ids(spark: SparkSession, sf: str) -> DataFrame:
    vectors = _embeddings(spark, sf)
    scaled = standardise(vectors, _EMBEDDED, moments(vectors, _EMBEDDED)).drop(*_EMBEDDED)
    return dbscan_clusters(scaled, [f"z_{c}" for c in _EMBEDDED], "vec_id", eps=9.4).select("vec_id", "cluster")


def isolation_forest_nodes(spark: SparkSession, sf: str) -> DataFrame:
    z, rows = _z(spark, sf, WINDOW_SECONDS)
    forest = fit_forest(z, Z, KEYS, rows)
    return spark.createDataFrame(
        forest.nodes, "tree int, node int, feature int, threshold double, left int, right int, depth int, n long"
    )


def isolation_forest_scores(spark: SparkSession, sf: str) -> DataFrame:
    z, rows = _z(spark, sf, WINDOW_SECONDS)
    return add_scores(z, fit_forest(z, Z, KEYS, rows), Z).select(*KEYS, "score")


def isolation_forest_embeddings(spark: SparkSession, sf: str) -> DataFrame:
    vectors = _embeddings(spark, sf)
    scaled = standardise(vectors, _EMBEDDED, moments(vectors, _EMBEDDED))
    names = [f"z_{c}" for c in _EMBEDDED]
    forest = fit_forest(scaled, names, ["vec_id"], vectors.count())
    return add_scores(scaled, forest, names).select("vec_id", "score")


def ocsvm_labels(spark: SparkSession, sf: str) -> DataFrame:
    z, rows = _z(spark, sf, DAY)
    return z.select(*KEYS, label_if(below(fit_svms(z, rows, [0.05])[0.05])).alias("label_secondary"))


def _given_svm(spark: SparkSession, sf: str, nu: float) -> tuple[DataFrame, SvmModel]:
    z, rows = _z(spark, sf, DAY)
    z = materialise(z, "z")
    return z, with_offsets(z, {nu: adapters.SVM_WEIGHTS}, rows)[nu]


def svm_given_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Labels of an SVM with given weights; its offset is the row value at the nu share."""
    z, model = _given_svm(spark, sf, 0.05)
    return z.select(*KEYS, label_if(below(model)).alias("label_secondary"))


def svm_given_certificate(spark: SparkSession, sf: str) -> DataFrame:
    z, model = _given_svm(spark, sf, 0.05)
    return certificate(z, model, 0.05)


def forest_given_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Scores of three given trees."""
    return add_scores(_z(spark, sf, DAY)[0], adapters.given_forest(), Z).select(*KEYS, "score")


def isolation_forest_shape(spark: SparkSession, sf: str) -> DataFrame:
    """Per grown tree: rows in its leaves, and how many more leaves than splits it has."""
    z, rows = _z(spark, sf, WINDOW_SECONDS)
    nodes = spark.createDataFrame(fit_forest(z, Z, KEYS, rows).nodes[["tree", "feature", "n"]])
    leaf = F.col("feature") < 0
    return nodes.groupBy("tree").agg(
        F.sum(F.when(leaf, F.col("n"))).alias("leaf_rows"), (F.count_if(leaf) - F.count_if(~leaf)).alias("leaves_over_splits")
    )


def scored_with_given_models(spark: SparkSession, sf: str) -> DataFrame:
    """Given models stored as tables, loaded again, and applied."""
    features = _feature_table(spark, sf, DAY)
    folder = scratch_path(spark, "models")
    given = Scoring(
        features, moments(features, FEATURES).first(), adapters.given_forest(), adapters.FOREST_CUT, Row(**adapters.LIMITS), "ocsvm",
        (adapters.SVM_WEIGHTS, adapters.SVM_OFFSET),
    )
    save_models(spark, given, folder)
    return score_with(features, **vars(load_models(spark, folder))).withColumns(
        {c: F.col(c).cast("double") for c in ("anomaly_score_if", "risk_score_100")}
    )


def sensitivity_given(spark: SparkSession, sf: str) -> DataFrame:
    """The sweep over stand-in scores and an SVM of given weights: cut-offs, flags and overlaps per contamination."""
    z, rows = _z(spark, sf, DAY)
    scores = _labelled(spark, sf).select(*KEYS, F.col("anomaly_score_if").alias("_sweep_score"))
    models = with_offsets(z, {nu: adapters.SVM_WEIGHTS for nu in SWEEP}, rows)
    flags = z.select(*KEYS, *[below(models[nu]).alias(f"_svm_{i}") for i, nu in enumerate(SWEEP)])
    scored = materialise(scores.join(flags, KEYS), "swept")
    return spark.createDataFrame(sensitivity(scored, SWEEP, quantiles(scored, {"_sweep_score": SWEEP})["_sweep_score"]))


def sensitivity_sweep(spark: SparkSession, sf: str) -> DataFrame:
    return spark.createDataFrame(_fit(spark, sf, run_sensitivity=True).sensitivity)


def scored_with_stored_models(spark: SparkSession, sf: str) -> DataFrame:
    """Fit, store the models as tables, load them again, and score with what was loaded."""
    features = _feature_table(spark, sf, WINDOW_SECONDS)
    folder = scratch_path(spark, "models")
    save_models(spark, fit_and_score(features, run_sensitivity=False), folder)
    return score_with(features, **vars(load_models(spark, folder)))


def full_run(spark: SparkSession, sf: str) -> DataFrame:
    """CSV folder to scored table through all written stages."""
    out = scratch_path(spark, "run")
    stages.run(spark, _csv_folder(spark, sf), out, run_sensitivity=False)
    return read_table(spark, f"{out}/scored")


def _grown_state(spark: SparkSession, sf: str) -> str:
    """Two incremental runs: the second delivery comes first, so the later run replaces rows of every day."""
    out = scratch_path(spark, "state")
    for delivery in ("b", "a"):
        incremental.update(spark, adapters.write_delivery(spark, sf, delivery, scratch_path(spark, f"csv-{delivery}")), out, DAY)
    return out


def incremental_clean(spark: SparkSession, sf: str) -> DataFrame:
    rows = incremental.cleaned(spark, _grown_state(spark, sf))
    return rows.withColumn("_source_file", F.regexp_replace("_source_file", "-[0-9]+", ""))


def incremental_features(spark: SparkSession, sf: str) -> DataFrame:
    return incremental.features(spark, _grown_state(spark, sf)).select("host", "window_start", *FEATURES)


def heavy_resources(spark: SparkSession, sf: str) -> DataFrame:
    """The most frequent resources by summaries and an exact recount."""
    return top_k(materialise(_clean(spark, sf).select("resource"), "resources"), "resource", 10)


def heavy_stamps(spark: SparkSession, sf: str) -> DataFrame:
    """The most frequent pairs of agent and second, of which there are about as many as requests."""
    pair = F.concat_ws(" ", "user_agent", F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("pair")
    return top_k(materialise(_clean(spark, sf).select(pair), "pairs"), "pair", 10, counters=1000)


def distinct_roll_up(spark: SparkSession, sf: str) -> DataFrame:
    """Per day requests and exact distinct resources, and whether the merged hourly sketches are within four deviations."""
    cleaned = materialise(_clean(spark, sf).select("host", "ts", "resource"), "resources")
    day = F.to_date("hour").cast("string").alias("day")
    exact = cleaned.groupBy(F.to_date("ts").cast("string").alias("day")).agg(
        (F.count_distinct("resource") + F.max(F.col("resource").isNull().cast("int"))).alias("resources")
    )
    both = roll_up(hourly(cleaned, ["resource"]), [day], ["resource"]).join(exact, "day")
    near = F.abs(F.col("resource_distinct") - F.col("resources")) <= 4 * RELATIVE_ERROR * F.col("resources")
    return both.select("day", "requests", "resources", near.alias("near"))


def over(table: Callable[[SparkSession, str], DataFrame], query: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: rounded(query(table(spark, sf)))


def _same(df: DataFrame) -> DataFrame:
    return df


QUERIES: dict[str, Query] = {
    # ingestion and cleaning
    "ingest_mixed_dialects": ingest_mixed_dialects,
    "csv_dialects": csv_dialects,
    "rejected_files": rejected_log_files,
    "rows_per_file": over(adapters.raw_log, stages.rows_per_file),
    "typed_log": over(adapters.raw_log, lambda raw: type_columns(raw).drop("_row_id")),
    "clean_log": over(_clean, _same),
    "cleaning_counters": over(adapters.raw_log, stages.cleaning_counters),
    # traffic profile
    "eda_overview": over(_clean, eda.overview),
    "eda_status_distribution": over(_clean, eda.status_distribution),
    "eda_top_hosts": over(_clean, eda.top_hosts),
    "eda_top_user_agents": over(_clean, eda.top_user_agents),
    "eda_top_resources": over(_clean, eda.top_resources),
    "eda_hourly_load": over(_clean, eda.hourly_load),
    "heavy_resources": heavy_resources,
    "heavy_stamps": heavy_stamps,
    "distinct_roll_up": distinct_roll_up,
    # runs that read new files only
    "incremental_clean": incremental_clean,
    "incremental_features": lambda s, d: rounded(incremental_features(s, d)),
    # features
    "features_60s": over(lambda s, d: _features(s, d, 60), _same),
    "features_1h": over(lambda s, d: _features(s, d, 3600), _same),
    "features_1d": over(lambda s, d: _features(s, d, DAY), _same),
    # scaling, thresholds, rules
    "scaler": over(lambda s, d: _features(s, d, DAY), lambda f: scaler_table(moments(f, FEATURES), FEATURES)),
    "standardised_features": lambda s, d: rounded(standardised_features(s, d)),
    "standardised_embeddings": lambda s, d: rounded(standardised_embeddings(s, d)),
    "normal_percentiles": over(_labelled, normal_percentiles),
    "thresholds": over(_labelled, thresholds),
    "thresholds_by_counting": thresholds_by_counting,
    "union_vs_intersection": over(_labelled, union_vs_intersection),
    "threat_types": over(_scored, _same),
    # detectors
    "isolation_forest_nodes": isolation_forest_nodes,
    "isolation_forest_scores": isolation_forest_scores,
    "isolation_forest_embeddings": isolation_forest_embeddings,
    "dbscan_noise": dbscan_noise_labels,
    "dbscan_clusters": dbscan_cluster_ids,
    "ocsvm_labels": ocsvm_labels,
    "svm_given_labels": svm_given_labels,
    "forest_given_scores": lambda s, d: rounded(forest_given_scores(s, d)),
    "isolation_forest_shape": isolation_forest_shape,
    "scored_with_given_models": lambda s, d: rounded(scored_with_given_models(s, d)),
    "sensitivity_given": lambda s, d: rounded(sensitivity_given(s, d)),
    "svm_given_certificate": lambda s, d: rounded(svm_given_certificate(s, d)),
    "sensitivity_sweep": sensitivity_sweep,
    "scored_windows": lambda s, d: _fit(s, d).scored,
    "scored_windows_dbscan": lambda s, d: _fit(s, d, secondary="dbscan").scored,
    "scored_with_stored_models": scored_with_stored_models,
    "full_run": full_run,
    # report
    "report_overview": over(_scored, report.overview),
    "report_score_range": over(_scored, report.score_range),
    "report_type_distribution": over(_scored, report.type_distribution),
    "report_top_hosts": over(_scored, lambda scored: report.top_hosts(rounded(scored))),
    "report_features_by_type": over(_scored, report.features_by_type),
    "anomaly_report": over(_scored, report.anomaly_report),
    "anomaly_report_csv": lambda s, d: rounded(anomaly_report_csv(s, d)),
}
