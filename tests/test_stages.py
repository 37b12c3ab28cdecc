import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from hostpulse import adapters
from hostpulse.config import FEATURES, REPORT_COLUMNS
from hostpulse.operators.threats import classify
from hostpulse.plans import report, stages
from hostpulse.plans.scoring import fit_and_score, score_with
from hostpulse.sources.tables import load_models, read_table, save_models

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def finished(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("run")
    raw = adapters.write_mixed_csv(spark, SF, str(base / "csv"))
    return raw, str(base / "out"), stages.run(spark, raw, str(base / "out"), window_seconds=86400)


def test_counters_add_up(finished):
    counters = finished[2].counters
    assert counters["raw_rows"] == counters["rows_in"] > counters["valid_rows"] > counters["clean_rows"] > counters["windows"]
    assert counters["anomalies_combined"] >= max(counters["anomalies_if"], counters["anomalies_secondary"]) > 0


def test_sensitivity_rows(finished):
    table = finished[2].sensitivity
    assert [r.contamination for r in table] == [0.01, 0.03, 0.05, 0.07, 0.10]
    assert [r.n_if for r in table] == sorted(r.n_if for r in table)
    for r in table:
        assert r.n_union + r.n_intersection == r.n_if + r.n_svm


def test_scored_table(spark, finished):
    scored = read_table(spark, f"{finished[1]}/scored")
    types = dict(scored.dtypes)
    assert types["anomaly_score_if"] == types["risk_score_100"] == "float"
    assert types["label_if"] == types["label_secondary"] == types["label_combined"] == "tinyint"
    n = scored.count()
    assert abs(scored.filter("label_if = -1").count() - 0.05 * n) <= 1
    assert scored.filter("(label_combined = -1) <> (label_if = -1 or label_secondary = -1)").count() == 0
    assert scored.filter("(anomaly_type = 'normal') <> (label_combined = 1)").count() == 0
    assert scored.filter("abs(risk_score_100 + 100 * anomaly_score_if) > 1e-3").count() == 0


def test_report_files_are_in_order(spark, finished):
    path = finished[2].report_path
    assert re.search(r"anomaly_report_\d{8}_\d{6}$", path)
    parts = sorted(Path(path).glob("part-*.csv"))
    rows = [line.split(",") for part in parts for line in part.read_text().splitlines()[1:]]
    assert parts[0].read_text().splitlines()[0].split(",") == REPORT_COLUMNS
    scores = [float(r[REPORT_COLUMNS.index("anomaly_score_if")]) for r in rows]
    assert scores == sorted(scores) and len(scores) == finished[2].counters["anomalies_combined"]


def test_sizes_are_counted(finished):
    counters, base = finished[2].counters, Path(finished[1]).parent
    used = [f for f in (base / "csv").glob("*.csv") if not f.name.startswith("narrow")]
    assert counters["csv_bytes"] == sum(f.stat().st_size for f in used)
    assert counters["raw_bytes"] == sum(f.stat().st_size for f in Path(finished[1]).glob("raw_logs/*.parquet"))
    assert counters["csv_to_raw_ratio"] == counters["csv_bytes"] / counters["raw_bytes"] > 1


def test_tables_of_the_summary(finished):
    summary, profile = finished[2].summary, finished[2].profile
    assert summary["overview"].first().anomalous == finished[2].counters["anomalies_combined"]
    assert summary["type_distribution"].agg(F.sum("count")).first()[0] == finished[2].counters["anomalies_combined"]
    assert summary["top_hosts"].count() <= 15
    assert profile["overview"].first().records == finished[2].counters["clean_rows"]
    assert {r.label_combined for r in summary["score_range"].collect()} == {-1, 1}


@pytest.mark.parametrize("step", ["feature_engineering", "modelling", "reporting"])
def test_restart_gives_the_same_result(spark, finished, step):
    raw, out, _ = finished
    before = read_table(spark, f"{out}/scored").select("host", "window_start", "label_combined", "anomaly_type").collect()
    again = stages.run(spark, raw, out, step, window_seconds=86400, run_sensitivity=False)
    after = read_table(spark, f"{out}/scored").select("host", "window_start", "label_combined", "anomaly_type").collect()
    assert sorted(before) == sorted(after)
    assert "raw_rows" not in again.counters


def test_unknown_step(spark):
    with pytest.raises(ValueError, match="unknown step"):
        stages.run(spark, "in", "out", "training")


def test_stored_models_score_alike(spark, finished):
    out = finished[1]
    scored = read_table(spark, f"{out}/scored")
    models = load_models(spark, f"{out}/models")
    again = score_with(read_table(spark, f"{out}/features"), **vars(models))
    keys = ["host", "window_start"]
    both = scored.alias("a").join(again.alias("b"), keys)
    assert both.count() == scored.count()
    same = ["anomaly_score_if", "label_if", "label_secondary", "label_combined", "anomaly_type"]
    assert both.filter(" or ".join(f"a.{c} <> b.{c}" for c in same)).count() == 0
    relabelled = classify(scored.drop("anomaly_type"), models.limits)
    assert relabelled.exceptAll(scored).count() == 0
    assert read_table(spark, f"{out}/models/scaler").count() == len(FEATURES)


def test_the_second_detector_is_chosen_by_name_at_any_size(spark, finished, tmp_path):
    features = read_table(spark, f"{finished[1]}/features")
    for rows in (features.limit(300), features):
        svm = fit_and_score(rows, run_sensitivity=False, trees=20)
        assert svm.secondary == "ocsvm" and svm.svm is not None and svm.dbscan_core is None
    flagged = svm.scored.filter("label_secondary = -1").count()
    assert 0 < flagged <= 0.05 * features.count()
    cells = fit_and_score(features, run_sensitivity=False, trees=20, secondary="dbscan")
    assert cells.secondary == "dbscan" and cells.dbscan_core.count() > 0
    assert cells.overlap().first().n == features.count()
    save_models(spark, cells, str(tmp_path))
    again = score_with(features, **vars(load_models(spark, str(tmp_path))))
    label = ["host", "window_start", "label_secondary"]
    assert again.select(label).exceptAll(cells.scored.select(label)).count() == 0
    with pytest.raises(ValueError, match="unknown second detector"):
        fit_and_score(features, secondary="kmeans")


def test_report_without_anomalies(spark, finished):
    scored = read_table(spark, f"{finished[1]}/scored").filter("label_combined = 1")
    row = report.overview(scored).first()
    assert row.anomalous == 0 and row.anomalous_pct == 0.0
    assert report.type_distribution(scored).count() == report.anomaly_report(scored).count() == 0
    empty = report.overview(scored.filter(F.lit(False))).first()
    assert empty.total == 0 and empty.normal_pct is None


def test_report_reads_only_its_columns(spark, finished):
    scored = read_table(spark, f"{finished[1]}/scored")
    plan = report.type_distribution(scored)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<label_combined:tinyint,anomaly_type:string>" in plan
    assert "EqualTo(label_combined,-1)" in plan
