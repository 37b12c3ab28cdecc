"""The full run as named steps over written stage tables; a run can start at any step."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from hostpulse.config import DEDUP_KEYS, SECONDARIES, WINDOW_SECONDS
from hostpulse.operators.cleaning import clean, is_valid, type_columns
from hostpulse.operators.windows import build_features
from hostpulse.plans import eda, report
from hostpulse.plans.scoring import fit_and_score
from hostpulse.operators.labels import union_vs_intersection
from hostpulse.operators.threats import normal_percentiles
from hostpulse.sources.csv_logs import FILE_ORDER, parse_lines, rejected, scan_folder
from hostpulse.sources.tables import read_table, save_models, stored_bytes, write_report, write_table

# The names of the steps and, below, of their tables.
STEPS = ["ingestion", "preprocessing", "eda", "feature_engineering", "modelling", "reporting"]


@dataclass
class RunResult:
    """What a run produced: counters, profile and report tables (lazy), and the report path."""

    counters: dict[str, int] = field(default_factory=dict)
    profile: dict[str, DataFrame] = field(default_factory=dict)
    summary: dict[str, DataFrame] = field(default_factory=dict)
    sensitivity: list = field(default_factory=list)
    report_path: str | None = None


def cleaning_counters(raw: DataFrame) -> DataFrame:
    """One row: rows read, dropped as invalid, dropped as duplicates, kept."""
    typed = type_columns(raw).select(*DEDUP_KEYS)
    groups = typed.groupBy(*DEDUP_KEYS).agg(F.count(F.lit(1)).alias("n"))
    valid = F.sum(F.when(is_valid(), F.col("n")).otherwise(0))
    kept = F.count_if(is_valid())
    return groups.agg(
        F.sum("n").alias("rows_in"), (F.sum("n") - valid).alias("dropped_invalid"),
        (valid - kept).alias("dropped_duplicates"), kept.alias("kept"),
    )


def rows_per_file(raw: DataFrame) -> DataFrame:
    return raw.groupBy("_source_file").agg(F.count(F.lit(1)).alias("rows"))


def run(
    spark: SparkSession,
    raw_folder: str,
    out_folder: str,
    start_from: str = "ingestion",
    window_seconds: int = WINDOW_SECONDS,
    run_sensitivity: bool = True,
    secondary: str = SECONDARIES[0],
) -> RunResult:
    """Each step writes its table and the next one reads it, so a lost or changed run resumes anywhere."""
    if start_from not in STEPS:
        raise ValueError(f"unknown step {start_from!r}; choose from {STEPS}")
    active = STEPS[STEPS.index(start_from):]
    raw, cleaned, features, scored, models = (
        f"{out_folder}/{name}" for name in ("raw_logs", "clean_logs", "features", "scored", "models")
    )
    result = RunResult()

    def write_counted(df: DataFrame, path: str, *metrics) -> None:
        observed = Observation()
        write_table(df.observe(observed, *metrics), path)
        result.counters |= observed.get

    def rows(name: str):
        return F.count(F.lit(1)).alias(name)

    if "ingestion" in active:
        lines, files = scan_folder(spark, raw_folder)
        write_counted(parse_lines(lines, files, raw_folder), raw, rows("raw_rows"))
        write_counted(rejected(files), f"{out_folder}/rejected_files", rows("rejected_files"))
        write_table(rows_per_file(read_table(spark, raw)), f"{out_folder}/rows_per_file")
        read = files.where("reason is null").agg(F.sum("length")).first()[0]
        stored = stored_bytes(spark, raw)
        result.counters |= {"csv_bytes": read, "raw_bytes": stored, "csv_to_raw_ratio": read / stored}
    if "preprocessing" in active:
        seen = Observation()
        kept = clean(read_table(spark, raw), FILE_ORDER, counters=seen)
        write_counted(kept.sortWithinPartitions("ts"), cleaned, rows("clean_rows"))
        result.counters |= seen.get
        result.counters["dropped_duplicates"] = seen.get["valid_rows"] - result.counters["clean_rows"]
    if "eda" in active:
        for name, made in eda.profile(read_table(spark, cleaned)).items():
            write_table(made, f"{out_folder}/profile/{name}")
            result.profile[name] = read_table(spark, f"{out_folder}/profile/{name}")
    if "feature_engineering" in active:
        made = build_features(read_table(spark, cleaned), window_seconds).sortWithinPartitions("host", "window_start")
        write_counted(made, features, rows("windows"))
    if "modelling" in active:
        fitted = fit_and_score(read_table(spark, features), run_sensitivity, secondary=secondary)
        write_counted(
            fitted.scored, scored,
            F.count_if(F.col("label_if") == -1).alias("anomalies_if"),
            F.count_if(F.col("label_secondary") == -1).alias("anomalies_secondary"),
            F.count_if(F.col("label_combined") == -1).alias("anomalies_combined"),
        )
        save_models(spark, fitted, models)
        result.sensitivity = fitted.sensitivity
    if "reporting" in active:
        table = read_table(spark, scored)
        result.summary = report.summary(table) | {
            "overlap": union_vs_intersection(table), "normal_percentiles": normal_percentiles(table),
        }
        result.report_path = write_report(report.anomaly_report(table), f"{out_folder}/anomaly_report")
    return result
