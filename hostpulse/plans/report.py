"""Report tables over the scored windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from hostpulse.config import REPORT_COLUMNS
from hostpulse.functions.numeric import half_even, percent
from hostpulse.operators.labels import flagged


def anomalies(scored: DataFrame) -> DataFrame:
    return scored.filter(flagged("label_combined"))


def overview(scored: DataFrame) -> DataFrame:
    total, bad = F.count(F.lit(1)), F.count_if(flagged("label_combined"))
    return scored.agg(total.alias("total"), (total - bad).alias("normal"), bad.alias("anomalous")).select(
        "*",
        half_even(percent(F.col("normal"), F.col("total")), 1).alias("normal_pct"),
        half_even(percent(F.col("anomalous"), F.col("total")), 1).alias("anomalous_pct"),
    )


def score_range(scored: DataFrame) -> DataFrame:
    return scored.groupBy("label_combined").agg(
        F.min("anomaly_score_if").alias("min_score"),
        F.max("anomaly_score_if").alias("max_score"),
        F.avg("anomaly_score_if").alias("mean_score"),
    )


def type_distribution(scored: DataFrame) -> DataFrame:
    bad = anomalies(scored)
    counts = bad.groupBy("anomaly_type").agg(F.count(F.lit(1)).alias("count"))
    total = counts.agg(F.sum("count")).scalar()
    return counts.withColumn("pct", half_even(percent(F.col("count"), total), 1)).orderBy(F.desc("count"), "anomaly_type")


def top_hosts(scored: DataFrame, k: int = 15) -> DataFrame:
    """Hosts by highest risk; `type` is that of the host's earliest anomalous window."""
    return (
        anomalies(scored)
        .groupBy("host")
        .agg(
            F.count(F.lit(1)).alias("anom_windows"),
            F.max("risk_score_100").alias("max_risk"),
            F.sum("req_count").alias("total_reqs"),
            F.min_by("anomaly_type", "window_start").alias("type"),
        )
        .orderBy(F.desc("max_risk"), "host")
        .limit(k)
    )


def features_by_type(scored: DataFrame) -> DataFrame:
    return (
        anomalies(scored)
        .groupBy("anomaly_type")
        .agg(
            half_even(F.avg("req_count"), 1).alias("avg_req"),
            half_even(F.avg("unique_urls"), 1).alias("avg_urls"),
            half_even(F.avg("error_4xx_rate"), 3).alias("avg_4xx"),
            half_even(F.avg("bot_ua_rate"), 3).alias("avg_bot"),
        )
        .orderBy(F.desc("avg_req"), "anomaly_type")
    )


def anomaly_report(scored: DataFrame) -> DataFrame:
    """Anomalous windows, most anomalous first; only the report columns that exist."""
    columns = [c for c in REPORT_COLUMNS if c in scored.columns]
    return anomalies(scored).select(*columns).orderBy("anomaly_score_if", "host", "window_start")


def summary(scored: DataFrame) -> dict[str, DataFrame]:
    return {
        "overview": overview(scored),
        "score_range": score_range(scored),
        "type_distribution": type_distribution(scored),
        "top_hosts": top_hosts(scored),
        "features_by_type": features_by_type(scored),
        "anomaly_report": anomaly_report(scored),
    }
