"""Labels (-1 anomalous, 1 normal), their union, and the risk score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from hostpulse.functions.numeric import clamp, percent


def label_if(anomalous: Column) -> Column:
    return F.when(anomalous, -1).otherwise(1).cast("tinyint")


def flagged(column: str) -> Column:
    return F.col(column) == -1


def union_label(first: str = "label_if", second: str = "label_secondary") -> Column:
    return label_if(flagged(first) | flagged(second))


def risk_score(score: str = "anomaly_score_if") -> Column:
    return clamp(-100 * F.col(score), 0.0, 100.0)


def union_vs_intersection(labelled: DataFrame) -> DataFrame:
    """One row comparing the two detectors: counts and percents of all rows."""
    a, b = flagged("label_if"), flagged("label_secondary")
    counts = labelled.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(a & ~b).alias("only_if"),
        F.count_if(b & ~a).alias("only_secondary"),
        F.count_if(a & b).alias("intersection"),
        F.count_if(a | b).alias("union"),
    )
    return counts.select(
        "*",
        percent(F.col("only_if"), F.col("n")).alias("only_if_pct"),
        percent(F.col("only_secondary"), F.col("n")).alias("only_secondary_pct"),
        percent(F.col("intersection"), F.col("n")).alias("intersection_pct"),
        percent(F.col("union"), F.col("n")).alias("union_pct"),
        (F.col("only_secondary") / F.greatest(F.col("union"), F.lit(1)) * 100).alias("lost_by_intersection_pct"),
    )
