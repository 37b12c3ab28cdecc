"""Data-driven thresholds and the threat type rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, functions as F

from hostpulse.config import (
    BOT, FLOOD, FLOOD_URL_RATIO, HIGH_VOLUME, HIGH_VOLUME_FACTOR, LOW_VOLUME, NORMAL, RATE_CAP, SCAN, SCRAPER,
    SCRAPER_URL_RATIO, SMALLEST_POSITIVE, THRESHOLD_MARGIN, THRESHOLD_QUANTILE,
)
from hostpulse.functions.numeric import half_even
from hostpulse.operators.labels import flagged
from hostpulse.operators.quantiles import quantiles

THRESHOLD_COLUMNS = ["req_count", "unique_urls", "error_4xx_rate", "bot_ua_rate"]
PROFILE_QUANTILES = [0.5, 0.9, 0.99, 0.999]


def normal_rows(labelled: DataFrame) -> DataFrame:
    return labelled.filter(F.col("label_combined") == 1)


def normal_percentiles(labelled: DataFrame) -> DataFrame:
    """p50/p90/p99/p99.9 of the four rule features over normal rows: one row per feature. Reads its input in several passes."""
    found = quantiles(normal_rows(labelled), {c: PROFILE_QUANTILES for c in THRESHOLD_COLUMNS})
    values = [F.array(*[F.lit(v).cast("double") for v in found[c]]).alias(c) for c in THRESHOLD_COLUMNS]
    wide = labelled.sparkSession.range(1).select(*values)
    names = ["p50", "p90", "p99", "p99_9"]
    rows_out = F.array(*[
        F.struct(F.lit(c).alias("feature"), *[F.col(c)[i].alias(n) for i, n in enumerate(names)])
        for c in THRESHOLD_COLUMNS
    ])
    return wide.select(F.inline(rows_out))


def _threshold(top: Column, smallest: Column, margin: float, factor: float, cap: float | None) -> Column:
    """Widened top quantile; where that is 0, half the smallest positive value (0.01 if none)."""
    soft = half_even(F.coalesce(smallest, F.lit(SMALLEST_POSITIVE)) * 0.5, 4)
    value = F.when(top == 0, soft).otherwise(half_even(top * margin * factor, 4))
    return F.least(value, F.lit(cap)) if cap is not None else value


def _from_quantiles(source: DataFrame, margin: float) -> DataFrame:
    def of(column: str, factor: float = 1.0, cap: float | None = None) -> Column:
        return _threshold(F.col(f"top_{column}"), F.col(f"min_{column}"), margin, factor, cap)

    return source.select(
        of("bot_ua_rate", cap=RATE_CAP).alias("bot_ua_rate"),
        of("error_4xx_rate", cap=RATE_CAP).alias("error_4xx_rate"),
        of("req_count").alias("req_count_ddos"),
        of("unique_urls").alias("unique_urls_scraper"),
        of("req_count", HIGH_VOLUME_FACTOR).alias("req_count_highvol"),
    )


def thresholds(labelled: DataFrame, quantile: float = THRESHOLD_QUANTILE, margin: float = THRESHOLD_MARGIN) -> DataFrame:
    """One-row table of rule thresholds from the normal rows. Reads its input in several passes: give it a written table."""
    normal = normal_rows(labelled)
    positive = [F.min(F.when(F.col(c) > 0, F.col(c).cast("double"))).alias(f"min_{c}") for c in THRESHOLD_COLUMNS]
    found = quantiles(normal, {c: [quantile] for c in THRESHOLD_COLUMNS})
    tops = [F.lit(found[c][0]).cast("double").alias(f"top_{c}") for c in THRESHOLD_COLUMNS]
    return _from_quantiles(normal.agg(*positive).select(*tops, "*"), margin)


def classify(labelled: DataFrame, limits: DataFrame | Row) -> DataFrame:
    """Add anomaly_type: the first rule that matches. `limits` is the thresholds table or its row."""
    if isinstance(limits, Row):
        source, limit = labelled, {c: F.lit(limits[c]).cast("double") for c in limits.asDict()}
    else:
        packed = limits.select(F.struct(*limits.columns)).scalar()
        source = labelled.withColumn("_limits", packed)
        limit = {c: F.col("_limits")[c] for c in limits.columns}
    url_ratio = F.col("unique_urls") / F.greatest(F.col("req_count"), F.lit(1))
    kind = (
        F.when(~flagged("label_combined"), NORMAL)
        .when(F.col("bot_ua_rate") > limit["bot_ua_rate"], BOT)
        .when(F.col("error_4xx_rate") > limit["error_4xx_rate"], SCAN)
        .when((F.col("req_count") > limit["req_count_ddos"]) & (url_ratio < FLOOD_URL_RATIO), FLOOD)
        .when((F.col("unique_urls") > limit["unique_urls_scraper"]) | (url_ratio > SCRAPER_URL_RATIO), SCRAPER)
        .when(F.col("req_count") > limit["req_count_highvol"], HIGH_VOLUME)
        .otherwise(LOW_VOLUME)
    )
    return source.withColumn("anomaly_type", kind).drop("_limits")
