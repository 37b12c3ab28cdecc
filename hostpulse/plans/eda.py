"""Traffic profile tables over the clean log."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from hostpulse.functions.numeric import distinct_with_null, half_even, percent


def overview(cleaned: DataFrame) -> DataFrame:
    return cleaned.agg(
        F.count(F.lit(1)).alias("records"),
        distinct_with_null("host").alias("hosts"),
        distinct_with_null("user_agent").alias("user_agents"),
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
        F.sum("is_bot_ua").alias("bot_requests"),
        half_even(F.avg("is_bot_ua") * 100, 1).alias("bot_pct"),
    )


def _counts(cleaned: DataFrame, key: str, name: str) -> DataFrame:
    return cleaned.groupBy(key).agg(F.count(F.lit(1)).alias(name))


def _with_percent(rows: DataFrame, counts: DataFrame, name: str) -> DataFrame:
    """Share of all rows, which are summed from the counts: the log itself is not read again."""
    return rows.withColumn("pct", half_even(percent(F.col(name), counts.agg(F.sum(name)).scalar()), 1))


def _top(counts: DataFrame, key: str, k: int) -> DataFrame:
    return counts.orderBy(F.desc("n"), F.asc_nulls_last(key)).limit(k)


def status_distribution(cleaned: DataFrame) -> DataFrame:
    counts = _counts(cleaned, "status", "count")
    return _with_percent(counts, counts, "count").orderBy(F.desc("count"), "status")


def top_hosts(cleaned: DataFrame, k: int = 10) -> DataFrame:
    counts = _counts(cleaned, "host", "n")
    return _with_percent(_top(counts, "host", k), counts, "n")


def top_user_agents(cleaned: DataFrame, k: int = 10) -> DataFrame:
    counts = _counts(cleaned, "user_agent", "n")
    top = _with_percent(_top(counts, "user_agent", k), counts, "n")
    return top.withColumn("shown", F.substring(F.coalesce("user_agent", F.lit("")), 1, 55))


def top_resources(cleaned: DataFrame, k: int = 10) -> DataFrame:
    return _top(_counts(cleaned, "resource", "n"), "resource", k).withColumn("shown", F.substring(F.coalesce("resource", F.lit("")), 1, 52))


def hourly_load(cleaned: DataFrame) -> DataFrame:
    """Requests per hour of day, a bar length relative to the peak, and a flag above 4 x the median."""
    hours = cleaned.groupBy(F.hour("ts").alias("hour")).agg(F.count(F.lit(1)).alias("count"))
    frame = hours.agg(F.struct(F.max("count").alias("peak"), F.percentile("count", 0.5).alias("middle"))).scalar()
    return (
        hours.withColumn("_frame", frame)
        .select(
            "hour", "count",
            F.floor(F.col("count") / F.col("_frame.peak") * 30).cast("int").alias("bar_len"),
            (F.col("count") > F.col("_frame.middle") * 4).alias("is_hot"),
        )
        .orderBy("hour")
    )


def profile(cleaned: DataFrame) -> dict[str, DataFrame]:
    return {
        "overview": overview(cleaned),
        "status_distribution": status_distribution(cleaned),
        "top_hosts": top_hosts(cleaned),
        "top_user_agents": top_user_agents(cleaned),
        "top_resources": top_resources(cleaned),
        "hourly_load": hourly_load(cleaned),
    }
