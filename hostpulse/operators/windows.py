"""Tumbling event-time windows per host with behavioural features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from hostpulse.config import FEATURES, WINDOW_SECONDS

_VALUES = ["resource", "user_agent"]


# Squares of sizes below 2 GiB fit a long; their sums are kept as two halves so that they stay exact.
_NARROW, _HALF = 2**31, 2**32


def _squares(size: Column) -> dict[str, Column]:
    narrow = size.between(-_NARROW, _NARROW)
    return {
        "_low": F.when(narrow, (size * size).bitwiseAND(_HALF - 1)),
        "_high": F.when(narrow, F.shiftright(size * size, 32)),
        "_wide": F.when(~narrow, size.cast("double") * size),
    }


def _sample_deviation(n: Column, total: Column, low: Column, high: Column, wide: Column) -> Column:
    """Sample deviation of whole numbers from their sums; 0 for a single value.

    In decimals, because the difference of two large sums loses all digits in floating point. Windows
    with a size of 2 GiB or more, or sums beyond 38 digits, are left to floating point.
    """
    def exact(c: Column) -> Column:
        return c.cast("decimal(19,0)")

    squares = exact(high) * F.lit(_HALF).cast("decimal(10,0)") + exact(low)
    spread = F.try_subtract(F.try_multiply(exact(n), squares), F.try_multiply(exact(total), exact(total)))
    rough = n * (high * float(_HALF) + low + wide) - total.cast("double") * total
    scaled = F.when(wide == 0, spread.cast("double"))
    return F.when(n > 1, F.sqrt(F.coalesce(scaled, F.greatest(rough, F.lit(0.0))) / (n * (n - 1.0)))).otherwise(0.0)


def build_features(cleaned: DataFrame, window_seconds: int = WINDOW_SECONDS) -> DataFrame:
    """One row per host and non-empty window, labelled by the window start (left-closed).

    Two aggregates: per distinct URL and per distinct agent of a window, then per window, where the
    number of groups is the distinct count (NULL is a group like any other). Each combines before its
    shuffle, so neither a busy host nor a flooded window gathers in one task. Counting both columns in
    one unpivoted pass moves about half the bytes of two count-distinct aggregates.
    """
    squares = _squares(F.col("bytes"))
    sums = ["_4xx", "_5xx", "_bot", "_bytes", *squares]
    requests = cleaned.select(
        "host",
        F.window("ts", f"{window_seconds} seconds")["start"].alias("window_start"),
        F.col("status").between(400, 499).cast("int").alias("_4xx"),
        F.col("status").between(500, 599).cast("int").alias("_5xx"),
        F.col("is_bot_ua").alias("_bot"),
        F.col("bytes").alias("_bytes"),
        *[c.alias(name) for name, c in squares.items()],
        *_VALUES,
    )
    kept = [c for c in requests.columns if c not in _VALUES]
    per_value = (
        requests.unpivot(kept, _VALUES, "_field", "_value")
        .groupBy("host", "window_start", "_field", "_value")
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.count("_bytes").alias("_sizes"),
            *[F.sum(c).alias(c) for c in sums],
        )
    )
    is_url = F.col("_field") == "resource"

    def total(name: str) -> Column:
        return F.coalesce(F.sum(F.when(is_url, F.col(name))), F.lit(0))

    per_window = per_value.groupBy("host", "window_start").agg(
        total("_n").alias("req_count"),
        F.count_if(is_url).alias("unique_urls"),
        F.count_if(~is_url).alias("unique_ua"),
        *[total(c).alias(c) for c in ("_sizes", *sums)],
    )
    return per_window.select(
        "host",
        "window_start",
        *[
            {
                "total_bytes": F.col("_bytes"),
                "error_4xx_rate": F.col("_4xx") / F.col("req_count"),
                "error_5xx_rate": F.col("_5xx") / F.col("req_count"),
                "bot_ua_rate": F.col("_bot") / F.col("req_count"),
                "avg_bytes": F.coalesce(F.try_divide(F.col("_bytes"), F.col("_sizes")), F.lit(0.0)),
                "bytes_std": _sample_deviation(*map(F.col, ("_sizes", "_bytes", *squares))),
            }.get(c, F.col(c)).alias(c)
            for c in FEATURES
        ],
    )
