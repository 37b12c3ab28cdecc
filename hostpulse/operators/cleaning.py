"""Raw all-string log rows -> typed, valid, de-duplicated rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, functions as F

from hostpulse.config import BOT_MARKERS, DEDUP_KEYS, TIME_FORMATS
from hostpulse.functions.text import contains_any, lenient_int, parse_time, strip


def type_columns(raw: DataFrame, time_formats: Sequence[str] = TIME_FORMATS) -> DataFrame:
    """Parse and cast leniently. All expressions see the raw columns (one projection)."""
    return raw.withColumns({
        "ts": parse_time("datetime", time_formats),
        "status": lenient_int("status", "smallint"),
        "bytes": F.coalesce(lenient_int("bytes", "bigint"), F.lit(0).cast("bigint")),
        "host": strip("host"),
        "resource": strip("resource"),
        "method": F.upper(strip("method")),
        "user_agent": strip("user_agent"),
        "is_bot_ua": F.coalesce(contains_any("user_agent", BOT_MARKERS), F.lit(False)).cast("tinyint"),
    })


def is_valid():
    return (
        F.col("ts").isNotNull()
        & (F.char_length("host") > 0)
        & F.col("status").between(100, 599)
    )


def drop_invalid(typed: DataFrame) -> DataFrame:
    return typed.filter(is_valid())


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the first by `order`.

    The order columns must tell copies apart. An aggregate, not a ranking window: copies are reduced
    before the shuffle, so one key that holds a large share of all rows never gathers in one task.
    """
    others = [c for c in df.columns if c not in keys and c not in order]
    first = F.min(F.struct(*order, *others)).alias("_first")
    return (
        df.groupBy(*keys)
        .agg(first)
        .select(*[F.col(c) if c in keys else F.col("_first")[c].alias(c) for c in df.columns])
    )


def clean(
    raw: DataFrame,
    order: Sequence[str],
    time_formats: Sequence[str] = TIME_FORMATS,
    counters: Observation | str = "cleaning",
) -> DataFrame:
    """Type, filter, de-duplicate. `order` names the columns that define "first" among copies.

    Rows read and rows valid are observed on the way. Observing also keeps the filter above the
    projection, so each value is parsed once; pushed below it, the filter would parse again.
    """
    observed = type_columns(raw, time_formats).observe(
        counters, F.count(F.lit(1)).alias("rows_in"), F.count_if(is_valid()).alias("valid_rows")
    )
    technical = [c for c in order if c != "_source_file"]
    return keep_first(drop_invalid(observed), DEDUP_KEYS, order).drop(*technical)
