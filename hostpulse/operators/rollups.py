"""Distinct counts that roll up: a sketch per group, merged to any coarser range without the log.

A HyperLogLog sketch of 2^SKETCH_BITS registers is at most some 4 kB and merges by taking the larger register, so hours give days and hosts give
networks. NULL counts as a value, as in the exact counts, and is carried beside the sketch. Exact counts stay the default elsewhere.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

#: The relative standard error of a merged sketch is 1.04 / sqrt(2^bits): 1.6 %.
SKETCH_BITS = 12
RELATIVE_ERROR = 1.04 / 2 ** (SKETCH_BITS / 2)


def hourly(cleaned: DataFrame, values: Sequence[str] = ("resource", "user_agent")) -> DataFrame:
    """Per host and hour the requests and, per column, `<c>_sketch` and `<c>_null`. Rows are combined before the shuffle."""
    aggs = [F.count(F.lit(1)).alias("requests")]
    for c in values:
        aggs += [F.hll_sketch_agg(c, SKETCH_BITS).alias(f"{c}_sketch"), F.max(F.col(c).isNull().cast("int")).alias(f"{c}_null")]
    return cleaned.groupBy("host", F.date_trunc("hour", "ts").alias("hour")).agg(*aggs)


def roll_up(rollup: DataFrame, keys: Sequence, values: Sequence[str] = ("resource", "user_agent")) -> DataFrame:
    """Requests and estimated distinct values per group of `keys`, which are names or columns over host and hour."""
    aggs = [F.sum("requests").alias("requests")]
    for c in values:
        merged = F.hll_sketch_estimate(F.hll_union_agg(f"{c}_sketch"))
        aggs.append((merged + F.max(f"{c}_null")).alias(f"{c}_distinct"))
    return rollup.groupBy(*keys).agg(*aggs)
