"""Numeric and aggregate expressions shared by several tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def half_even(column: Column, digits: int) -> Column:
    return F.bround(column, digits)


def share(condition: Column) -> Column:
    """Share of rows that meet a condition."""
    return F.avg(F.when(condition, 1.0).otherwise(0.0))


def distinct_with_null(column: str) -> Column:
    """Distinct values, where NULL counts as one value."""
    return F.count_distinct(F.col(column)) + F.max(F.when(F.col(column).isNull(), 1).otherwise(0)).cast("long")


def total_rows(df: DataFrame) -> Column:
    """Row count of a frame as a scalar subquery, usable in expressions over another frame."""
    return df.agg(F.count(F.lit(1))).scalar()


def percent(part: Column, whole: Column) -> Column:
    """part / whole * 100, NULL for an empty whole."""
    return F.try_divide(part, whole) * 100


def clamp(column: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), column))
