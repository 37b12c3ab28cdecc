"""Standardisation with the population deviation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, functions as F


def moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: n, and mean_<c> / std_<c> per column. A constant column gets the deviation 1."""
    aggregates = [F.count(F.lit(1)).alias("n")]
    for c in columns:
        aggregates.append(F.avg(F.col(c).cast("double")).alias(f"mean_{c}"))
        deviation = F.stddev_pop(F.col(c).cast("double"))
        aggregates.append(F.when(deviation == 0, 1.0).otherwise(deviation).alias(f"std_{c}"))
    return df.agg(*aggregates)


def scaler_table(fitted: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The moments as one row per feature: feature, mean, std."""
    rows = F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"mean_{c}").alias("mean"), F.col(f"std_{c}").alias("std"))
        for c in columns
    ])
    return fitted.select(F.inline(rows))


def standardise(df: DataFrame, columns: Sequence[str], fitted: DataFrame | Row, prefix: str = "z_") -> DataFrame:
    """Add (x - mean) / std per column.

    `fitted` is the one-row moments table (read as a scalar subquery) or its row, already fetched.
    """
    if isinstance(fitted, Row):
        scaled = {f"{prefix}{c}": (F.col(c) - fitted[f"mean_{c}"]) / fitted[f"std_{c}"] for c in columns}
        return df.withColumns(scaled)
    model = fitted.select(F.struct(*fitted.columns)).scalar()
    with_model = df.withColumn("_model", model)
    m = F.col("_model")
    scaled = {f"{prefix}{c}": (F.col(c) - m[f"mean_{c}"]) / m[f"std_{c}"] for c in columns}
    return with_model.withColumns(scaled).drop("_model")
