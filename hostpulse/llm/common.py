"""Helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

#: White space of the word rules: space and the ASCII controls from tab to carriage return.
SPACE_RUN = r"[\x20\x09-\x0D]+"
#: Rows that one sorted bucket of `ranked` holds on average.
ROWS_PER_BUCKET = 4_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unit(hashed: Column) -> Column:
    """A 64-bit hash as a double in [0, 1)."""
    return F.shiftrightunsigned(hashed, 11).cast("double") * F.lit(2.0**-53)


def broadcast_if(df: DataFrame, rows: int, most: int) -> DataFrame:
    """Broadcast a written table only if its counted rows are few; otherwise leave the join to a shuffle."""
    return F.broadcast(df) if rows <= most else df


def ranked(df: DataFrame, key: str, draw: str, ties: list[str], rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Add `key_rows` and the exact 0-based `rank` of each row within its key, in the order of `draw`.

    `draw` is a double in [0, 1), spread evenly. A hot key is cut into as many ranges of `draw` as its row count asks
    for, so that no sort holds more than about `rows_per_bucket` rows; counts of the ranges give each its first rank.
    NULL is a key of its own. `ties` break equal draws.
    """
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("key_rows")).withColumnRenamed(key, "_key")
    split = df.join(sizes, F.col(key).eqNullSafe(F.col("_key"))).drop("_key").withColumn(
        "_bucket", F.floor(F.col(draw) * F.ceil(F.col("key_rows") / rows_per_bucket))
    )
    before = Window.partitionBy("_key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        split.groupBy(F.col(key).alias("_key"), F.col("_bucket").alias("_part"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_key", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    )
    within = Window.partitionBy(key, "_bucket").orderBy(draw, *ties)
    return (
        split.withColumn("_place", F.row_number().over(within) - 1)
        .join(starts, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_bucket") == F.col("_part")))
        .withColumn("rank", F.col("_first") + F.col("_place"))
        .drop("_key", "_part", "_bucket", "_first", "_place")
    )
