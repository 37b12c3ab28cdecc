"""Proportional stratified interleaving: every shard gets the mixture of sources.

Rows are shuffled by a seeded hash and ranked within their source; a row's fractional rank is its place on its source's own
scale from 0 to 1, moved by a seeded phase so that small sources don't all meet at one place. Sorted by that number, any stretch
of rows holds the sources in proportion, so cutting the order into equal stretches gives equal shards of equal mixture.

Defined cases: NULL source is a stratum of its own; NULL or empty text has size 1 and checksum 0; repeated rows each get a slot;
an empty table gives no rows; only doc_id, text and source are read, other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from hostpulse.llm.common import ROWS_PER_BUCKET, ranked, unit
from hostpulse.session import materialise

SHARDS = 16
SEED = 7


def text_bytes() -> Column:
    return F.octet_length(F.coalesce("text", F.lit("")))


def interleave(
    docs: DataFrame, shards: int = SHARDS, seed: int = SEED, rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """doc_id, source, size, text_crc32, `position` in the interleaved order, `shard` and `slot`.

    Texts are read once, for size and checksum; what is sorted and written is a narrow row. Both orders are cut into
    buckets of bounded size first, so neither a hot source nor the whole table is ever sorted in one task.
    """
    narrow = docs.select(
        "doc_id",
        "source",
        (text_bytes() + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
    )
    # The text has a say too: rows that share an id, or have none, are drawn apart.
    narrow = narrow.withColumn("draw", unit(F.xxhash64(F.lit(seed), "doc_id", "text_crc32", "size")))
    phase = unit(F.xxhash64(F.lit(seed), F.coalesce("source", F.lit("")), F.col("source").isNull()))
    placed = ranked(narrow, "source", "draw", ["doc_id", "text_crc32", "size"], rows_per_bucket).select(
        "doc_id", "source", "size", "text_crc32", "draw", ((F.col("rank") + phase) / F.col("key_rows")).alias("fraction")
    )
    placed = materialise(placed, "interleave")
    n = placed.count()
    buckets = max(1, -(-n // rows_per_bucket))
    placed = placed.withColumn("bucket", F.floor(F.col("fraction") * buckets))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).select(
        "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")
    )
    within = Window.partitionBy("bucket").orderBy("fraction", "source", "draw", "doc_id", "text_crc32", "size")
    ordered = placed.withColumn("place", F.row_number().over(within) - 1).join(starts, "bucket")
    ordered = ordered.withColumn("position", (F.col("first") + F.col("place")).cast("long"))
    return ordered.select(
        "doc_id", "source", "size", "text_crc32", "position", F.expr(f"cast(position * {shards} div {max(n, 1)} as int)").alias("shard")
    ).withColumn("slot", F.expr(f"position - (shard * {n}L + {shards - 1}) div {shards}"))
