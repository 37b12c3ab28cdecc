"""Token ids as ORC files: integer run-length encoding, row indexes, and Bloom filters on the document id.

Documents are range-partitioned and sorted by id, so every file, stripe and row group covers a narrow stretch of ids. A reader
of some ids skips stripes by their minimum and maximum and row groups by the Bloom filter; a reader of all splits by stripe.

Defined cases: a NULL or empty text is the end id alone; a NULL id sorts first; rows with one id stand together, in the order of
their ids' arrays; an empty table gives empty files; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from hostpulse.llm.tokens import encoder, small_batches, tokenizer_path
from hostpulse.session import materialise, scratch_path

SCHEMA = "doc_id long, part int, ids array<int>"
STRIPE_BYTES = 16 << 20
INDEX_ROWS = 1_000


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for whole in batches:
            for batch in small_batches(whole):
                ids, counts = own.encode([t or "" for t in batch["text"].to_pylist()])
                offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["part"], lists], ["doc_id", "part", "ids"])

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None) -> str:
    """One range shuffle of the texts by id; `part` numbers the ranges in ascending order of ids."""
    ranged = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange("doc_id")
    placed = ranged.select("doc_id", F.spark_partition_id().alias("part"), "text").sortWithinPartitions("doc_id", "text")
    (
        placed.mapInArrow(_encode(tokenizer or tokenizer_path()), SCHEMA)
        .write.option("orc.compress", "ZSTD")
        .option("orc.stripe.size", STRIPE_BYTES)
        .option("orc.row.index.stride", INDEX_ROWS)
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", 0.01)
        .orc(path)
    )
    return path


def read_tokens(spark: SparkSession, path: str, doc_ids: Iterable[int] | None = None) -> DataFrame:
    """All documents, or those with the given ids: the list becomes a pushed-down filter that prunes by metadata."""
    found = spark.read.schema(SCHEMA).orc(path)
    return found if doc_ids is None else found.where(F.col("doc_id").isin(*doc_ids))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch["ids"]
        values, edges = ids.values.to_numpy(zero_copy_only=False).astype("<u4"), ids.offsets.to_numpy()
        sums = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(edges, edges[1:])]
        counts = pa.array(np.diff(edges).astype(np.int64))
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], batch["part"], counts, pa.array(sums, pa.int64())], ["doc_id", "part", "n_tokens", "ids_crc32"]
        )


def digest(tokens: DataFrame) -> DataFrame:
    """Per document: `start`, the ids of all documents before it, `n_tokens`, and the checksum of its ids.

    Starts are summed within a range of ids, on top of the totals of the ranges before it: no task sees all documents. The files are
    read once; the numbers of their rows are written.
    """
    rows = materialise(tokens.mapInArrow(_digests, "doc_id long, part int, n_tokens long, ids_crc32 long"), "token-digests")
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("part").orderBy("doc_id", "n_tokens", "ids_crc32").rowsBetween(Window.unboundedPreceding, -1)
    return (
        rows.withColumn("inside", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)))
        .join(bases, "part")
        .select("doc_id", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")
    )


def tokens_path(spark: SparkSession) -> str:
    return scratch_path(spark, "tokens")
