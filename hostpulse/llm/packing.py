"""Best-fit packing by minimum bin slack.

Every document becomes its token ids and an end id. Documents longer than a sequence are cut into full pieces behind a shorter
first one. For packing only the number of pieces of each length matters, at most one count per length. The fullest sequence that
holds the longest piece left is found by a subset-sum program on bitsets over the lengths still available, and used as many
times as the counts allow; what it used is removed, and so on. The plan has at most a few times as many patterns as there are
lengths, whatever the number of documents. Each piece then finds its place from its number among the pieces of its length.

Defined cases: a NULL or empty text is one piece of the end id; repeated rows each get their own pieces; an empty table gives
no rows; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from hostpulse.llm.tokens import encoder, small_batches, tokenizer_path
from hostpulse.session import materialise, scratch_path

LENGTH = 1024
#: Rows of per-file length counts up to which they are broadcast.
BROADCAST_ROWS = 2_000_000
#: Row groups of the written pieces: what a writing task holds in memory.
ROW_GROUP_BYTES = 16 << 20
PIECES = "doc_id long, piece int, start long, length int, part int, nth long, ids binary"
Pattern = tuple[dict[int, int], int]


def _cut(n: int, size: int) -> list[tuple[int, int]]:
    """(start, end) of the pieces of n ids: all full, but for a shorter first one."""
    first = n % size or min(n, size)
    return [(0, first), *((a, a + size) for a in range(first, n, size))]


def _pieces(path: str, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        own, seen, part = encoder(path), np.zeros(size + 1, np.int64), TaskContext.get().partitionId()
        for whole in batches:
            for batch in small_batches(whole):
                ids, counts = own.encode([t or "" for t in batch["text"].to_pylist()])
                raw, at, rows = memoryview(ids.astype("<u4").tobytes()), 0, []
                for doc, n in zip(batch["doc_id"].to_pylist(), counts.tolist(), strict=True):
                    for k, (a, b) in enumerate(_cut(n, size)):
                        rows.append((doc, k, a, b - a, part, int(seen[b - a]), raw[4 * (at + a):4 * (at + b)].tobytes()))
                        seen[b - a] += 1
                    at += n
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary()]
                columns = zip(*rows, strict=True) if rows else [[]] * 7
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                    ["doc_id", "piece", "start", "length", "part", "nth", "ids"],
                )

    return run


def tokenized_pieces(docs: DataFrame, size: int = LENGTH, tokenizer: str | None = None) -> DataFrame:
    """Written pieces. `part` and `nth` number the pieces of one length within the task that wrote them."""
    spark, path = docs.sparkSession, scratch_path(docs.sparkSession, "pieces")
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    pieces = rows.mapInArrow(_pieces(tokenizer or tokenizer_path(), size), PIECES)
    pieces.write.option("compression", "zstd").option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
    return spark.read.schema(PIECES).parquet(path)


def _fullest(counts: list[int], order: list[int], room: int) -> dict[int, int]:
    """The multiset of available lengths with the largest sum up to room; longer pieces are preferred.

    Bit s of a row says that sum s can be reached with the lengths so far. Rows are kept to walk back from the best sum.
    """
    keep = (1 << (room + 1)) - 1
    reach, rows = 1, []
    for size in order:
        if size > room:
            continue
        rows.append((size, reach))
        left, step = min(counts[size], room // size), 1
        while left:
            take = min(step, left)
            reach |= (reach << (take * size)) & keep
            left, step = left - take, step * 2
        if reach >> room & 1:
            break
    total, used = reach.bit_length() - 1, {}
    for size, before in reversed(rows):
        while not before >> total & 1:
            used[size] = used.get(size, 0) + 1
            total -= size
    return used


def plan_patterns(histogram: dict[int, int], size: int = LENGTH) -> list[Pattern]:
    """(how many of each length, how many sequences like that), until every piece has its place."""
    counts = [0] * (size + 1)
    for length, n in histogram.items():
        counts[length] = n
    patterns: list[Pattern] = []
    for seed in range(size, 0, -1):
        while counts[seed]:
            counts[seed] -= 1
            order = [s for s in range(size - seed, 0, -1) if counts[s]]
            used = _fullest(counts, order, size - seed)
            counts[seed] += 1
            used[seed] = used.get(seed, 0) + 1
            times = min(counts[s] // m for s, m in used.items())
            for s, m in used.items():
                counts[s] -= m * times
            patterns.append((used, times))
    return patterns


def _segments(patterns: list[Pattern]) -> list[tuple[int, list[tuple[int, int, int, int]]]]:
    """Per length, (first number, pieces per sequence, first sequence, offset) in ascending order of the number."""
    taken: dict[int, int] = {}
    rows: dict[int, list] = {}
    sequence = 0
    for used, times in patterns:
        offset = 0
        for size in sorted(used, reverse=True):
            rows.setdefault(size, []).append((taken.get(size, 0), used[size], sequence, offset))
            taken[size] = taken.get(size, 0) + used[size] * times
            offset += size * used[size]
        sequence += times
    return sorted(rows.items())


def pack(spark: SparkSession, docs: DataFrame, size: int = LENGTH, tokenizer: str | None = None) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids (little-endian unsigned 32-bit), sequence_id, offset."""
    pieces = tokenized_pieces(docs, size, tokenizer)
    per_part = materialise(pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    histogram = {r["length"]: r["n"] for r in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = per_part.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    few = per_part.count() <= BROADCAST_ROWS
    numbered = pieces.join(F.broadcast(firsts) if few else firsts, ["part", "length"]).select(
        "doc_id", "piece", "start", "length", "ids", (F.col("first") + F.col("nth")).alias("number")
    )
    segments = spark.createDataFrame(
        _segments(plan_patterns(histogram, size)),
        "length int, segments array<struct<number:long, each:long, sequence:long, offset:long>>",
    )  # at most one row per length
    met = numbered.join(F.broadcast(segments), "length")
    own = F.element_at(F.filter("segments", lambda s: s["number"] <= F.col("number")), -1)
    met = met.select("doc_id", "piece", "start", "length", "ids", own.alias("own"), (F.col("number") - own["number"]).alias("past"))
    return met.select(
        "doc_id", "piece", "start", F.col("length").cast("long"), "ids",
        (F.col("own.sequence") + F.expr("past div own.each")).alias("sequence_id"),
        (F.col("own.offset") + F.col("past") % F.col("own.each") * F.col("length")).alias("offset"),
    )
