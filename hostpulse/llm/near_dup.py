"""Near-duplicate documents by min-max hashing.

A document is its set of distinct three-word shingles. Every permutation gives two signature values, the smallest and the
largest hash, for one evaluation per shingle. Signatures are cut into bands; documents that agree on a whole band meet in a
bucket. No link is taken from a signature: all are confirmed on the full sets, by 100 * intersection >= 85 * union.

Documents with equal sets are one class and are compared as one. In each bucket every class is first compared with the
bucket's smallest class (a star, linear in the bucket). Buckets whose classes are then in one component are finished. What is
left goes through a complete comparison inside tasks: the bucket is cut into blocks of bounded size, each pair of blocks is one
task's work, and only links that join different components leave it. Thus large groups of copies cost no pairs, and no bucket,
partner or candidate is capped.

Defined cases: documents without words (NULL or empty text) have no shingles and are linked with nothing; with one or two words
the whole sequence is the one shingle; equal rows are copies of each other; rows with NULL doc_id are linked with nothing; rows
that share an id count as one node; an empty table gives no rows; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from hostpulse.llm.common import broadcast_if
from hostpulse.operators.components import components
from hostpulse.session import materialise

PERMUTATIONS = 65
BANDS = 26
ROWS = 5
SIMILARITY = 85
#: Shingles and classes that one block of the complete comparison may hold.
BLOCK_SHINGLES = 400_000
BLOCK_CLASSES = 1_000
#: Class ids up to which the texts of compared classes are picked by a broadcast.
BROADCAST_ROWS = 1_000_000
_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xFF51AFD7ED558CCD)
_SHIFT = np.uint64(32)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _SHIFT)) * _M3
    return x ^ (x >> _SHIFT)


class Shingler:
    """Shingle sets of texts as sorted 64-bit hashes; remembers the hashes of words up to a bound."""

    MOST_WORDS = 500_000

    def __init__(self) -> None:
        self.words: dict[bytes, int] = {}

    def _hash(self, word: bytes) -> int:
        from xxhash import xxh3_64_intdigest

        if len(self.words) >= self.MOST_WORDS:
            self.words.clear()
        self.words[word] = value = xxh3_64_intdigest(word)
        return value

    def shingles(self, text: str | None) -> np.ndarray:
        words = text.encode("utf-8", "replace").lower().split() if text else []
        if not words:
            return np.empty(0, np.uint64)
        known = self.words
        hashed = np.fromiter((known.get(w) or self._hash(w) for w in words), np.uint64, count=len(words))
        if len(words) < 3:
            whole = np.full(1, len(words), np.uint64)
            for k in range(len(words)):
                whole = _mixed(whole * _M1 + hashed[k:k + 1])
            return whole
        return np.unique(_mixed(_mixed(_mixed(hashed[:-2]) * _M1 + hashed[1:-1]) * _M2 + hashed[2:]))


def _multipliers(n: int) -> np.ndarray:
    return np.random.default_rng(20_240_229).integers(1, 1 << 63, n, np.uint64) | np.uint64(1)


def signature(shingles: np.ndarray, multipliers: np.ndarray, block: int = 4096) -> np.ndarray:
    """Smallest and largest value of every permutation: twice as many values as hash evaluations per shingle."""
    low = np.full(len(multipliers), np.iinfo(np.uint64).max, np.uint64)
    high = np.zeros(len(multipliers), np.uint64)
    for at in range(0, len(shingles), block):
        x = shingles[at:at + block, None] * multipliers
        x ^= x >> _SHIFT
        x *= _M3
        np.minimum(low, x.min(0), out=low)
        np.maximum(high, x.max(0), out=high)
    return np.concatenate([low, high])


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from xxhash import xxh3_64_intdigest, xxh3_128_digest

    shingler, multipliers = Shingler(), _multipliers(PERMUTATIONS)
    for batch in batches:
        sizes, prints, keys = [], [], []
        for text in batch["text"].to_pylist():
            found = shingler.shingles(text)
            sizes.append(len(found))
            prints.append(xxh3_128_digest(found.tobytes()) if len(found) else None)
            if not len(found):
                keys.append(None)
                continue
            values = signature(found, multipliers)[:BANDS * ROWS].reshape(BANDS, ROWS)
            keys.append([xxh3_64_intdigest(row.tobytes(), seed=k) - (1 << 63) for k, row in enumerate(values)])
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
            ["doc_id", "n_shingles", "print", "keys"],
        )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shingler = Shingler()
    for batch in batches:
        found = [shingler.shingles(t) for t in batch["text"].to_pylist()]
        edges = np.cumsum([0, *map(len, found)]).astype(np.int32)
        flat = np.concatenate(found).view(np.int64) if found else np.empty(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], pa.ListArray.from_arrays(pa.array(edges), pa.array(flat))], ["v", "shingles"]
        )


def _links_in_block(block: pd.DataFrame) -> pd.DataFrame:
    """All confirmed links of a block that join different components, as a spanning forest.

    Intersections of all pairs are one matrix product per slice of the shingles that at least two classes hold.
    """
    block = block.drop_duplicates("v").sort_values("v")
    ids, parts, sizes = block["v"].to_numpy(), block["component"].to_numpy(), block["n"].to_numpy(np.int64)
    m = len(ids)
    columns, inverse, counts = np.unique(np.concatenate(list(block["shingles"])), return_inverse=True, return_counts=True)
    rows = np.repeat(np.arange(m), [len(s) for s in block["shingles"]])
    shared = counts >= 2
    number = np.cumsum(shared) - 1
    rows, held = rows[shared[inverse]], number[inverse[shared[inverse]]]
    order = np.argsort(held, kind="stable")
    rows, held = rows[order], held[order]
    common = np.zeros((m, m), np.float32)
    width = max(1, 20_000_000 // max(m, 1))
    for at in range(0, int(shared.sum()), width):
        a, b = np.searchsorted(held, [at, at + width])
        grid = np.zeros((m, min(width, int(shared.sum()) - at)), np.float32)
        grid[rows[a:b], held[a:b] - at] = 1
        common += grid @ grid.T
    union = sizes[:, None] + sizes[None, :] - common
    close = (100 * common.astype(np.float64) >= SIMILARITY * union) & (parts[:, None] != parts[None, :])
    root = {p: p for p in parts.tolist()}

    def find(p: int) -> int:
        while root[p] != p:
            root[p] = root[root[p]]
            p = root[p]
        return p

    out = []
    for i, j in zip(*np.nonzero(np.triu(close, 1))):
        x, y = find(int(parts[i])), find(int(parts[j]))
        if x != y:
            root[max(x, y)] = min(x, y)
            out.append((int(ids[i]), int(ids[j])))
    return pd.DataFrame(out, columns=["a", "b"], dtype=np.int64)


def _label(members: DataFrame, parts: DataFrame | None) -> DataFrame:
    """`component` of each class: its own id where nothing is linked."""
    if parts is None:
        return members.withColumn("component", F.col("v"))
    found = members.join(parts.withColumnRenamed("node", "v"), "v", "left")
    return found.withColumn("component", F.coalesce("component", "v"))


def link_documents(
    docs: DataFrame, block_shingles: int = BLOCK_SHINGLES, block_classes: int = BLOCK_CLASSES,
) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, kept."""
    source = docs.select(F.col("doc_id").cast("long"), "text")
    signed = source.mapInArrow(_signatures, "doc_id long, n_shingles long, print binary, keys array<long>")
    signed = materialise(signed, "signatures")
    # One class per set: the smallest id stands for all its copies. Keys follow from the set, so any copy's will do.
    able = signed.where("doc_id is not null and print is not null")
    classes = able.groupBy("print").agg(
        F.min("doc_id").alias("v"), F.any_value("n_shingles").alias("n"), F.any_value("keys").alias("keys")
    )
    classes = materialise(classes, "classes")
    banded = classes.select("v", "n", F.explode("keys").alias("key"))
    buckets = banded.groupBy("key").agg(
        F.count(F.lit(1)).alias("members"), F.min("v").alias("first"), F.min_by("n", "v").alias("first_n"),
        F.sum("n").alias("total"),
    ).where("members > 1")
    members = materialise(banded.join(buckets, "key"), "buckets")

    # Stars: every class against the smallest of its bucket. Sizes alone rule out most wrong partners.
    fits = f"100 * least(n, first_n) >= {SIMILARITY} * greatest(n, first_n)"
    stars = members.where("v <> first").where(fits).select(F.col("first").alias("a"), F.col("v").alias("b")).distinct()
    stars = materialise(stars, "stars")
    wide = members.where("members > 2").select("v")
    ids = stars.select(F.col("a").alias("v")).unionByName(stars.select(F.col("b").alias("v"))).unionByName(wide)
    ids = materialise(ids.distinct(), "compared")
    texts = source.where("doc_id is not null").join(
        broadcast_if(ids.withColumnRenamed("v", "doc_id"), ids.count(), BROADCAST_ROWS), "doc_id", "left_semi"
    )
    sets = materialise(texts.mapInArrow(_sets, "v long, shingles array<long>").distinct(), "sets")
    one = sets.select(F.col("v").alias("a"), F.col("shingles").alias("s"))
    two = sets.select(F.col("v").alias("b"), F.col("shingles").alias("t"))
    common = F.size(F.array_intersect("s", "t"))
    union = F.size("s") + F.size("t") - F.col("common")
    links = stars.join(one, "a").join(two, "b").withColumn("common", common).where(
        100 * F.col("common") >= SIMILARITY * union
    ).select("a", "b")
    links = materialise(links, "star-links")
    parts = components(links)

    # Buckets of three or more whose classes are not in one component yet.
    open_ = _label(members.where("members > 2").select("key", "v", "n", "members", "total"), parts)
    mixed = open_.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("key")
    open_ = open_.join(mixed, "key")
    blocks = F.greatest(F.ceil(F.col("members") / block_classes), F.ceil(F.col("total") / block_shingles)).cast("int")
    spread = open_.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("v"), F.col("blocks")).cast("int"))
    spread = spread.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    spread = spread.select(
        "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "v", "n", "component"
    ).distinct()
    late = spread.join(sets, "v").groupBy("key", "i", "j").applyInPandas(_links_in_block, "a long, b long")
    late = materialise(late, "block-links")
    if not late.isEmpty():
        parts = components(links.unionByName(late))
    labelled = _label(classes, parts).select("print", F.col("component").alias("component_id"))
    result = signed.select("doc_id", "n_shingles", "print").join(labelled, "print", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return result.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each group, with its own columns. Of rows that share a kept id, the one with the smallest text stays; rows
    without an id are linked with nothing and stay."""
    linked = materialise(link_documents(docs), "linked")
    gone = linked.where("not kept").select(F.col("doc_id").alias("id")).distinct()
    rows = docs.select(F.struct(*docs.columns).alias("row"), "doc_id")
    left = rows.join(gone, F.col("doc_id") == F.col("id"), "left_anti")
    repeated = linked.where("kept").groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("id"))
    if repeated.isEmpty():
        return left.select("row.*")
    same = F.col("doc_id") == F.col("id")
    first = left.join(repeated, same, "left_semi").groupBy("doc_id").agg(F.min_by("row", F.struct(F.col("row")["text"])).alias("row"))
    return left.join(repeated, same, "left_anti").select("row").unionByName(first.select("row")).select("row.*")
