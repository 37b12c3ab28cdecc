"""Bloom filters over the keys of written tables, made and asked inside tasks.

A table's keys are cut into buckets by the leading bits of their hash, so a filter covers a bounded number of keys whatever the size
of the table. "Not in it" is certain; about one key in a hundred that is not in it is reported as possibly known.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

KEYS_PER_BUCKET = 50_000
BITS_PER_KEY = 10
PROBES = 7
_SCHEMA = "part string, bucket int, bits binary"


def bucket_bits(rows: int) -> int:
    """Leading hash bits that tell the buckets of a table of so many rows."""
    return max(0, (max(rows, 1) - 1) // KEYS_PER_BUCKET).bit_length()


def _bucket(key: Column, bits: Column) -> Column:
    # Shifting a long by 64 is no shift, so no bits is a case of its own.
    return F.when(bits == 0, 0).otherwise(F.call_function("shiftrightunsigned", key, F.lit(64) - bits)).cast("int")


def _probes(keys: np.ndarray, size: int) -> np.ndarray:
    """Bit positions of each key, shape (PROBES, keys). Keys are hashes already; their leading bits are the bucket's."""
    mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    step = (mixed >> np.uint64(33)) | np.uint64(1)
    return (mixed + np.arange(PROBES, dtype=np.uint64)[:, None] * step) % np.uint64(size)


def filters(keys: DataFrame) -> DataFrame:
    """(part, bucket, bits) from `keys` (part, bits: its bucket bits, key: 64-bit hash)."""
    def build(rows: pa.Table) -> pa.Table:
        found = rows["key"].to_numpy()
        size = max(64, BITS_PER_KEY * len(found))
        bits = np.zeros(size, dtype=bool)
        bits[_probes(found, size).ravel()] = True
        # The first four bytes tell the number of bits, as packing rounds it up.
        cell = np.uint32(size).tobytes() + np.packbits(bits).tobytes()
        return pa.table({"part": rows["part"].slice(0, 1), "bucket": rows["bucket"].slice(0, 1), "bits": pa.array([cell], pa.binary())})

    placed = keys.select("part", _bucket(F.col("key"), F.col("bits")).alias("bucket"), "key")
    return placed.groupBy("part", "bucket").applyInArrow(build, _SCHEMA)


def possibly_known(asked: DataFrame, made: DataFrame) -> DataFrame:
    """Distinct keys of `asked` (part, bits, split, key) that a filter of their part may hold.

    `split` is the number of slices in which a bucket's keys are asked, at least 1; so many keys asked of a small part do not
    gather in one task. The filters of the part are copied as often.
    """
    def ask(wanted: pa.Table, filters_: pa.Table) -> pa.Table:
        keys = wanted["key"].to_numpy()
        cell = filters_["bits"][0].as_py() if len(filters_) else b""
        if not cell or not len(keys):
            return pa.table({"key": pa.array([], pa.int64())})
        size = int(np.frombuffer(cell, np.uint32, 1)[0])
        bits = np.unpackbits(np.frombuffer(cell, np.uint8, offset=4), count=size).astype(bool)
        return pa.table({"key": keys[bits[_probes(keys, size)].all(axis=0)]})

    slices = asked.select("part", "split").distinct()
    copied = made.join(F.broadcast(slices), "part").select(
        "part", "bucket", F.explode(F.sequence(F.lit(0), F.col("split") - 1)).alias("slice"), "bits"
    )
    placed = asked.select(
        "part", _bucket(F.col("key"), F.col("bits")).alias("bucket"),
        F.pmod(F.xxhash64("key"), F.col("split")).cast("int").alias("slice"), "key",
    )
    by = ["part", "bucket", "slice"]
    return placed.groupBy(*by).cogroup(copied.groupBy(*by)).applyInArrow(ask, "key long").distinct()
