import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from hostpulse.llm import sharding
from llm_cases import ROWS, documents, none


@pytest.mark.parametrize("rows_per_bucket", [7, 4_000])
def test_every_shard_matches_the_mixture(spark, rows_per_bucket):
    docs = spark.range(3_000).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.col("id")).alias("text"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 2 == 0, "warm").when(F.col("id") < 40, F.concat(F.lit("s"), "id"))
        .otherwise("cold").alias("source"),
    )
    got = sharding.interleave(docs, rows_per_bucket=rows_per_bucket).collect()
    assert len(got) == 3_000 and len({r["doc_id"] for r in got}) == 3_000
    assert sorted(r["position"] for r in got) == list(range(3_000))
    sizes = Counter(r["shard"] for r in got)
    assert set(sizes) == set(range(16)) and max(sizes.values()) - min(sizes.values()) <= 1
    for shard in range(16):
        own = [r for r in got if r["shard"] == shard]
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
        mixture = Counter(r["source"] for r in own)
        for source, share in (("hot", 1_000 / 16), ("warm", 1_000 / 16)):
            assert abs(mixture[source] - share) <= 2


def test_order_does_not_depend_on_partitions_or_buckets(spark):
    docs = documents(spark).where("doc_id is not null").dropDuplicates(["doc_id"])
    rows = lambda df: sorted((r["doc_id"], r["position"]) for r in df.collect())
    assert rows(sharding.interleave(docs.repartition(5))) == rows(sharding.interleave(docs.coalesce(1), rows_per_bucket=2))


def test_odd_rows(spark):
    got = sharding.interleave(documents(spark)).collect()
    assert len(got) == len(ROWS)
    found = Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got)
    assert found == Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in ROWS)
    assert sharding.interleave(none(spark)).count() == 0


def test_against_a_plain_interleaving_and_rows_without_ids(spark):
    """Ranks, fractions and cuts worked out row by row; a third of the rows have no id and are still drawn apart."""
    docs = spark.range(900).select(
        F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"),
        F.when(F.col("id") % 5 > 0, F.concat(F.lit("s"), F.col("id") % 4)).alias("source"),
    )
    got = sharding.interleave(docs, rows_per_bucket=50).collect()
    unit = "shiftrightunsigned({}, 11) * power(2, -53)"
    rows = docs.selectExpr("doc_id", "source", "crc32(text) as crc", "octet_length(text) + 1L as size").selectExpr(
        "*", unit.format(f"xxhash64({sharding.SEED}, doc_id, crc, size)") + " as draw",
        unit.format(f"xxhash64({sharding.SEED}, coalesce(source, ''), source is null)") + " as phase",
    ).collect()
    assert len({r["draw"] for r in rows}) == 900
    sources = {}
    for r in rows:
        sources.setdefault(r["source"], []).append(r)
    line = []
    for own in sources.values():
        own.sort(key=lambda r: r["draw"])
        line += [((k + r["phase"]) / len(own), r["source"] or "", r["crc"], r["size"]) for k, r in enumerate(own)]
    line.sort()
    want = {(crc, size): (k * 16 // 900, k) for k, (_, _, crc, size) in enumerate(line)}
    assert {(r["text_crc32"], r["size"]): (r["shard"], r["position"]) for r in got} == want
