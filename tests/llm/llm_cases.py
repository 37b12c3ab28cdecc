"""Rows that every corpus operator must take: NULLs, empty and long texts, ties, repeats, clashing column names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i % 701}x{i % 13}" for i in range(30_000))
ROWS = [
    (1, "the quick brown fox jumps over the lazy dog\nagain and again it jumps", "en", "a"),
    (2, "the quick brown fox jumps over the lazy dog\nagain and again it jumps", "en", "b"),
    (3, "", "en", "a"),
    (4, None, "de", "b"),
    (5, "one", None, "a"),
    (6, "one two", "en", None),
    (7, LONG, "en", "a"),
    (8, LONG + " tail", "en", "b"),
    (9, "   \n\t \n", "fr", "a"),
    (10, "é ß 中文   x\n\nx\nx", "de", "c"),
    (11, "Mail a.b7@mail.example.org or +1 (017) 555-7713, card 4539578763621486 from 10.0.0.1", "en", "c"),
    (12, "Mail a.b7@mail.example.org or +1 (017) 555-7713, card 4539578763621486 from 10.0.0.1", "en", "c"),
    (12, "Mail a.b7@mail.example.org or +1 (017) 555-7713, card 4539578763621486 from 10.0.0.1", "en", "c"),
    (None, "a row without an id", None, "a"),
]


def documents(spark: SparkSession, clash: bool = True) -> DataFrame:
    """ROWS; with `clash`, columns named like what operators use inside."""
    df = spark.createDataFrame([(*r, None if r[1] is None else len(r[1])) for r in ROWS], DOCUMENTS)
    names = ["rank", "shard", "line", "keys", "hits", "part", "ids", "row", "_row", "n_words", "component_id", "spans", "score", "n_lines",
             "n_removed", "_gone", "id", "places", "hash"]
    return df.withColumns({n: F.lit("clash") for n in names}) if clash else df


def none(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], DOCUMENTS)


def texts(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """(doc_id, text[, source]) rows as documents."""
    return spark.createDataFrame([(r[0], r[1], "en", r[2] if len(r) > 2 else "s", 0) for r in rows], DOCUMENTS)
