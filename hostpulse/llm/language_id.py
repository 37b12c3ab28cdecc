"""Language identification with one bit-sliced Bloom filter over character n-grams.

Every language has a Bloom filter of its frequent n-grams; the filters lie side by side, bit l of a slot belonging to language l.
Looking up an n-gram is the AND of a few slots and gives the mask of all languages that contain it. Bits are counted per language
over all n-grams of a text, corrected for the filter's false positives, and the language with the largest share wins.

The n-grams are learned from at most `MOST_DOCUMENTS` labelled documents per language, drawn by a hash of the id; documents
whose crc32(doc_id) mod 4 is 2 are held out. Only the text of a document decides its prediction.

Defined cases: a text that is NULL or has no letter is `und` with score 0; so is everything if nothing is labelled; ties go to the
language that sorts first; a NULL doc_id counts as held out; equal texts get equal predictions; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from hostpulse.llm.common import unit
from hostpulse.llm.tokens import small_batches

UNKNOWN = "und"
GRAM = 4
#: Labelled documents per language to learn from.
MOST_DOCUMENTS = 1_500
#: n-grams per language, and languages, at most (the most frequent ones).
MOST_GRAMS = 10_000
MOST_LANGUAGES = 1_024
SLOTS = 1 << 18
PROBES = 3
SEED = 11
_NOT_LETTER = re.compile(r"[\W\d_]+")
_MIX = np.uint64(0xFF51AFD7ED558CCD)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(True))


def letters(text: str | None) -> str:
    """Lower-cased words between single spaces; empty if there is no letter."""
    if not text:
        return ""
    words = _NOT_LETTER.sub(" ", text.lower()).strip()
    return f" {words} " if any(map(str.isalpha, words)) else ""


def grams(texts: list[str], size: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the n-grams of all texts in a row, and where each text's begin and end."""
    padded = [t + " " * (size - 1) if t else "" for t in texts]  # a text of k characters has k n-grams
    points = np.frombuffer("".join(padded).encode("utf-32-le"), np.uint32).astype(np.uint64)
    edges = np.cumsum([0, *map(len, padded)])
    if not len(points):
        return points, edges
    rolled = np.zeros(len(points), np.uint64)
    for k in range(size):
        part = np.zeros_like(points)
        part[:len(points) - k] = points[k:]
        rolled = rolled * _STEP + part
    rolled ^= rolled >> np.uint64(32)
    rolled *= _MIX
    return rolled ^ (rolled >> np.uint64(29)), edges


@dataclass(frozen=True)
class LanguageModel:
    """`table[slot, word]` holds a bit per language; `noise` is each language's chance of a false positive."""

    languages: list[str]
    table: np.ndarray
    noise: np.ndarray


def build(found: dict[str, np.ndarray], slots: int = SLOTS) -> LanguageModel:
    languages = sorted(found)
    table = np.zeros((slots, max(1, -(-len(languages) // 64))), np.uint64)
    fill = np.zeros(len(languages))
    for l, name in enumerate(languages):
        own = np.zeros(slots, bool)
        for slot in _slots(found[name], slots):
            own[slot] = True
        table[own, l // 64] |= np.uint64(1 << l % 64)
        fill[l] = own.mean()
    return LanguageModel(languages, table, fill**PROBES)


def _slots(hashed: np.ndarray, slots: int) -> list[np.ndarray]:
    bits = np.uint64(slots.bit_length() - 1)
    return [((hashed * (_STEP + np.uint64(2 * k))) >> (np.uint64(64) - bits)).astype(np.int64) for k in range(PROBES)]


def classify(model: LanguageModel, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """Predicted language and corrected share of the text's n-grams, from 0 to 1."""
    clean = [letters(t) for t in texts]
    hashed, edges = grams(clean)
    shares = np.zeros((len(texts), max(1, len(model.languages))))
    n = np.diff(edges)
    some = n > 0
    if len(hashed) and model.languages:
        first, *rest = _slots(hashed, len(model.table))
        for word in range(model.table.shape[1]):
            mask = model.table[first, word]
            for slot in rest:
                mask &= model.table[slot, word]
            for l in range(64 * word, min(64 * word + 64, len(model.languages))):
                hits = (mask >> np.uint64(l % 64)).astype(np.uint8) & 1
                counts = np.add.reduceat(hits, edges[:-1][some], dtype=np.int64)
                shares[some, l] = (counts / n[some] - model.noise[l]) / (1 - model.noise[l])
    shares = shares.clip(0, 1)
    best = shares.argmax(1)
    known = some & bool(model.languages)
    names = [model.languages[b] if k else UNKNOWN for b, k in zip(best, known)]
    return names, np.where(known, shares.max(1), 0.0)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task, how often each language has each n-gram: sums, so that few rows are shuffled."""
    total: dict[str, list] = defaultdict(list)
    for whole in batches:
        for batch in small_batches(whole):
            by: dict[str, list[str]] = defaultdict(list)
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist(), strict=True):
                by[lang].append(letters(text))
            for lang, texts in by.items():
                total[lang].append(np.unique(grams(texts)[0], return_counts=True))
    for lang, parts in total.items():
        keys, inverse = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        counts = np.bincount(inverse, np.concatenate([p[1] for p in parts]), len(keys)).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(keys), pa.string()), pa.array(keys.view(np.int64)), pa.array(counts)], ["lang", "gram", "n"]
        )


def fit(docs: DataFrame, most_documents: int = MOST_DOCUMENTS, most_grams: int = MOST_GRAMS, slots: int = SLOTS) -> LanguageModel:
    """Learn from the labelled documents that are not held out; the driver gets at most most_grams hashes per language."""
    rows = docs.where("text is not null and lang is not null").where(~held_out(F.col("doc_id"))).select("doc_id", "text", "lang")
    sizes = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MOST_LANGUAGES).collect()
    if not sizes:
        return build({}, slots)
    spark = docs.sparkSession
    share = spark.createDataFrame([(r["lang"], most_documents / r["count"]) for r in sizes], "lang string, share double")
    drawn = rows.join(F.broadcast(share), "lang").where(unit(F.xxhash64(F.lit(SEED), "doc_id")) < F.col("share"))
    counts = drawn.select("lang", "text").mapInArrow(_counted, "lang string, gram long, n long")
    counts = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    top = counts.withColumn("place", place).where(F.col("place") <= most_grams).where("n > 1")
    found = top.groupBy("lang").agg(F.collect_list("gram").alias("grams")).collect()
    return build({r["lang"]: np.asarray(r["grams"], np.int64).view(np.uint64) for r in found}, slots)


def _predicted(model: LanguageModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in small_batches(whole):
                names, score = classify(model, batch["text"].to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"], batch["held_out"], pa.array(names, pa.string()), pa.array(score)],
                    ["doc_id", "held_out", "lang_pred", "score"],
                )

    return run


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, held_out, lang_pred, score; a narrow pass over the texts."""
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(_predicted(model), f"doc_id {kind}, held_out boolean, lang_pred string, score double")
