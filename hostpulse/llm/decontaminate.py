"""Benchmark decontamination: one Aho-Corasick automaton over the normalised benchmark, one scan of every text.

Words are runs of digits, ASCII letters (lower-cased) and characters beyond ASCII. A benchmark item gives one window per ten
consecutive words, a shorter one a single window. Texts and windows are joined by single spaces with a space at both ends,
so a match starts and ends at words; matches are mapped back to character offsets of the original text.

The automaton is bounded: benchmark text beyond `BLOCK_BYTES` goes through several automata, one pass each. The hits of a block
are written before the next block is read, so the driver and every task hold one block at a time.

Defined cases: a NULL or empty text has no words and no hits; items without words give no window; items without id
are found too and count as one item, NULL; items with equal text are both reported; repeated rows get equal rows; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from hostpulse.session import materialise, scratch_path

WINDOW = 10
#: Benchmark text that one automaton may hold. Its windows take some 315 bytes a byte: 0.3 GB in each Python worker.
BLOCK_BYTES = 1_000_000
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_FOLD = bytes(
    b if b >= 0x80 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 0x20
    for b in range(256)
)
_HIT = "first_word int, last_word int, start int, end int, item_id string"


def _words(text: str) -> list[bytes]:
    return text.encode("utf-8", "replace").translate(_FOLD).split()


def _spaced(words: list[bytes]) -> str:
    return f" {b' '.join(words).decode()} "


def windows(items: list[tuple[str | None, str]], size: int = WINDOW) -> dict[str, list]:
    """Spaced window -> [its number of words, the items that hold it]."""
    found: dict[str, tuple[int, dict]] = {}
    for item, text in items:
        words = _words(text)
        n = min(size, len(words))
        for i in range(len(words) - n + 1) if n else ():
            found.setdefault(_spaced(words[i:i + n]), (n, {}))[1][item] = None
    return {window: [n, list(held)] for window, (n, held) in found.items()}


def _hits(text: str, words: list[bytes], automaton: ahocorasick.Automaton) -> list[dict]:
    """Runs of overlapping or touching windows per item, in words and in characters of the text."""
    spaced = _spaced(words)
    gaps, spans, runs = None, None, defaultdict(list)
    for end, (n, items) in automaton.iter(spaced):
        if gaps is None:
            gaps = np.flatnonzero(np.frombuffer(spaced.encode("utf-32-le"), np.uint32) == 32)
            spans = [m.span() for m in _WORD.finditer(text)]
        last = int(np.searchsorted(gaps, end)) - 1
        for item in items:
            first, own = last - n + 1, runs[item]
            # Texts of one id can have windows of different lengths: a long one that ends later may reach back over several runs.
            while own and first <= own[-1]["last_word"] + 1:
                first = min(first, own.pop()["first_word"])
            own.append({
                "first_word": first, "last_word": last, "start": spans[first][0], "end": spans[last][1], "item_id": item,
            })
    return [run for own in runs.values() for run in own]


def _scanner(found: dict[str, list]):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = ahocorasick.Automaton()
        for window, value in found.items():
            automaton.add_word(window, tuple(value))
        if found:
            automaton.make_automaton()
        for batch in batches:
            counts, hits = [], []
            for text, before in zip(batch["text"].to_pylist(), batch["hits"].to_pylist(), strict=True):
                words = _words(text) if text else []
                counts.append(len(words))
                hits.append([*before, *(_hits(text, words, automaton) if words and found else [])])
            new = {"n_words": pa.array(counts, pa.int64()), "hits": pa.array(hits, batch.schema.field("hits").type)}
            yield pa.RecordBatch.from_arrays(
                [new.get(name, batch[name]) for name in batch.schema.names], schema=batch.schema
            )

    return scan


def find_passages(docs: DataFrame, benchmark: DataFrame, carry: list[str] | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Documents with `n_words` and `hits`: an array of (first_word, last_word, start, end, item_id).

    `carry` names the columns to keep, doc_id alone if not given. Only benchmark text comes to the driver, one bounded block at a time.
    """
    carry = ["doc_id"] if carry is None else carry
    items = benchmark.where(F.col("text").isNotNull()).select(
        F.col("item_id").cast("string").alias("item_id"), "text"
    )
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    empty = F.from_json(F.lit("[]"), f"array<struct<{', '.join(':'.join(x.split()) for x in _HIT.split(', '))}>>")
    state = docs.select(
        F.struct(*carry).alias("row"), F.col("text"), F.lit(0).cast("long").alias("n_words"), empty.alias("hits")
    )
    block = F.pmod(F.xxhash64(F.coalesce("item_id", "text")), F.lit(blocks))
    if blocks == 1:
        found = windows([tuple(r) for r in items.collect()])
        return state.mapInArrow(_scanner(found), state.schema).select("row.*", "n_words", "hits")
    # Rows are numbered in a written table, since ids may repeat or be NULL; only rows with hits are written per block.
    counted = state.mapInArrow(_scanner({}), state.schema)
    state = materialise(counted.withColumn("number", F.monotonically_increasing_id()), "texts")
    parts = []
    for k in range(blocks):
        found = windows([tuple(r) for r in items.where(block == k).collect()])
        scanned = state.select("number", "text", "n_words", "hits")
        scanned = scanned.mapInArrow(_scanner(found), scanned.schema)
        parts.append(scratch_path(docs.sparkSession, "hits"))
        scanned.where(F.size("hits") > 0).select("number", "hits").write.parquet(parts[-1])
    hits = docs.sparkSession.read.schema(state.select("number", "hits").schema).parquet(*parts)
    hits = hits.groupBy("number").agg(F.flatten(F.collect_list("hits")).alias("found"))
    joined = state.join(hits, "number", "left")
    return joined.select("row.*", "n_words", F.coalesce("found", "hits").alias("hits"))


def n_hit() -> Column:
    """Distinct words inside any hit."""
    covered = F.flatten(F.transform("hits", lambda h: F.sequence(h["first_word"], h["last_word"])))
    return F.size(F.array_distinct(covered)).cast("long")


def item_ids() -> Column:
    """Distinct items that occur, in string order; NULL, for all items without id, comes first."""
    return F.sort_array(F.array_distinct(F.transform("hits", lambda h: h["item_id"])))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents without any benchmark window, with their own columns."""
    row = docs.select("text", F.struct(*docs.columns).alias("_row"))
    return find_passages(row, benchmark, ["_row"]).where(F.size("hits") == 0).select("_row.*")
