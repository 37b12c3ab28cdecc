"""Cross-site boilerplate lines: lines that occur on many distinct sites are removed, but for their first occurrence.

How many sites hold a line is sketched: every line hash gets a HyperLogLog sketch of its sites, built on the map side and merged
by aggregation, so a line that stands in a third of all documents costs one small sketch per task. Lines whose estimate is far
from the threshold are settled by it; lines near it get an exact distinct count.

A site is a document's `source`. Lines are cut at line feeds; lines without a word are never boilerplate and always stay. The
first occurrence, by doc_id and then by place, stays, so no line is lost from the corpus.

Defined cases: NULL source is a site of its own; a NULL text stays NULL, an empty one empty; a line repeated inside a document
counts once for its site, and its repeats go if it is boilerplate; equal rows (same id and text) are treated alike, so a first
occurrence stays in each; rows with NULL doc_id sort first; an empty table gives no rows; extra columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from hostpulse.llm.common import broadcast_if
from hostpulse.session import materialise

#: Distinct sites from which on a line is boilerplate.
MIN_SITES = 5
#: log2 of the sketch's buckets; its relative error is about 1.04 / sqrt(2 ** k).
SKETCH_K = 10
#: Estimates within this many standard errors (and at least one site) of the threshold are counted exactly.
SIGMAS = 4
#: Boilerplate lines up to which their table is broadcast (a few dozen bytes each).
BROADCAST_ROWS = 500_000


def _lines() -> Column:
    """Places and hashes of the lines of `text` that have a word."""
    lines = F.transform(F.split("text", "\n"), lambda line, k: F.struct(
        k.alias("place"), F.when(line.rlike(r"[^\x20\x09-\x0D]"), F.xxhash64(line)).alias("line")
    ))
    return F.filter(lines, lambda x: x["line"].isNotNull())


def _occurrences(docs: DataFrame) -> DataFrame:
    """One narrow row per line: id, hash of the text, site, place, hash of the line."""
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "source", F.explode(_lines()).alias("l"))
    return rows.select("doc_id", "text_hash", "source", F.col("l.place").alias("place"), F.col("l.line").alias("line"))


def boilerplate(docs: DataFrame, min_sites: int = MIN_SITES, k: int = SKETCH_K) -> DataFrame:
    """Written table of boilerplate lines: line, and its first occurrence (doc_id, text_hash, place)."""
    margin = max(1.0, SIGMAS * 1.04 / 2 ** (k / 2) * min_sites)
    occurrences = _occurrences(docs)
    site = F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))
    sketched = occurrences.groupBy("line").agg(
        F.hll_sketch_agg(site, k).alias("sites"), F.min(F.struct("doc_id", "text_hash", "place")).alias("first")
    ).select("line", "first", F.hll_sketch_estimate("sites").alias("estimate"))
    spread = materialise(sketched.where(F.col("estimate") >= min_sites - margin), "line-spread")
    near = spread.where(F.abs(F.col("estimate") - min_sites) <= margin)
    few = broadcast_if(near.select("line"), near.count(), BROADCAST_ROWS)
    exact = (
        occurrences.join(few, "line", "left_semi").groupBy("line", site.alias("site")).agg(F.lit(1).alias("one"))
        .groupBy("line").agg(F.count("one").alias("exact"))
    )
    far = spread.where(F.abs(F.col("estimate") - min_sites) > margin).select("line", "first")
    near = near.join(exact.where(F.col("exact") >= min_sites), "line", "left_semi").select("line", "first")
    return materialise(far.unionByName(near).select("line", "first.*"), "boilerplate")


def _without(places: str) -> Column:
    """`text` without the lines at the given places. The lines are bound once, so the work grows with the text."""
    def joined(lines: Column) -> Column:
        left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(places))
        return F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n")

    return F.transform(F.array(F.split("text", "\n")), joined)[0]


def _cleaned(docs: DataFrame, min_sites: int, k: int) -> DataFrame:
    """row (the document's own columns), text without boilerplate, n_lines, n_removed.

    Only ids, hashes and places of boilerplate occurrences are regrouped; the texts move once, to meet their own list.
    """
    lines = boilerplate(docs, min_sites, k)
    first = lines.select(
        "line", F.col("doc_id").alias("first_id"), F.col("text_hash").alias("first_hash"), F.col("place").alias("first_place")
    )
    first = broadcast_if(first, lines.count(), BROADCAST_ROWS)
    is_first = (
        F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("text_hash") == F.col("first_hash"))
        & (F.col("place") == F.col("first_place"))
    )
    found = _occurrences(docs.select("doc_id", "text", F.lit(None).cast("string").alias("source")))
    removed = found.join(first, "line").where(~is_first).groupBy("doc_id", "text_hash").agg(
        F.collect_set("place").alias("places")
    ).select(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"), "places")
    met = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "text").join(
        removed, F.col("doc_id").eqNullSafe(F.col("id")) & (F.xxhash64("text") == F.col("hash")), "left"
    )
    return met.select(
        "row", F.when(F.col("places").isNull(), F.col("text")).otherwise(_without("places")).alias("text"),
        F.size(F.coalesce(_lines(), F.array())).cast("long").alias("n_lines"),
        F.coalesce(F.size("places"), F.lit(0)).cast("long").alias("n_removed"),
    )


def _own(docs: DataFrame, without: tuple[str, ...] = ()) -> list[Column]:
    return [F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns if c not in without]


def dedup_lines(docs: DataFrame, min_sites: int = MIN_SITES, k: int = SKETCH_K) -> DataFrame:
    """The documents with boilerplate lines taken out of `text`, and `n_lines`, `n_removed` (of lines with a word).

    Columns of these two names that the documents have themselves are replaced.
    """
    return _cleaned(docs, min_sites, k).select(*_own(docs, ("n_lines", "n_removed")), "n_lines", "n_removed")


def without_boilerplate(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """Documents with their own columns and cleaned texts; those that were nothing but boilerplate are left out.

    The first holder of a line keeps it, so a document that is left out has its every line elsewhere.
    """
    cleaned = _cleaned(docs, min_sites, SKETCH_K)
    return cleaned.where("n_removed = 0 or n_removed < n_lines").select(*_own(docs))
