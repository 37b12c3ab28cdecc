"""Spelling variants grouped by blocked Gram matrices.

Every word is a vector of letter counts. Two words one edit apart have letter counts at a squared distance of at most two, and
lengths that differ by at most one. Distances of a whole block of words come from one matrix product: |a|^2 + |b|^2 - 2 a.b. Pairs
at most two apart in adjacent lengths are kept, and their edits are verified letter by letter.

One edit changes the counts of at most two letters. The alphabet is therefore dealt into `PARTS` parts; of the parts' count vectors at
least PARTS - 2 are equal in both words. Words meet in a block for each choice of PARTS - 2 parts whose counts they share, so no pair
is missed, and a block holds a small share of all words. A block of more than `BLOCK` words is cut by length and hash into
pieces of about that size, and each pair of pieces in adjacent lengths is one row of work.

Defined cases: NULL and empty texts have no words; a NULL doc_id is written as nothing in the key of a deletion; equal rows count
once each; ties of the most frequent near word go to the smallest in code-point order; an empty table gives no rows; columns other
than doc_id and text are ignored. Words of any length are held whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from hostpulse.session import materialise

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_LENGTH = 6
LEAST_COUNT = 5
#: A form has at least so many times the occurrences of its variants.
DOMINANCE = 5
DAMAGE = 199
PARTS = 5
#: Words of one piece of a block; a matrix has at most twice as many rows.
BLOCK = 1500
#: Words whose count vectors are made at once, and letters of candidate pairs that are verified at once.
VECTORS, LETTERS_AT_ONCE = 20_000, 4_000_000

#: Column of each code point: a to z, then the letters from U+00C0 to U+00FF. Parts take the columns in turn.
COLUMNS = 26 + 64
COLUMN = np.zeros(256, np.int64)
COLUMN[ord("a"):ord("z") + 1] = np.arange(26)
COLUMN[0xC0:0x100] = 26 + np.arange(64)
PART = np.arange(COLUMNS) % PARTS
#: The parts that a block's words share.
CHOICES = list(combinations(range(PARTS), PARTS - 2))


def words(docs: DataFrame, damage: int | None = DAMAGE) -> DataFrame:
    """(word, n) of all words, after one letter is deleted from the stated share of runs (none if `damage` is None)."""
    low = F.translate("text", UPPER, LOWER)
    runs = docs.select("doc_id", F.explode(F.split(low, r"[^a-zÀ-ÿ]+")).alias("run"))
    runs = runs.where(F.length("run") >= LEAST_LENGTH)
    if damage is not None:
        h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), "run"))
        at = F.pmod("h", F.length("run")).cast("int")
        cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
        runs = runs.withColumn("h", h).withColumn("run", F.when(F.col("h") % damage == 0, cut).otherwise(F.col("run")))
        runs = runs.where(F.length("run") >= LEAST_LENGTH)
    return runs.groupBy(F.col("run").alias("word")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST_COUNT)


def vectors(found: list[str]) -> np.ndarray:
    """Letter counts of words, one row each."""
    lengths = np.fromiter(map(len, found), np.int64, count=len(found))
    letters = COLUMN[np.frombuffer("".join(found).encode("latin-1"), np.uint8)]
    rows = np.repeat(np.arange(len(found)), lengths)
    return np.bincount(rows * COLUMNS + letters, minlength=len(found) * COLUMNS).reshape(-1, COLUMNS)


def _chunks(lengths: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Stretches of rows that hold about `most` each, one row at least."""
    ends = np.cumsum(lengths)
    at = 0
    while at < len(lengths):
        start = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, start + most, "right")))
        yield at, to
        at = to


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(choice, key, word, n, length) for every choice of parts; key is a hash of their counts."""
    from xxhash import xxh3_64_intdigest

    masks = [np.isin(PART, choice) for choice in CHOICES]
    for batch in batches:
        whole, counts = batch["word"].to_pylist(), batch["n"].to_numpy(zero_copy_only=False)
        lengths = np.fromiter(map(len, whole), np.int64, count=len(whole))
        for a, b in _chunks(np.maximum(lengths, COLUMNS), VECTORS * COLUMNS):
            table = vectors(whole[a:b])
            for c, mask in enumerate(masks):
                rows = np.ascontiguousarray(table[:, mask])
                keys = [xxh3_64_intdigest(r) - (1 << 63) for r in rows]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(b - a, c, np.int8)), pa.array(keys, pa.int64()), pa.array(whole[a:b]), pa.array(counts[a:b]),
                    pa.array(lengths[a:b].astype(np.int32)),
                ], ["choice", "key", "word", "n", "length"])


def _tasks(blocks: DataFrame, block: int) -> DataFrame:
    """(choice, items) per piece of work; an item's side is 0 or 1 where two pieces meet, else 0."""
    where = ["choice", "key"]
    sizes = blocks.groupBy(*where, "length").agg(F.count(F.lit(1)).alias("here"))
    whole = Window.partitionBy(*where)
    by_length = whole.orderBy("length")

    def pieces(step: int):
        """Pieces of the length `step` above this one."""
        near = F.lead if step > 0 else F.lag
        count = F.when(near("length").over(by_length) == F.col("length") + step, near("here").over(by_length))
        return F.coalesce(F.ceil(count / block), F.lit(0)).cast("int")

    sizes = sizes.withColumns({
        "total": F.sum("here").over(whole), "own_pieces": F.ceil(F.col("here") / block).cast("int"), "above": pieces(1), "below": pieces(-1),
    }).where("total > 1")
    spread = blocks.join(sizes.drop("here"), [*where, "length"]).withColumn("own", F.pmod(F.xxhash64("word"), "own_pieces").cast("int"))
    me, length = F.col("own"), F.col("length")

    def task(base, kind: int, i, j, side):
        return F.struct(base.alias("base"), F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"), side.alias("side"))

    def upto(n: str):
        return F.when(F.col(n) > 0, F.sequence(F.lit(0), F.col(n) - 1)).otherwise(F.array().cast("array<int>"))

    zero = F.lit(0)
    cut = F.concat(
        F.transform(upto("own_pieces"), lambda o: task(length, 0, F.least(me, o), F.greatest(me, o), (me > o).cast("int"))),
        F.transform(upto("above"), lambda o: task(length, 1, me, o, zero)),
        F.transform(upto("below"), lambda o: task(length - 1, 1, o, me, F.lit(1))),
    )
    one = F.array(task(zero, 2, zero, zero, zero))
    dealt = spread.select(*where, "word", "n", F.explode(F.when(F.col("total") <= block, one).otherwise(cut)).alias("t"))
    item = F.struct(F.col("t.side").alias("side"), "word", "n")
    grouped = dealt.groupBy(*where, "t.base", "t.kind", "t.i", "t.j").agg(F.collect_list(item).alias("items"))
    return grouped.where("size(items) > 1").select("choice", (F.col("i") != F.col("j")).alias("apart"), "kind", "items")


def candidates(table: np.ndarray, sides: np.ndarray, meet: bool) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs whose letter counts are one insertion or one replacement apart, from one Gram matrix."""
    lengths = table.sum(1)
    exact = np.float32 if lengths.max() < 2_000 else np.float64
    rows = table.astype(exact)
    squares = (rows * rows).sum(1)
    distance = squares[:, None] + squares[None, :] - 2 * (rows @ rows.T)
    # At most two; one edit on words of equal length gives two, of adjacent lengths one.
    step = np.abs(lengths[:, None] - lengths[None, :])
    close = ((step == 0) & (distance == 2)) | ((step == 1) & (distance == 1))
    if meet:
        close &= sides[:, None] < sides[None, :]
        return np.nonzero(close)
    return np.nonzero(np.triu(close, 1))


def one_edit(shorter: list[str], longer: list[str]) -> np.ndarray:
    """For pairs whose lengths are equal or one apart: exactly one letter replaced or inserted."""
    out = np.zeros(len(shorter), bool)
    sizes = np.fromiter(map(len, longer), np.int64, count=len(longer))
    order = np.argsort(sizes, kind="stable")
    widths = sizes[order]
    at = 0
    while at < len(order):
        to = at + 1
        while to < len(order) and (to - at + 1) * (widths[to] + 1) <= LETTERS_AT_ONCE:
            to += 1
        chosen, width = order[at:to], int(widths[to - 1]) + 1
        a, b = (
            np.frombuffer(b"".join(found[k].encode("latin-1").ljust(width, b"\0") for k in chosen), np.uint8).reshape(-1, width)
            for found in (shorter, longer)
        )
        differ = a != b
        same = np.fromiter((len(shorter[k]) == len(longer[k]) for k in chosen), bool, count=len(chosen))
        first = differ.argmax(1)
        behind = np.arange(width - 1)[None, :] >= first[:, None]
        shifted = ~(behind & (a[:, :-1] != b[:, 1:])).any(1)
        out[chosen] = np.where(same, differ.sum(1) == 1, shifted & differ.any(1))
        at = to
    return out


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Both directions of each verified pair, from the first choice of parts that its words share."""
    parts = [PART == p for p in range(PARTS)]
    for batch in batches:
        flat = batch["items"].flatten()
        whole, counts, sides = flat.field("word").to_pylist(), flat.field("n").to_numpy(), flat.field("side").to_numpy()
        edges = np.concatenate([[0], np.cumsum(batch["items"].value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)])
        choice = batch["choice"].to_numpy()
        meet = batch["apart"].to_numpy(zero_copy_only=False) | (batch["kind"].to_numpy() == 1)
        lengths = np.fromiter(map(len, whole), np.int64, count=len(whole))
        # Rows of work of which the letters and the vectors are made together.
        weight = np.add.reduceat(np.maximum(lengths, COLUMNS), edges[:-1]) if len(edges) > 1 else np.empty(0, np.int64)
        for start, end in _chunks(weight, VECTORS * COLUMNS):
            first, last = edges[start], edges[end]
            table = vectors(whole[first:last])
            one, two, chosen = [], [], []
            for k in range(start, end):
                a, b = edges[k], edges[k + 1]
                i, j = candidates(table[a - first:b - first], sides[a:b], meet[k])
                one.append(i + a)
                two.append(j + a)
                chosen.append(np.full(len(i), choice[k]))
            i, j, chosen = np.concatenate(one), np.concatenate(two), np.concatenate(chosen)
            swap = lengths[i] > lengths[j]
            i, j = np.where(swap, j, i), np.where(swap, i, j)
            kept = one_edit([whole[k] for k in i], [whole[k] for k in j])
            i, j, chosen = i[kept], j[kept], chosen[kept]
            equal = table[i - first] == table[j - first]
            shared = np.stack([equal[:, p].all(1) for p in parts], 1)
            # The first choice that both words share is made of their first PARTS - 2 equal parts.
            rank = np.cumsum(shared, 1)
            lead = shared & (rank <= PARTS - 2)
            own = np.array([[p in c for p in range(PARTS)] for c in CHOICES])[chosen]
            mine = (lead == own).all(1)
            i, j = i[mine], j[mine]
            a, b = np.concatenate([i, j]), np.concatenate([j, i])
            yield pa.RecordBatch.from_arrays(
                [pa.array([whole[k] for k in a], pa.string()), pa.array([whole[k] for k in b], pa.string()), pa.array(counts[b])],
                ["word", "near", "near_n"],
            )


def near_words(counted: DataFrame, block: int = BLOCK) -> DataFrame:
    """(word, near, near_n): every pair of words exactly one edit apart, in both directions, of a table (word, n)."""
    blocks = counted.mapInArrow(_blocks, "choice byte, key long, word string, n long, length int")
    return _tasks(materialise(blocks, "letter-blocks"), block).mapInArrow(_near, "word string, near string, near_n long")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for each (word, form): the end of its chain of forms. Counts grow along a chain, so it ends; steps double."""
    known = materialise(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        up = known.select(F.col("word").alias("_word"), F.col("root").alias("_next"))
        known = materialise(
            known.join(up, F.col("root") == F.col("_word"), "left")
            .select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")), "roots"
        )
        if known.where("moved").isEmpty():
            return known.drop("moved")
        known = known.drop("moved")


def variants(counted: DataFrame, block: int = BLOCK) -> DataFrame:
    """word, n, n_near, form, form_n, root of every word of a written table (word, n)."""
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form")))
    near = near_words(counted, block).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    strong = -F.col("best.less") >= DOMINANCE * F.col("n")
    found = materialise(counted.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(strong, F.col("best.form")).alias("form"), F.when(strong, -F.col("best.less")).alias("form_n"),
    ), "variants")
    ends = roots(found.where("form is not null"))
    return found.join(ends, "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root")
    )


def group_variants(docs: DataFrame, damage: int | None = DAMAGE, block: int = BLOCK) -> DataFrame:
    """Words of whole texts with their near words, form and root."""
    return variants(materialise(words(docs.select(F.col("doc_id").cast("long"), "text"), damage), "words"), block)
