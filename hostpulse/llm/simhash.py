"""Near-duplicate documents by SimHash and a byte-position inverted index.

A fingerprint has 64 bits, each decided by the majority of the hashes of a text's four-word shingles, repeats included. Two
fingerprints that differ in at most `DISTANCE` = 4 bits differ in at most 4 of their 8 bytes, so they share at least 4 bytes at
the same positions. The index therefore posts a fingerprint under its positional bytes; pairs of one posting list are tallied,
only those with at least 4 shared bytes are kept, and these are verified bit by bit.

A list under a single byte would hold 1/256 of the corpus. Lists stand under three bytes at once instead: `TRIPLES` is a set of 20
position triples of which any 4 shared positions hold at least one whole, so no pair is missed.

Documents of equal fingerprint are one node. In every list all members are first held against its smallest one, which is linear.
Lists whose members are then in one component are finished. In the others the members outside the list's largest component are
compared with all members, in blocks of bounded size, one task row per pair of blocks; only links that join different components
come out. No list, partner or candidate is capped.

Defined cases: a text without words (NULL, empty, white space) has fingerprint zero and is linked like any other; fewer words than
four are one shingle; equal rows and rows that share an id are separate rows of the result; a row with a NULL id keeps its place
and takes the smallest id of its component, NULL if no row of it has one; an empty table gives no rows; columns other than doc_id
and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from hostpulse.operators.components import components
from hostpulse.session import materialise

WORDS = 4
SEED = 42
DISTANCE = 4
BYTES = 8
#: Bytes that two fingerprints within DISTANCE share at least.
SHARED = BYTES - DISTANCE
#: Shingles that are hashed and counted at once.
CHUNK = 1 << 16
#: Fingerprints that one block of the complete comparison holds.
BLOCK = 1024


def _cover(points: int, held: int, size: int) -> list[tuple[int, ...]]:
    """Subsets of `size` points such that any `held` points hold one of them: the points split in three rings, Turan's design."""
    assert (held, size) == (4, 3)
    ring = [p % 3 for p in range(points)]
    chosen = []
    for trio in combinations(range(points), size):
        counts = [sum(ring[p] == r for p in trio) for r in range(3)]
        # Whole trios of a ring, and two of a ring with one of the next.
        if max(counts) == 3 or any(counts[r] == 2 and counts[(r + 1) % 3] == 1 for r in range(3)):
            chosen.append(trio)
    return chosen


TRIPLES = _cover(BYTES, SHARED, 3)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def mask(positions: tuple[int, ...]) -> int:
    return _signed(sum(0xFF << (8 * p) for p in positions))


class Majority:
    """Counts, for every bit, in how many of the hashes it is set."""

    #: The bits of every byte value.
    BITS = (np.arange(256)[:, None] >> np.arange(8)[None, :]) & 1

    def __init__(self) -> None:
        self.n, self.set = 0, np.zeros(64, np.int64)

    def add(self, hashes: np.ndarray) -> None:
        self.n += len(hashes)
        columns = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
        for k in range(8):
            self.set[8 * k:8 * k + 8] += np.bincount(columns[:, k], minlength=256) @ self.BITS

    def fingerprint(self) -> int:
        return sum(1 << b for b in np.nonzero(2 * self.set > self.n)[0].tolist())


def fingerprint(text: str | None) -> int:
    """The 64-bit fingerprint of a whole text; hashes are made and counted in chunks."""
    from xxhash import xxh64_intdigest

    words = text.encode("utf-8", "replace").lower().split() if text else []
    if not words:
        return 0
    joined, lengths = b" ".join(words), np.fromiter(map(len, words), np.int64, count=len(words))
    majority = Majority()
    if len(words) < WORDS:
        majority.add(np.array([xxh64_intdigest(joined, SEED)], np.uint64))
        return majority.fingerprint()
    ends = np.cumsum(lengths + 1) - 1
    starts, ends = (ends - lengths)[:len(words) - WORDS + 1], ends[WORDS - 1:]
    for at in range(0, len(starts), CHUNK):
        a, b = starts[at:at + CHUNK].tolist(), ends[at:at + CHUNK].tolist()
        majority.add(np.fromiter((xxh64_intdigest(joined[x:y], SEED) for x, y in zip(a, b)), np.uint64, count=len(a)))
    return majority.fingerprint()


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [_signed(fingerprint(t.as_py())) for t in batch["text"]]
        yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(found, pa.int64())], ["doc_id", "fp"])


def tally(a: Column, b: Column) -> Column:
    """Number of positional bytes that two fingerprints share."""
    differ = a.bitwiseXOR(b)
    return sum((differ.bitwiseAND(F.lit(mask((p,)))) == 0).cast("int") for p in range(BYTES))


def within(a: Column, b: Column) -> Column:
    """Enough shared bytes, then the exact test."""
    return (tally(a, b) >= SHARED) & (F.bit_count(a.bitwiseXOR(b)) <= DISTANCE)


def near(one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of fingerprints within DISTANCE: count filter on shared bytes first, bits of the survivors after it."""
    rows, columns = [], []
    for at in range(0, len(one), 256):
        differ = one[at:at + 256, None] ^ two[None, :]
        shared = (differ[..., None].view(np.uint8) == 0).sum(-1, dtype=np.int8)
        i, j = np.nonzero(shared >= SHARED)
        close = np.bitwise_count(differ[i, j]) <= DISTANCE
        rows.append(i[close] + at)
        columns.append(j[close])
    return np.concatenate(rows), np.concatenate(columns)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between the two sides of each pair of blocks that join different components, as a spanning forest."""
    for batch in batches:
        out = []
        sides = []
        for name in ("ones", "twos"):
            flat, lengths = batch[name].flatten(), batch[name].value_lengths().to_numpy(zero_copy_only=False)
            edges = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
            sides.append((flat.field("fp").to_numpy(), flat.field("component").to_numpy(), edges))
        for k in range(batch.num_rows):
            fps = [fp[edges[k]:edges[k + 1]].view(np.uint64) for fp, _, edges in sides]
            parts = [component[edges[k]:edges[k + 1]] for _, component, edges in sides]
            if not len(fps[1]):  # a block with itself
                fps[1], parts[1] = fps[0], parts[0]
            i, j = near(fps[0], fps[1])
            apart = parts[0][i] != parts[1][j]
            root: dict[int, int] = {}

            def find(p: int) -> int:
                while root.setdefault(p, p) != p:
                    root[p] = root[root[p]]
                    p = root[p]
                return p

            one, two = fps[0].view(np.int64), fps[1].view(np.int64)
            for x, y in zip(i[apart].tolist(), j[apart].tolist()):
                p, q = find(int(parts[0][x])), find(int(parts[1][y]))
                if p != q:
                    root[max(p, q)] = min(p, q)
                    out.append((int(one[x]), int(two[y])))
        a, b = zip(*out) if out else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _label(nodes: DataFrame, parts: DataFrame) -> DataFrame:
    """`component` of each fingerprint: its own where nothing is linked."""
    found = nodes.join(parts.withColumnRenamed("node", "fp"), "fp", "left")
    return found.withColumn("component", F.coalesce("component", "fp"))


def postings(nodes: DataFrame) -> DataFrame:
    """One row per fingerprint and position triple: (triple, key, fp)."""
    keys = [F.struct(F.lit(t).cast("byte").alias("triple"), F.col("fp").bitwiseAND(F.lit(mask(p))).alias("key")) for t, p in enumerate(TRIPLES)]
    return nodes.select("fp", F.explode(F.array(*keys)).alias("k")).select("k.triple", "k.key", "fp")


def _block_pairs(members: DataFrame, block: int) -> DataFrame:
    """(ones, twos) per pair of blocks in lists that are not in one component: all members against those outside the largest one."""
    where = ["triple", "key"]
    sizes = members.groupBy(*where, "component").agg(F.count(F.lit(1)).alias("n"))
    largest = sizes.groupBy(*where).agg(
        F.max(F.struct("n", "component")).alias("top"), F.sum("n").alias("total"), F.count(F.lit(1)).alias("components")
    ).where("components > 1 and total > 2").select(
        *where, F.col("top.component").alias("major"),
        F.ceil((F.col("total") - F.col("top.n")) / block).cast("int").alias("minors"), F.ceil(F.col("top.n") / block).cast("int").alias("majors"),
    )
    spread = members.join(largest, where).withColumn("is_major", F.col("component") == F.col("major"))
    own = F.pmod(F.xxhash64("fp"), F.when(F.col("is_major"), F.col("majors")).otherwise(F.col("minors"))).cast("int")
    spread = spread.withColumn("own", own)
    minors, majors = F.sequence(F.lit(0), F.col("minors") - 1), F.sequence(F.lit(0), F.col("majors") - 1)

    def task(kind: int, i: Column, j: Column, side: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"), side.alias("side"))

    me = F.col("own")
    among = F.transform(minors, lambda o: task(0, F.least(me, o), F.greatest(me, o), (me > o).cast("int")))
    against = F.transform(majors, lambda o: task(1, me, o, F.lit(0)))
    held = F.transform(minors, lambda o: task(1, o, me, F.lit(1)))
    tasks = F.when(F.col("is_major"), held).otherwise(F.concat(among, against))
    item = F.struct("fp", "component")
    dealt = spread.select(*where, item.alias("item"), F.explode(tasks).alias("t"))
    return dealt.groupBy(*where, "t.kind", "t.i", "t.j").agg(
        F.collect_list(F.when(F.col("t.side") == 0, F.col("item"))).alias("ones"),
        F.collect_list(F.when(F.col("t.side") == 1, F.col("item"))).alias("twos"),
    ).where("size(ones) > 0 and (size(twos) > 0 or (kind = 0 and i = j))").select("ones", "twos")


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) of every row, fp as a signed 64-bit number."""
    source = docs.select(F.col("doc_id").cast("long"), "text")
    return source.mapInArrow(_fingerprints, "doc_id long, fp long")


def link_fingerprints(nodes: DataFrame, block: int = BLOCK) -> DataFrame:
    """(node, component) of the distinct fingerprints in `fp` that are within DISTANCE of another."""
    posted = materialise(postings(nodes), "postings")
    lists = posted.groupBy("triple", "key").agg(F.count(F.lit(1)).alias("members"), F.min("fp").alias("first")).where("members > 1")
    members = materialise(posted.join(lists, ["triple", "key"]), "posting-lists")
    stars = members.where("fp <> first").where(within(F.col("fp"), F.col("first")))
    links = materialise(stars.select(F.col("first").alias("a"), F.col("fp").alias("b")).distinct(), "simhash-stars")
    parts = components(links)
    open_ = _label(members.where("members > 2").select("triple", "key", "fp"), parts)
    late = materialise(_block_pairs(open_, block).mapInArrow(_compare, "a long, b long"), "simhash-links")
    return components(links.unionByName(late)) if not late.isEmpty() else parts


def link_documents(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """Per row: doc_id, fingerprint as 16 hexadecimal digits, component_id."""
    signed = materialise(fingerprints(docs), "fingerprints")
    nodes = materialise(signed.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "fingerprint-nodes")
    labelled = _label(nodes, link_fingerprints(nodes.select("fp"), block))
    smallest = labelled.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = labelled.join(smallest, "component").select("fp", "component_id")
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return signed.join(named, "fp").select("doc_id", digits.alias("fingerprint"), "component_id")
