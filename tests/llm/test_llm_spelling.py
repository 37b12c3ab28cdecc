import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from hostpulse.llm import spelling
from hostpulse.llm.common import table
from llm_cases import documents, none, texts

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_words(rows, damage=199):
    counts = Counter()
    for doc, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % damage == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def plain_near(counts):
    """Pairs one edit apart by trying every deletion of every word: equal words or equal after one deletion each at one place."""
    holes = {}
    for w in counts:
        for k in range(len(w)):
            holes.setdefault((w[:k], w[k + 1:]), set()).add(w)
    near = {w: set() for w in counts}
    for group in holes.values():
        for a in group:
            near[a] |= group - {a}
    for w in counts:
        for k in range(len(w)):
            cut = w[:k] + w[k + 1:]
            if cut in counts and cut != w:
                near[w].add(cut)
                near[cut].add(w)
    return near


def plain(counts):
    near = plain_near(counts)
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        if best is not None and counts[best] >= 5 * n:
            form[w] = best
    out = {}
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        f = form.get(w)
        out[w] = (n, len(near[w]), f, counts[f] if f else None, root)
    return out


def found(df):
    rows = df.collect()
    out = {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.mark.parametrize("block", [4, 1500])
def test_variants_lose_no_pair(spark, block):
    """Few letters, so that blocks are crowded with anagrams; counts that make chains of forms; very long words."""
    rng = random.Random(block)
    counts = {}
    for _ in range(60):
        w = "".join(rng.choice("abcé") for _ in range(rng.randint(6, 9)))
        for step in range(12):
            counts[w] = 5 * 6 ** rng.randint(0, 4)
            k = rng.randrange(len(w))
            w = (w[:k] + w[k + 1:], w[:k] + rng.choice("abcéÿ×") + w[k:], w[:k] + rng.choice("abz") + w[k + 1:])[rng.randrange(3)]
            if len(w) < 6:
                break
    long = "ab" * 3_000
    counts |= {long: 5, long + "c": 30, long[:-1]: 400, "z" + long[1:]: 6}
    counts |= {f"tttttt{'t' * k}": 5 * 5 ** k for k in range(6)}
    given = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(5)
    assert found(spelling.variants(given, block)) == plain(counts)


def test_candidates_are_a_superset_and_edits_are_exact():
    pairs = [("abcdef", "abcdef"), ("abcdef", "abcdeg"), ("abcdef", "badcfe"), ("abcdef", "abcdefg"), ("abcdef", "xabcdef"),
             ("abcdef", "abcxdef"), ("abcdef", "fedcbag"), ("aaaaaa", "aaaaaaa"), ("abcdef", "abdcef"), ("abcdef", "bcdefg")]
    assert spelling.one_edit(*map(list, zip(*pairs))).tolist() == [False, True, False, True, True, True, False, True, False, False]


def test_documents_against_the_plain_version(spark):
    df = table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text")
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    assert found(spelling.group_variants(df)) == plain(plain_words(rows))


def test_odd_rows_and_deletions(spark):
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choice(["Wonderful", "ÉTRANGE", "étrange", "longerword", "x" * 40]) for _ in range(30)) + "\n12") for i in range(400)]
    rows += [(None, None), (None, "Wonderful " * 6), (1, ""), (2, "  "), (2, "  "), (3, "ab" * 30_000)]
    clash = texts(spark, rows).withColumns({n: F.lit("clash") for n in ["word", "n", "run", "h", "key", "length", "near"]})
    got = found(spelling.group_variants(clash))
    assert got == plain(plain_words(rows)) and any(v[2] for v in got.values())
    assert spelling.group_variants(documents(spark)).count() == 0
    empty = spelling.group_variants(none(spark))
    assert empty.count() == 0 and empty.columns == ["word", "n", "n_near", "form", "form_n", "root"]
