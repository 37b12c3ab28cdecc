import random
from collections import Counter

import pytest

from hostpulse.llm import near_dup
from hostpulse.operators.components import components
from llm_cases import ROWS, documents, none, texts


def shingles(text):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset([tuple(words)]) if len(words) < 3 else frozenset(zip(words, words[1:], words[2:]))


def plain(rows):
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            common = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * common >= 85 * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def family(base, n, edits, start, rng):
    out = []
    for i in range(n):
        words = base.split()
        for _ in range(rng.randint(0, edits)):
            words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
        out.append((start + i, " ".join(words)))
    return out


@pytest.mark.parametrize("block", [{}, {"block_classes": 20, "block_shingles": 3_000}])
def test_groups_of_near_copies_lose_no_link(spark, block):
    """Families from close copies to many edits, so that stars alone do not finish their buckets."""
    rng = random.Random(3)
    rows = []
    for f in range(6):
        base = " ".join(f"b{f}_{rng.randrange(400)}" for _ in range(110))
        rows += family(base, 45, (2, 4, 6, 8, 10, 14)[f], 1_000 * f + 1, rng)
    rows += [(9_000 + i, t) for i, t in enumerate(["x", "X", "x y", "X  Y", "", None, "x y z", "x y z x y z", "q"])]
    rows += [(9_100 + i, rows[0][1].upper()) for i in range(5)]
    rng.shuffle(rows)
    got = near_dup.link_documents(texts(spark, rows), **block).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == plain(rows)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_boundary_is_85_percent(spark):
    words = [f"w{i}" for i in range(102)]  # 100 shingles; each changed end word costs a known number
    near = " ".join(words[:94])  # 92 of 100
    far = " ".join(words[:86])  # 84 of 100
    at = " ".join(words[:87])  # 85 of 100
    alone = [f"u{i}" for i in range(102)]
    rows = [(1, " ".join(words)), (2, near), (10, " ".join(alone)), (11, " ".join(alone[:86])), (20, " ".join(f"v{i}" for i in range(102))), (21, " ".join(f"v{i}" for i in range(87)))]
    assert far and at
    got = {r["doc_id"]: r["component_id"] for r in near_dup.link_documents(texts(spark, rows)).collect()}
    assert got == {1: 1, 2: 1, 10: 10, 11: 11, 20: 20, 21: 20}


def test_components_of_long_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(100, 180)]
    star = [(500, 501 + i) for i in range(60)] + [(520, 700), (700, 650)]
    got = components(spark.createDataFrame([*chain, *star, (7, 7)], "a long, b long")).collect()
    sizes = Counter(r["component"] for r in got)
    assert sizes == {100: 81, 500: 63}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_odd_rows(spark):
    docs = documents(spark)
    got = near_dup.link_documents(docs).collect()
    assert len(got) == len(ROWS)
    found = {(r["doc_id"], r["component_id"]) for r in got}
    assert {(2, 1), (12, 11), (8, 7), (3, 3), (4, 4), (9, 9), (None, None)} <= found
    kept = near_dup.keep_one(docs)
    assert kept.columns == docs.columns
    again = near_dup.keep_one(docs.unionByName(docs.where("doc_id = 1")).where("doc_id in (1, 3)"))
    assert sorted(r["doc_id"] for r in again.collect()) == [1, 3]
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter([1, 3, 4, 5, 6, 7, 9, 10, 11, None])
    assert near_dup.link_documents(none(spark)).count() == 0
