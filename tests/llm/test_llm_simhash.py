import random

import pytest
import xxhash
from pyspark.sql import functions as F

from hostpulse.llm import simhash
from llm_cases import ROWS, documents, none, texts


def plain_fingerprint(text):
    words = [w for w in (text or "").encode().lower().split()]
    grams = [b" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(g, seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """(index -> smallest index reachable) by all pairs."""
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 4:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(prints))]


def test_fingerprints_equal_the_plain_count():
    rng = random.Random(1)
    cases = ["", None, " \t\n\x0b\x0c\r ", "one", "One  two", "a b c", "a b c d", "É A é a", "a b c d " * 50, "x\x00y z\x1c w v u"]
    cases += [" ".join(f"W{rng.randrange(50)}" for _ in range(rng.randrange(1, 300))) for _ in range(40)]
    assert [simhash.fingerprint(t) for t in cases] == [plain_fingerprint(t) for t in cases]
    chunk, simhash.CHUNK = simhash.CHUNK, 7
    try:
        assert [simhash.fingerprint(t) for t in cases] == [plain_fingerprint(t) for t in cases]
    finally:
        simhash.CHUNK = chunk


def test_triples_meet_every_set_of_shared_positions():
    from itertools import combinations

    for four in combinations(range(8), 4):
        assert any(set(t) <= set(four) for t in simhash.TRIPLES)


def test_hashes_equal_the_sql_function(spark):
    text = "The quick brown fox"
    got = spark.sql("select xxhash64('the quick brown fox') as h").first()["h"]
    assert simhash._signed(xxhash.xxh64_intdigest(text.lower().encode(), 42)) == got


@pytest.mark.parametrize("block", [3, 1024])
def test_links_lose_no_pair(spark, block):
    """Chains, dense groups and lone fingerprints, some 5 bits apart, against all pairs."""
    rng = random.Random(block)
    prints = [0, 0xFFFFFFFFFFFFFFFF]
    for _ in range(8):
        base = rng.getrandbits(64)
        for _ in range(25):
            prints.append(base ^ sum(1 << b for b in rng.sample(range(64), rng.choice([0, 1, 2, 3, 4, 5, 6]))))
        step = base
        for _ in range(15):  # a chain that leaves its start
            step ^= sum(1 << b for b in rng.sample(range(64), rng.choice([4, 5])))
            prints.append(step)
        low = rng.getrandbits(64)
        prints += [low ^ (rng.getrandbits(16) << 8) for _ in range(40)]  # one crowded posting list
    prints = sorted(set(prints))
    nodes = spark.createDataFrame([(simhash._signed(p),) for p in prints], "fp long")
    got = {r["node"]: r["component"] for r in simhash.link_fingerprints(nodes, block).collect()}
    mine = [got.get(simhash._signed(p), simhash._signed(p)) for p in prints]
    theirs = plain_components(prints)
    assert len(set(theirs)) > 20
    first = {}
    assert all(first.setdefault(m, t) == t for m, t in zip(mine, theirs))
    assert len(set(mine)) == len(set(theirs))


def test_documents_against_brute_force(spark):
    rng = random.Random(5)
    rows = []
    for f in range(12):
        words = [f"b{f}_{rng.randrange(900)}" for _ in range(260)]
        for _ in range(12):
            own = list(words)
            for _ in range(rng.randint(0, 4)):
                own[rng.randrange(len(own))] = f"e{rng.randrange(10**6)}"
            rows.append((len(rows) + 1, " ".join(own)))
    rows += [(900 + i, t) for i, t in enumerate(["", None, "  ", "x y", "X  Y", "x y z"])]
    rng.shuffle(rows)
    rows.sort(key=lambda r: r[0])
    prints = [plain_fingerprint(t) for _, t in rows]
    want = {rows[i][0]: (f"{prints[i]:016x}", rows[c][0]) for i, c in enumerate(plain_components(prints))}
    got = simhash.link_documents(texts(spark, rows)).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in got} == want
    assert len({c for _, c in want.values()}) < len(rows) - 20


def test_odd_rows(spark):
    again = documents(spark).where("doc_id = 5").withColumn("doc_id", F.lit(None).cast("long"))
    got = simhash.link_documents(documents(spark).unionByName(again)).collect()
    assert len(got) == len(ROWS) + 1
    by = {r["doc_id"]: r for r in got}
    assert by[4]["fingerprint"] == "0" * 16 and by[4]["component_id"] == by[3]["component_id"] == by[9]["component_id"] == 3
    assert by[2]["component_id"] == 1 and by[12]["component_id"] == 11
    assert {r["component_id"] for r in got if r["doc_id"] is None} == {None, 5}
    empty = simhash.link_documents(none(spark))
    assert empty.count() == 0 and empty.columns == ["doc_id", "fingerprint", "component_id"]
