import hashlib
import random
import re

from pyspark.sql import functions as F

from hostpulse.llm import decontaminate
from hostpulse.session import scratch_path
from llm_cases import ROWS, documents, none, texts


def words(text):
    lowered = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def plain(text, items):
    doc, hit, found = words(text), set(), set()
    for item, body in items:
        own = words(body)
        n = min(10, len(own))
        wanted = {tuple(own[i:i + n]) for i in range(len(own) - n + 1)} if n else set()
        for i in range(len(doc) - n + 1) if n else ():
            if tuple(doc[i:i + n]) in wanted:
                hit.update(range(i, i + n))
                found.add(str(item))
    digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    return len(doc), len(hit), len(found), digest


def run(docs, benchmark, **more):
    found = decontaminate.find_passages(docs, benchmark, **more)
    found = found.withColumns({"h": decontaminate.n_hit(), "items": decontaminate.item_ids()})
    found = found.withColumn("sha", F.sha2(F.concat_ws(",", "items"), 256))
    return {r["doc_id"]: r for r in found.collect()}


def test_matches_a_plain_version_in_one_or_many_blocks(spark):
    random.seed(9)
    pool = ["ab", "cd", "Ef", "9", "é", "ñu", "中", "z z"]
    text = lambda n: "".join(random.choice(pool) + random.choice([" ", ", ", "\n", "--"]) for _ in range(n))
    items = [(i, text(random.choice([0, 1, 3, 9, 10, 11, 25]))) for i in range(30)] + [(30, None), (31, text(12)), (32, "...")]
    items.append((33, items[31][1]))  # the same text under two ids
    rows = [(i, text(random.randint(0, 40)) + (items[random.randint(0, 29)][1] or "") + text(3)) for i in range(200)]
    rows += [(900, None), (901, ""), (902, "!!!")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    for block in (4_000_000, 100):
        got = run(texts(spark, rows), benchmark, block_bytes=block)
        for i, body in rows:
            r = got[i]
            assert (r["n_words"], r["h"], len(r["items"]), r["sha"]) == plain(body, items), (block, body)


def test_offsets_point_into_the_original(spark):
    item = "Alpha beta, gamma. Delta epsilon zeta eta theta iota KAPPA lambda"
    docs = texts(spark, [(1, "é!! noise  ALPHA-beta gamma\ndelta epsilon zeta eta theta iota kappa LAMBDA. tail")])
    hit = run(docs, spark.createDataFrame([(7, item)], "item_id long, text string"))[1]["hits"]
    assert [(h["item_id"], h["first_word"], h["last_word"]) for h in hit] == [("7", 2, 12)]
    body = docs.first()["text"]
    assert body[hit[0]["start"]:hit[0]["end"]].startswith("ALPHA-beta") and body[hit[0]["start"]:hit[0]["end"]].endswith("LAMBDA")


def test_odd_rows(spark):
    benchmark = spark.createDataFrame([(1, "quick brown fox"), (2, None), (None, "lazy dog")], "item_id long, text string")
    docs = documents(spark)
    assert decontaminate.find_passages(docs, benchmark).count() == len(ROWS)
    kept = decontaminate.drop_contaminated(docs, benchmark)
    assert kept.columns == docs.columns and not {1, 2} & {r["doc_id"] for r in kept.collect()} and kept.count() == len(ROWS) - 2
    assert decontaminate.drop_contaminated(docs, benchmark.limit(0)).count() == len(ROWS)
    assert decontaminate.find_passages(none(spark), benchmark).count() == 0


def test_texts_of_one_id_and_items_without_id(spark):
    benchmark = spark.createDataFrame(
        [(1, "c d"), (1, "f g"), (1, "a b c d e f g h i j"), (None, "lonely words here"), (None, "k l")], "item_id long, text string"
    )
    docs = texts(spark, [(1, "x a b c d e f g h i j y"), (2, "some lonely words here"), (3, "k l x c d"), (4, "x")])
    for block in (4_000_000, 10):
        got = run(docs, benchmark, block_bytes=block)
        assert [(h["first_word"], h["last_word"], h["start"], h["end"]) for h in got[1]["hits"]] == [(1, 10, 2, 21)]
        assert [(got[i]["h"], got[i]["items"]) for i in (1, 2, 3, 4)] == [(10, ["1"]), (3, [None]), (4, [None, "1"]), (0, [])]
        sha = lambda names: hashlib.sha256(names.encode()).hexdigest()
        assert [got[i]["sha"] for i in (1, 2, 3)] == [sha("1"), sha(""), sha("1")]
    kept = decontaminate.drop_contaminated(docs, benchmark)
    assert [r["doc_id"] for r in kept.collect()] == [4]


def test_a_block_is_scanned_before_the_next_is_collected(spark, monkeypatch):
    steps, real = [], decontaminate.windows
    monkeypatch.setattr(decontaminate, "windows", lambda items: steps.append("block") or real(items))
    monkeypatch.setattr(decontaminate, "scratch_path", lambda spark, label: steps.append(label) or scratch_path(spark, label))
    benchmark = spark.createDataFrame([(i, f"item number {i} of many") for i in range(40)], "item_id long, text string")
    docs = texts(spark, [(5, "an item number 7 of many"), (5, "item number 31 of many"), (None, "item number 7 of many"), (6, "none")])
    found = decontaminate.find_passages(docs, benchmark, block_bytes=300)
    assert steps == ["block", "hits"] * (len(steps) // 2) and len(steps) > 4
    got = [(r["doc_id"], [h["item_id"] for h in r["hits"]]) for r in found.collect()]
    assert sorted(got, key=str) == sorted([(5, ["7"]), (5, ["31"]), (None, ["7"]), (6, [])], key=str)
    assert found.columns == ["doc_id", "n_words", "hits"]
