import random

import pytest

from hostpulse.llm import line_dedup
from llm_cases import ROWS, documents, none, texts


def plain(rows, sites):
    spread, first = {}, {}
    for i, text, source in sorted(rows):
        for place, line in enumerate((text or "").split("\n")):
            if line.strip():
                spread.setdefault(line, set()).add(source)
                first.setdefault(line, (i, place))
    out = {}
    for i, text, _ in rows:
        kept = [line for place, line in enumerate((text or "").split("\n"))
                if not line.strip() or len(spread[line]) < sites or first[line] == (i, place)]
        out[i] = None if text is None else "\n".join(kept)
    return out


@pytest.mark.parametrize("limit", [10**6, 0])
def test_matches_a_plain_version_with_and_without_broadcast(spark, monkeypatch, limit):
    monkeypatch.setattr(line_dedup, "BROADCAST_ROWS", limit)
    random.seed(4)
    rows = [
        (i, "\n".join(random.choice(["common", "rare " + str(random.randint(0, 60)), "", " ", "mid " + str(random.randint(0, 9))])
                      for _ in range(random.randint(0, 9))), f"s{random.randint(0, 11)}")
        for i in range(300)
    ]
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(texts(spark, rows), min_sites=5).collect()}
    assert got == plain(rows, 5)


def test_many_sites_are_settled_by_the_sketch(spark):
    rows = [(i, "everywhere\nown " + str(i), f"site{i}") for i in range(400)]
    found = line_dedup.boilerplate(texts(spark, rows), min_sites=100).collect()
    assert len(found) == 1 and (found[0]["doc_id"], found[0]["place"]) == (0, 0)


def test_odd_rows(spark):
    docs = documents(spark)
    got = line_dedup.dedup_lines(docs, min_sites=2)
    assert got.count() == len(ROWS)
    by_id = {r["doc_id"]: r for r in got.collect()}
    assert by_id[4]["text"] is None and by_id[3]["text"] == "" and by_id[1]["n_removed"] == 0 and by_id[2]["n_removed"] == 2
    kept = line_dedup.without_boilerplate(docs, min_sites=2)
    assert kept.columns == docs.columns and 2 not in {r["doc_id"] for r in kept.collect()}
    assert line_dedup.dedup_lines(none(spark)).count() == 0


def test_a_text_of_many_repeated_lines_takes_linear_time(spark):
    """80,000 lines that stand elsewhere too; the quadratic removal took 25 s here."""
    many = "\n".join(f"line {i % 1000}" for i in range(80_000))
    rows = [(i, "\n".join(f"line {j}" for j in range(1000)), f"s{i}") for i in range(6)] + [(9, many + "\nown", "s9")]
    got = {r["doc_id"]: (r["n_lines"], r["n_removed"], r["text"]) for r in line_dedup.dedup_lines(texts(spark, rows)).collect()}
    assert got[9] == (80_001, 80_000, "own") and got[0][1] == 0 and got[1][1] == 1000
