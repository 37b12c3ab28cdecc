import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from hostpulse.llm import packing, token_files
from hostpulse.llm.tokens import END, Encoder, tokenizer_path
from llm_cases import ROWS, documents, none, texts

PARTS = [" ", "\n", "\t", ".", "'s", "a", "é", "1", "\x85", "\xa0", "\u180e", "\u3000", "\x1c", "!", "中", "ll", "\r", "<|endoftext|>", "²",
         "\0", "Hello", "  ", "wörld", "\n\n", " x"]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokenizer_path())


def expected(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, END]


@pytest.mark.parametrize("cache", [50, 10**6])
def test_encoder_gives_the_tokenizers_ids(tokenizer, cache):
    random.seed(1)
    encoder = Encoder(tokenizer_path(), cache)
    for _ in range(6):
        rows = ["".join(random.choices(PARTS, k=random.randint(0, 20))) for _ in range(200)] + ["some plain words here.\nand there"] * 3
        rows += ["a <|endoftext|> b", "<|endoftext|>", "plain words<|endoftext|>", "<|endoftext| >"]
        ids, counts = encoder.encode(rows)
        want = [expected(tokenizer, t) for t in rows]
        assert counts.tolist() == [len(w) for w in want]
        assert ids.tolist() == [i for w in want for i in w]


def digests(rows):
    return [(i, n, zlib.crc32(np.asarray(ids, "<u4").tobytes())) for i, n, ids in rows]


def test_token_files_round_trip(spark, tokenizer, tmp_path):
    docs = documents(spark)
    path = token_files.write_tokens(docs, str(tmp_path / "t"))
    got = sorted(
        ((r["doc_id"], r["n_tokens"], r["ids_crc32"], r["start"]) for r in token_files.digest(token_files.read_tokens(spark, path)).collect()),
        key=lambda r: r[3],
    )
    want = sorted((-1 if r[0] is None else r[0], expected(tokenizer, r[1])) for r in ROWS)
    assert [(-1 if r[0] is None else r[0], r[1], r[2]) for r in got] == digests((i, len(w), w) for i, w in want)
    assert [r[3] for r in got] == np.cumsum([0, *(len(w) for _, w in want)]).tolist()[:-1]
    some = token_files.read_tokens(spark, path, [7, 11])
    assert sorted(r["doc_id"] for r in some.collect()) == [7, 11]
    assert "In(doc_id" in some._jdf.queryExecution().toString()  # pushed down to the stripes' statistics and Bloom filters
    empty = token_files.write_tokens(none(spark), str(tmp_path / "e"))
    assert token_files.digest(token_files.read_tokens(spark, empty)).count() == 0


def test_patterns_hold_every_piece_and_no_sequence_is_too_long():
    random.seed(2)
    for _ in range(20):
        histogram = {random.randint(1, 64): random.randint(1, 300) for _ in range(random.randint(1, 40))}
        patterns = packing.plan_patterns(histogram, 64)
        used = {}
        for lengths, times in patterns:
            assert times > 0 and sum(s * m for s, m in lengths.items()) <= 64
            for s, m in lengths.items():
                used[s] = used.get(s, 0) + m * times
        assert used == histogram


def test_few_sequences_beyond_the_bound():
    random.seed(8)
    histogram = {}
    for _ in range(20_000):
        size = min(1023, int(random.lognormvariate(5.5, 1)) + 1)
        histogram[size] = histogram.get(size, 0) + 1
    bins = sum(times for _, times in packing.plan_patterns(histogram))
    bound = -(-sum(s * n for s, n in histogram.items()) // 1024)
    assert bound <= bins <= 1.002 * bound + 1


def test_fullest_finds_the_best_sum():
    random.seed(6)
    for _ in range(200):
        counts = [0] * 31
        for _ in range(random.randint(1, 5)):
            counts[random.randint(1, 30)] += random.randint(1, 3)
        order = [s for s in range(30, 0, -1) if counts[s]]
        sums = {0}
        for s in order:
            for _ in range(counts[s]):
                sums |= {x + s for x in sums if x + s <= 30}
        used = packing._fullest(counts, order, 30)
        assert sum(s * m for s, m in used.items()) == max(sums) and all(m <= counts[s] for s, m in used.items())


@pytest.mark.parametrize("limit", [2_000_000, 0])
def test_packing(spark, tokenizer, monkeypatch, limit):
    monkeypatch.setattr(packing, "BROADCAST_ROWS", limit)
    docs = documents(spark)
    rows = packing.pack(spark, docs).withColumn("n", F.length("ids")).collect()
    ids = {}
    for r in sorted(rows, key=lambda r: (r["doc_id"] or -1, r["start"])):
        assert r["n"] == 4 * r["length"] and 1 <= r["length"] <= 1024
        if r["doc_id"] != 12:
            ids.setdefault(r["doc_id"], []).extend(np.frombuffer(r["ids"], "<u4").tolist())
    for i, text, *_ in ROWS:
        assert i == 12 or ids[i] == expected(tokenizer, text)
    assert all(r["length"] == 1024 for r in rows if r["piece"] > 0)
    places = {}
    for r in rows:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for found in places.values():
        found.sort()
        assert [o for o, _ in found] == np.cumsum([0, *(n for _, n in found)]).tolist()[:-1] and sum(n for _, n in found) <= 1024
    assert packing.pack(spark, none(spark)).count() == 0
    hot = texts(spark, [(i, "the same text") for i in range(700)])
    assert packing.pack(spark, hot).select("sequence_id").distinct().count() == -(-700 // (1024 // len(expected(tokenizer, "the same text"))))
