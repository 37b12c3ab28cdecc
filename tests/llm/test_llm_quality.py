import random
from collections import Counter

from hostpulse.llm import quality
from llm_cases import LONG, ROWS, documents, none, texts


def plain(text):
    text = text or ""
    words = text.encode().decode().replace("\n", " ").replace("\t", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ")
    words = [w for w in words if w]
    windows = list(zip(words, words[1:], words[2:]))
    counts = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if line.strip(" \t\x0b\x0c\r")]
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))


def test_measures_match_a_plain_version(spark):
    random.seed(5)
    vocabulary = ["a", "b", "c", "|", "#x", "é", "\n", "\t", " ", "\r\n", "XX", "  "]
    rows = [(i, "".join(random.choice(vocabulary) + random.choice([" ", "", "\n"]) for _ in range(random.randint(0, 60)))) for i in range(400)]
    rows += [(1000, LONG), (1001, None), (1002, ""), (1003, "a b c a b c a b c"), (1004, "a b"), (1005, "x x x x")]
    got = {r["doc_id"]: r for r in quality.measure(texts(spark, rows)).collect()}
    for i, text in rows:
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == plain(text), repr(text)


def test_policies_and_ablation_are_bitwise(spark):
    good = " ".join(f"word{i}" for i in range(80))
    docs = texts(spark, [(1, good), (2, "too short"), (3, good.upper()), (4, good + " " + "# " * 30), (5, "# " * 30)])
    ledger = quality.ledger(docs).cache()
    kept = lambda policy: {r["doc_id"] for r in ledger.where(quality.passes(policy)).collect()}
    assert kept("v2") == {1} and kept("v1") == {1, 3}
    table = {r["rule"]: (r["failed"], r["only_this"], r["kept_without"]) for r in quality.ablation(ledger).collect()}
    assert table["capitals"] == (1, 1, 2)
    assert table["few_words"] == (2, 1, 2)
    assert table["long_words"] == (0, 0, 1)


def test_odd_rows(spark):
    assert quality.ledger(documents(spark)).count() == len(ROWS)
    assert quality.ledger(none(spark)).count() == 0
    docs = documents(spark)
    kept = quality.reject(docs)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} <= {7, 8}


def test_windows_that_share_leading_hash_bits_are_not_repeats(spark):
    # The hashes of the two windows agree in their 46 leading bits.
    text = " ".join(["a b w7299867", *(f"f{i}" for i in range(140_000)), "a b w30315797"])
    assert plain(text)[4] == 0
    assert quality.measure(texts(spark, [(1, text), (2, f"{text} {text}")])).orderBy("doc_id").select("n_repeat_words").collect() == [(0,), (280_012,)]
