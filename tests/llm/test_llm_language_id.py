import random

import numpy as np

from hostpulse.llm import language_id as lid
from llm_cases import ROWS, documents, none

SYLLABLES = {"en": ["the", "ing", "tion", "er"], "de": ["sch", "ung", "ei", "keit"], "fr": ["eau", "ment", "que", "è"]}


def made(n, rng):
    rows = []
    for i in range(n):
        lang = rng.choice(sorted(SYLLABLES))
        words = ["".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 3))) for _ in range(rng.randint(3, 40))]
        rows.append((i, " ".join(words), lang, "s", 0))
    return rows


def test_held_out_accuracy(spark):
    rows = made(600, random.Random(1))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r["doc_id"]: r for r in lid.identify(docs, lid.fit(docs)).collect()}
    held = [r for r in rows if got[r[0]]["held_out"]]
    assert 80 < len(held) < 240
    assert sum(got[r[0]]["lang_pred"] == r[2] for r in held) >= 0.98 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_more_than_64_languages_and_false_positives():
    rng = np.random.default_rng(4)
    found = {f"l{k:03}": rng.integers(0, 1 << 63, 500, np.uint64) for k in range(70)}
    model = lid.build(found, 1 << 13)
    assert model.table.shape == (1 << 13, 2) and 0 < model.noise.max() < 0.05
    for name in ("l000", "l063", "l064", "l069"):
        hashed = found[name]
        masks = [model.table[s] for s in lid._slots(hashed, 1 << 13)]
        k = model.languages.index(name)
        assert (((masks[0] & masks[1] & masks[2])[:, k // 64] >> np.uint64(k % 64)) & np.uint64(1)).all()


def test_odd_rows(spark):
    docs = documents(spark)
    got = lid.identify(docs, lid.fit(docs)).collect()
    assert len(got) == len(ROWS)
    by_id = {r["doc_id"]: r for r in got}
    assert {by_id[i]["lang_pred"] for i in (3, 4, 9)} == {"und"} and by_id[4]["score"] == 0
    assert by_id[None]["held_out"] and by_id[11]["lang_pred"] == by_id[12]["lang_pred"]
    unlabelled = lid.fit(docs.drop("lang").selectExpr("*", "cast(null as string) as lang"))
    assert {r["lang_pred"] for r in lid.identify(docs, unlabelled).collect()} == {"und"}
    assert lid.identify(none(spark), unlabelled).count() == 0
    assert lid.letters("123 ½ _") == "" and lid.letters("Éa1b") == " éa b "
