import random

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from hostpulse.llm import queries
from hostpulse.llm.tokens import END, tokenizer_path
from llm_cases import DOCUMENTS


def body(rng, n=70):
    return " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))


def corpus():
    """Documents with what each stage has to catch, and the texts that are left, by id."""
    rng = random.Random(12)
    rows = [(i, body(rng) + "\nsubscribe to our letter", f"site{i % 7}") for i in range(14)]
    left = {i: t if i == 0 else t.split("\n")[0] for i, t, _ in rows}
    rows += [(20, "too short", "a"), (21, body(rng) + " # " * 40, "a"), (22, None, "a")]
    base = body(rng, 120)
    words = base.split()
    rows += [(30, base, "a"), (31, base, "b"), (32, " ".join([*words[:-1], "changed"]), "c")]
    left[30] = base
    item = body(rng, 14)
    rows += [(40, body(rng) + " " + item.upper() + " " + body(rng, 9), "a")]
    rows += [(50, body(rng, 900), "a")]
    left[50] = rows[-1][1]
    return [(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows], [(1, item)], left


def test_pipeline_keeps_the_clean_documents_whole(spark, tmp_path):
    rows, items, left = corpus()
    spark.createDataFrame(rows, DOCUMENTS).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    tokenizer = Tokenizer.from_file(tokenizer_path())
    found = {}
    for r in sorted(pieces, key=lambda r: (r["doc_id"], r["start"])):
        found.setdefault(r["doc_id"], []).extend(np.frombuffer(r["ids"], "<u4").tolist())
    assert {i: [*tokenizer.encode(t, add_special_tokens=False).ids, END] for i, t in left.items()} == found


def test_stages_return_the_columns_of_documents(spark, tmp_path):
    rows, items, _ = corpus()
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.createDataFrame(rows, DOCUMENTS)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0


def test_every_operator_has_one_query():
    numbers = [int(name[2:].split("_")[0]) for name in queries.QUERIES]
    assert sorted(numbers) == list(range(1, 14)) and set(queries.ORACLES) <= set(queries.QUERIES)
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "line_dedup", "near_dedup", "decontamination", "best_fit_packing"
    ]
