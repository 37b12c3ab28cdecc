"""Every registered query with an SQL twin must return the same rows as DuckDB."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from hostpulse.registry import QUERIES
from tools.check_oracles import normal

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        connection.execute(f"create view {path.stem} as select * from '{path}'")
    return connection


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_equals_sql(spark, db, name):
    ours, theirs = normal(queries()[name](spark, SF).toPandas()), normal(db.sql(oracle_sql()[name]).df())
    assert ours[0] == theirs[0]
    assert ours[1] == theirs[1]


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_twin_has_a_query():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("gone", [["hostpulse/llm"], ["hostpulse/llm", "corpus_pipeline.py"], ["corpus_pipeline.py"]])
def test_the_engine_stands_without_the_corpus_queries(tmp_path, gone):
    """In a tree without them the other queries are registered, and nothing fails to import."""
    root = Path(__file__).resolve().parents[1]
    shutil.copytree(root, tmp_path / "tree", ignore=shutil.ignore_patterns(".git", "__pycache__", ".pytest_cache", "*.json", *[
        Path(g).name for g in gone
    ]))
    code = "import __spark_entry__ as e; print(*sorted(e.queries()), sep='\\n')"
    run = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "tree", capture_output=True, text=True, env={**os.environ, "PYTHONPATH": "."})
    assert run.returncode == 0, run.stderr
    names = set(run.stdout.split())
    assert set(QUERIES) <= names and "pipeline" not in names
    assert any(n.startswith("op") for n in names) == ("hostpulse/llm" not in gone and (root / "hostpulse/llm").exists())
