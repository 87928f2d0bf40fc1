"""The registered queries: their names, columns and, where there is one, their SQL."""

import importlib
import re
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver
from subtally.llm import queries

COLUMNS = {
    1: "doc_id held_out lang_pred score",
    2: "doc_id n_tokens ids_sha256 decoded_sha256",
    3: "doc_id held_out n_tokens n_known train_tokens base_score score",
    4: "page_id host path rule verdict",
    5: "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    6: "query_id rank vec_id score",
    7: "doc_id start end n_words first_doc_id",
    8: "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    9: "doc_id n_assign n_access n_hex base_sha256 spans",
    10: "doc_id fingerprint component_id",
    11: "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256",
    12: "item_id rank doc_id score",
    13: "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars",
}


def test_every_operator_and_the_pipeline_are_registered():
    found = {name: m for name in driver.queries() if (m := re.match(r"op(\d+)_", name))}
    assert sorted(int(m[1]) for m in found.values()) == sorted(COLUMNS)
    assert "pipeline" in driver.queries()
    assert set(queries.statements()) <= set(queries.queries())


@pytest.mark.parametrize("number", [2, 5, 7, 9])
def test_columns(spark, sf_dir, number):
    name = next(n for n in queries.queries() if n.startswith(f"op{number}_"))
    frame = queries.queries()[name](spark, sf_dir)
    assert set(COLUMNS[number].split()) <= set(frame.columns)
    assert frame.count() > 0


@pytest.mark.parametrize("name", sorted(queries.statements()))
def test_queries_match_their_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "conversations", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    frame = queries.queries()[name](spark, sf_dir)
    columns = sorted(frame.columns)
    want = con.sql(queries.statements()[name])
    assert columns == sorted(want.columns)
    got = sorted(map(str, (tuple(r[c] for c in columns) for r in frame.collect())))
    places = [want.columns.index(c) for c in columns]
    assert got == sorted(map(str, (tuple(r[i] for i in places) for r in want.fetchall())))


def test_native_operators_run_no_python(spark, sf_dir):
    for name in ("op4_url_filters", "op9_secret_scans", "op13_chat_formatting"):
        plan = queries.queries()[name](spark, sf_dir)
        text = plan._jdf.queryExecution().toString()
        assert not re.search("Python|Pandas|Arrow", text)


def test_nothing_else_imports_the_subpackage():
    root = Path(driver.__file__).parent
    for file in [*root.glob("subtally/**/*.py"), *root.glob("*.py")]:
        if "llm" not in file.parts and file.name not in ("__spark_entry__.py", "corpus_pipeline.py"):
            assert "subtally.llm" not in file.read_text(), file


def test_the_entry_works_without_the_subpackage(monkeypatch):
    monkeypatch.setattr(importlib.util, "find_spec", lambda name: None)
    assert not any(name.startswith("op") or name == "pipeline" for name in driver.queries())
    assert "op6_top_k" not in driver.oracle_sql()
