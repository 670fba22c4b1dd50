"""Queries that SQL can express, against it; and all queries on whole tables, by brute force."""

import os
import sys
from pathlib import Path

import duckdb
import pytest
from helpers import held_out, near_duplicates, substrings, unigrams

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from test_queries import TABLES, table  # noqa: E402

from dockhand.llm.queries import QUERIES, SQL  # noqa: E402

SF_DIR = os.environ.get("QUERY_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, duck, name):
    frame, result = QUERIES[name](spark, SF_DIR), duck.execute(SQL[name])
    assert table(frame.columns, [tuple(r) for r in frame.collect()]) == table([c[0] for c in result.description], result.fetchall())


@pytest.fixture(scope="module")
def documents(duck):
    return duck.execute("SELECT doc_id, text FROM documents").fetchall()


def rows(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=str)


def test_substrings(spark, documents):
    assert rows(QUERIES["op4_substring_dedup"](spark, SF_DIR), "doc_id", "n_words", "n_removed", "kept_sha256") == substrings(documents)


def test_near_duplicates(spark, documents):
    assert rows(QUERIES["op9_minhash_dedup"](spark, SF_DIR), "doc_id", "n_shingles", "component_id", "kept") == near_duplicates(documents, 2)


def test_scores(spark, documents):
    expected = unigrams(documents, lambda d: not held_out(d, 7, 2))
    found = QUERIES["op7_lm_scoring"](spark, SF_DIR).collect()
    got = sorted((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found)
    assert got == sorted((d, held_out(d, 7, 2), *expected[i][:3], round(expected[i][3], 6)) for i, (d, _) in enumerate(documents))


def test_languages_of_held_out_documents(spark, duck):
    langs = dict(duck.execute("SELECT doc_id, lang FROM documents").fetchall())
    found = [r for r in QUERIES["op1_language_id"](spark, SF_DIR).collect() if r.held_out]
    assert sum(langs[r.doc_id] == r.lang_pred for r in found) >= 0.95 * len(found) > 0
