"""Registered queries: SQL at the smallest scale, and the pipeline end to end."""

import duckdb
import pytest

import corpus_pipeline
from ordermill.llm.queries import ORACLE_SQL, QUERIES
from tests.conftest import SF_SMALL


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    want = con.execute(ORACLE_SQL[name])
    cols = [d[0] for d in want.description]
    got = QUERIES[name](spark, SF_SMALL)
    assert sorted(got.columns) == sorted(cols)
    key = lambda r: str(r)
    assert sorted(map(tuple, got.select(*cols).collect()), key=key) == sorted(map(tuple, want.fetchall()), key=key)


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    start = {r["doc_id"]: r["text"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.staged(stage(spark, docs, SF_SMALL), name)
        assert docs.columns == corpus_pipeline.COLUMNS
        ids = [r["doc_id"] for r in docs.select("doc_id").collect()]
        assert len(ids) == len(set(ids)) and set(ids) <= set(start)
    assert len(ids) > 100
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL)
    assert {r["doc_id"] for r in pieces.collect()} == set(ids)
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF_SMALL).count() == 0


def test_near_copies_keep_rows_without_id(spark):
    rows = [(1, "a b c d e f"), (2, "a b c d e f"), (2, "a b c d e f"), (3, "q r s t u v w x y z"), (None, "a b c d e f")]
    frame = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows],
                                  "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.near_copies_stage(spark, frame, SF_SMALL).collect()
    assert sorted(str(r["doc_id"]) for r in kept) == ["1", "3", "None"]


def test_near_copies_of_rows_that_share_an_id(spark):
    texts = {c: " ".join(f"{c}{i * i % 97}" for i in range(40)) for c in "abcd"}
    rows = [(5, "a"), (5, "b"), (5, "b"), (2, "b"), (7, "a"), (7, "c"), (None, "d"), (None, "d")]
    frame = spark.createDataFrame([(i, texts[t], "en", "s", 1) for i, t in rows],
                                  "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.near_copies_stage(spark, frame, SF_SMALL).collect()
    assert sorted(((r["doc_id"], r["text"][0]) for r in kept), key=str) == [(2, "b"), (5, "a"), (7, "c"), (None, "d")]


def test_only_cut_characters_go_with_a_repeat(spark):
    shared = " ".join(f"w{i * i % 89}" for i in range(30))
    rows = [(1, "é" + shared), (2, "�ĩ" + shared + "� end é")]        # both letters end in the same byte
    frame = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows],
                                  "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r["doc_id"]: (r["text"], r["n_chars"]) for r in corpus_pipeline.repeats_stage(spark, frame, SF_SMALL).collect()}
    assert kept == {1: (rows[0][1], len(rows[0][1])), 2: ("�� end é", 8)}
