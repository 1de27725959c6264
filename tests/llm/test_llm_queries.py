"""Registered queries against their SQL, and the pipeline end to end."""

import os

import duckdb
import pytest

import corpus_pipeline
from feederlens.llm import oracle, queries

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(oracle.sql()))
def test_query_against_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    df = queries.queries()[name](spark, SF_DIR)
    result = con.execute(oracle.sql()[name])
    columns = [c[0] for c in result.description]
    order = sorted(columns)
    want = sorted((tuple(r[columns.index(c)] for c in order) for r in result.fetchall()), key=str)
    assert sorted(df.columns) == order
    assert sorted((tuple(r[c] for c in order) for r in df.collect()), key=str) == want


@pytest.mark.parametrize("name", sorted(set(queries.queries()) - set(oracle.sql())))
def test_query_without_sql_covers_its_table(spark, name):
    """Their rows are held against brute force on fixtures; here each runs over its whole table."""
    df = queries.queries()[name](spark, SF_DIR)
    table, key = ("embeddings", "vec_id") if "vec_id" in df.columns else ("documents", "doc_id")
    want = sorted(r[0] for r in spark.read.parquet(f"{SF_DIR}/{table}.parquet").select(key).collect())
    got = df.where("piece = 0") if "piece" in df.columns else df
    assert sorted(r[0] for r in got.select(key).collect()) == want


def test_pipeline_keeps_one_of_each(spark):
    out = corpus_pipeline.run(spark, SF_DIR).collect()
    assert out and len({(r.doc_id, r.piece) for r in out}) == len(out)
    assert max(r.offset + r.length for r in out) <= 4096
