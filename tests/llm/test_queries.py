"""Queries that SQL can express, against DuckDB; the others are held against brute force in their operator's tests."""

from __future__ import annotations

from collections import Counter

import duckdb
import pytest
from lectern.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    df = queries.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    rel = con.sql(queries.SQL[name])
    assert sorted(rel.columns) == columns
    at = [rel.columns.index(c) for c in columns]
    assert Counter(tuple(r[c] for c in columns) for r in df.collect()) == Counter(
        tuple(r[i] for i in at) for r in rel.fetchall())


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL)))
def test_query_covers_every_document(spark, name):
    ids = Counter(r["doc_id"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect())
    rows = queries.QUERIES[name](spark, SF)
    if name.startswith("op4"):
        rows = rows.filter("piece = 0")
    assert Counter(r["doc_id"] for r in rows.select("doc_id").collect()) == ids
