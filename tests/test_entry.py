"""Driver contract: entry(), queries(), oracle_sql() — and every query vs DuckDB at sf0.001."""

from __future__ import annotations

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from lectern.plans.catalog import QUERIES

from .conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()
ROWS_ONLY: set[str] = set()
# Spark simple type → DuckDB type name of the same values.
DUCK_TYPE = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
             "date": "DATE", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == E.entry(spark).columns
    assert not [c for c in df.columns if c.endswith("_timestamp")]


def test_every_query_has_an_oracle_or_is_declared_rows_only():
    assert set(QUERIES) - set(E.oracle_sql()) == ROWS_ONLY
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(QUERIES) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, list):
        return tuple(_norm(x) for x in v)
    return v


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF_SMALL)
    cols = sorted(sdf.columns)
    srows = Counter(tuple(_norm(r[c]) for c in cols) for r in sdf.collect())
    if name in ROWS_ONLY:
        assert sum(srows.values()) > 0
        return
    rel = duck.sql(E.oracle_sql()[name])
    assert sorted(rel.columns) == cols
    stypes = {f.name: DUCK_TYPE.get(f.dataType.simpleString(), f.dataType.simpleString())
              for f in sdf.schema.fields}
    assert stypes == {c: str(t) for c, t in zip(rel.columns, rel.types)}
    idx = [rel.columns.index(c) for c in cols]
    drows = Counter(tuple(_norm(r[i]) for i in idx) for r in rel.fetchall())
    assert srows == drows
