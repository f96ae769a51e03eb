"""Plans of registered queries: how often a base table is scanned."""

from __future__ import annotations

import pytest

from lectern.plans.catalog import QUERIES

from .conftest import SF_SMALL


def scans(df, table: str) -> int:
    """Scans of a base table in the optimized plan."""
    return sum(f"{table}.parquet" in f for f in _relations(df))


def _relations(df) -> list[str]:
    out, todo = [], [df._jdf.queryExecution().optimizedPlan()]
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName() == "LogicalRelation":
            paths = node.relation().location().rootPaths()
            out += [paths.apply(i).toString() for i in range(paths.size())]
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return out


@pytest.mark.parametrize("name", ["dq_not_null", "dq_unique", "dq_accepted_values", "dq_relationships"])
def test_data_tests_read_staged_models(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    assert scans(df, "lineitem") <= 2 and scans(df, "orders") == 0


def test_the_genre_mart_is_one_pass_over_the_enriched_items(spark):
    once = QUERIES["enriched_items"](spark, SF_SMALL)
    for name in ("genre_performance", "legacy_genre_summary", "genre_strategy"):
        df = QUERIES[name](spark, SF_SMALL)
        assert scans(df, "lineitem") <= scans(once, "lineitem"), name


def test_layer_counts_come_from_footers(spark, tmp_path):
    from lectern.operators import report
    rows = spark.range(1000).selectExpr("if(id % 10 = 0, null, cast(id AS string)) AS book_id", "id AS x")
    rows.write.parquet(str(tmp_path / "a"))
    rows.limit(0).write.parquet(str(tmp_path / "b"))
    df = report.layer_quality_of_files(spark, [("a", str(tmp_path / "a")), ("b", str(tmp_path / "b"))])
    plan = report.footer_counts(spark, str(tmp_path / "a"), "book_id")._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), COUNT(book_id)]" in plan
    assert {tuple(r) for r in df.collect()} == {("a", 1000, 100), ("b", 0, 0)}
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"      # the caller's session is as it was
