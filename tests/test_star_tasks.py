"""The number of tasks that order lines are dealt to grows with the lines; the rows stay the same."""

from __future__ import annotations

import datetime as dt

import pytest

from lectern.sources import star

LINES = 900


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("star"))
    lines = [(None if i % 97 == 0 else i // 4, None if i % 31 == 0 else i % 40, i % 6, i % 4 + 1, float(i % 50), 9.5 * i,
              dt.datetime(1995, 1, 1) + dt.timedelta(days=i)) for i in range(LINES)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                          "l_extendedprice double, l_shipdate timestamp").write.parquet(f"{root}/lineitem.parquet")
    spark.createDataFrame([(i, i % 7) for i in range(LINES // 4)], "o_orderkey long, o_custkey long").write.parquet(
        f"{root}/orders.parquet")
    spark.createDataFrame([(i, f"part {i}", f"TYPE {i % 3}", i % 50 + 1) for i in range(45)],
                          "p_partkey long, p_name string, p_type string, p_size int").write.parquet(f"{root}/part.parquet")
    spark.createDataFrame([(i, star.SEGMENTS[i % 5]) for i in range(7)], "c_custkey long, c_mktsegment string").write.parquet(
        f"{root}/customer.parquet")
    return root


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("build", [star.raw_items, star.raw_reviews, star.raw_genres], ids=lambda f: f.__name__)
def test_more_lines_are_dealt_to_more_tasks(spark, tables, monkeypatch, build):
    few = build(spark, tables)
    before = sorted(map(repr, few.collect()))
    monkeypatch.setattr(star, "LINES_PER_TASK", 30)
    many = build(spark, tables)
    key = "l_partkey" if build is star.raw_items else "l_orderkey"
    number = f"hashpartitioning({key}#"
    assert any(number in line and ", 30)" in line for line in _plan(many).splitlines())
    assert sorted(map(repr, many.collect())) == before and before


def test_few_lines_keep_the_sessions_number(spark, tables):
    lines = star.table(spark, tables, "lineitem")
    assert star.dealt(lines, "l_partkey") is lines


def test_lines_are_dealt_by_customer_too(spark, tables, monkeypatch):
    before = sorted(map(repr, star.raw_genres(spark, tables).collect()))
    monkeypatch.setattr(star, "LINES_PER_TASK", 30)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # as with many customers
    try:
        genres = star.raw_genres(spark, tables)
        numbers = [line for line in _plan(genres).splitlines() if "hashpartitioning(o_custkey#" in line]
        after = sorted(map(repr, genres.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert numbers and all(", 30)" in line for line in numbers)
    assert after == before and before
