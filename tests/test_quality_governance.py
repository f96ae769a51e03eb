"""Data tests and contracts (Q1-Q6), compliance jobs (F16, G1-G9), text."""

from __future__ import annotations

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from lectern.operators import governance as G
from lectern.operators import quality as Q
from lectern.operators import text as X
from lectern.session import scratch_path


def test_declared_suite_is_43():
    kinds = [t.kind for t in Q.declared_tests()]
    assert len(kinds) == 43
    assert (kinds.count("not_null"), kinds.count("unique"), kinds.count("accepted_values"),
            kinds.count("relationships")) == (32, 6, 4, 1)


def test_run_tests_and_gate(spark):
    books = spark.createDataFrame([("1", "t", 4.0, 10, "high_confidence"),
                                   ("1", None, 4.0, 10, "weird"),
                                   (None, "t", 4.0, 10, None)],
                                  "book_id string, title string, average_rating double, "
                                  "ratings_count bigint, data_quality_flag string")
    reviews = spark.createDataFrame([("r1", "1", "h", 5, "positive"), ("r2", "9", "h", 4, "positive")],
                                    "review_id string, book_id string, user_id_hashed string, "
                                    "rating int, sentiment string")
    whole = Q.run_tests({"stg_books": books, "stg_reviews": reviews})
    rep = {r.test: r for r in whole.collect()}
    assert len(rep) == 43                                          # none is left out
    assert rep["not_null_mart_genre_performance_genre"].status == "error"
    with pytest.raises(Q.DataTestError, match="not run"):
        Q.gate(whole)
    there = [t for t in Q.declared_tests() if rep[t.name].status != "error"]
    assert rep["not_null_stg_books_book_id"].failures == 1
    assert rep["not_null_stg_books_title"].failures == 1
    assert rep["unique_stg_books_book_id"].failures == 1          # NULLs are ignored
    assert rep["accepted_values_stg_books_data_quality_flag"].failures == 1   # NULL ignored
    assert rep["relationships_stg_reviews_book_id"].failures == 1
    assert rep["relationships_stg_reviews_book_id"].status == "warn"
    with pytest.raises(Q.DataTestError, match="unique_stg_books_book_id"):
        Q.gate(Q.run_tests({"stg_books": books, "stg_reviews": reviews}, [t for t in there if t.kind == "unique"]))
    ok = Q.gate(Q.run_tests({"stg_reviews": reviews.filter("book_id = '1'"),
                             "stg_books": books.filter("title is not null and book_id is not null")}, there))
    assert all(r["status"] != "fail" for r in ok)


def test_warn_does_not_stop(spark):
    reviews = spark.createDataFrame([("r1", "404", "h", 5, "positive")],
                                    "review_id string, book_id string, user_id_hashed string, "
                                    "rating int, sentiment string")
    books = spark.createDataFrame([("1", "t", 4.0, 10, "low_confidence")],
                                  "book_id string, title string, average_rating double, "
                                  "ratings_count bigint, data_quality_flag string")
    tests = [t for t in Q.declared_tests() if t.kind == "relationships"]
    rows = Q.gate(Q.run_tests({"stg_books": books, "stg_reviews": reviews}, tests))
    assert [r["status"] for r in rows if r["kind"] == "relationships"] == ["warn"]


def test_contracts(spark):
    df = spark.createDataFrame([("1", "g")], "book_id string, primary_genre string")
    assert Q.enforce_contract(df, "stg_genres") is df
    with pytest.raises(Q.ContractError, match="missing column primary_genre"):
        Q.enforce_contract(df.drop("primary_genre"), "stg_genres")
    with pytest.raises(Q.ContractError, match="undeclared"):
        Q.enforce_contract(df.withColumn("x", F.lit(1)), "stg_genres")
    bad = df.withColumn("primary_genre", F.lit(1))
    assert Q.contract_violations(bad, Q.CONTRACTS["stg_genres"]) == [
        "primary_genre: int is not string"]
    dec = spark.createDataFrame([(1.5,)], "p double").select(F.col("p").cast("decimal(27,2)"))
    assert Q.contract_violations(dec, {"p": "decimal"}) == []


REVIEWS = "review_id string, book_id string, user_id string, rating bigint"


def test_lookup_and_erasure(spark):
    df = spark.createDataFrame([("r1", "b", "7", 5), ("r2", "b", "8", 4), ("r3", "b", None, 3)],
                               REVIEWS)
    h7 = hashlib.sha256(b"7").hexdigest()
    assert [r.review_id for r in G.subject_lookup(df, [h7]).collect()] == ["r1"]
    once = G.erase_subjects(df, [h7])
    assert sorted(r.review_id for r in once.collect()) == ["r2", "r3"]
    twice = G.erase_subjects(once, [h7])
    assert sorted(r.review_id for r in twice.collect()) == ["r2", "r3"]   # idempotent
    many = [hashlib.sha256(str(i).encode()).hexdigest() for i in range(20_000)]
    assert sorted(r.review_id for r in G.erase_subjects(df, many).collect()) == ["r3"]
    # A NULL request names nobody; hashes match in either case; none of that depends on the list's length.
    for extra in ([], [f"{i:064x}" for i in range(20_000)]):
        req = [None, h7.upper(), *extra]
        assert sorted(r.review_id for r in G.erase_subjects(df, req).collect()) == ["r2", "r3"]
        assert [r.review_id for r in G.subject_lookup(df, req).collect()] == ["r1"]
    assert G.erase_subjects(df, [None]).count() == 3


def test_layer_privacy(spark):
    df = spark.createDataFrame([("1", "7")], "book_id string, user_id string")
    with pytest.raises(ValueError):
        G.assert_no_columns(df, ["user_id"], "gold")


def test_snapshots_history_asof_vacuum(spark):
    root = scratch_path(spark, "test_snap")
    df = spark.createDataFrame([("r1", "b", "7", 5), ("r2", "b", "8", 4)], REVIEWS)
    t0 = dt.datetime(2024, 1, 1)
    v0 = G.write_snapshot(df, root, "CREATE OR REPLACE", now=t0)
    v1 = G.write_snapshot(df.limit(1), root, "WRITE", now=t0 + dt.timedelta(days=10))
    v2 = G.erase_and_commit(spark, root, [hashlib.sha256(b"7").hexdigest()])
    assert v0 == 1_704_067_200_000_000 < v1 < v2 == G.latest_version(spark, root)
    hist = {r.version: (r.timestamp, r.operation, r.rows) for r in G.history(spark, root).collect()}
    assert hist[v0] == (t0, "CREATE OR REPLACE", 2) and hist[v2][1:] == ("DELETE", 0)
    asof = G.read_version(spark, root, v0)
    assert asof.count() == 2 and asof.columns == df.columns
    with pytest.raises(Exception, match="exists"):
        G.write_snapshot(df, root, "CREATE OR REPLACE", now=t0)
    # a load that failed is no version
    failed = f"{root}/_loaded_at=1735689600000000/_operation=WRITE"
    df.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(failed)
    assert G.latest_version(spark, root) == v2 and len(G.history(spark, root).collect()) == 3
    assert G.vacuum(spark, root, retain_days=7, now=t0 + dt.timedelta(days=12)) == [v0]
    assert {r.version for r in G.history(spark, root).collect()} == {v1, v2}
    for missing in (v0, 7):                       # removed, never written
        with pytest.raises(ValueError):
            G.read_version(spark, root, missing)
    assert G.history(spark, scratch_path(spark, "none")).count() == 0


def test_each_version_keeps_its_own_columns(spark):
    root = scratch_path(spark, "test_columns")
    first = G.write_snapshot(spark.createDataFrame([(1, 2)], "id int, x int"), root)
    G.write_snapshot(spark.createDataFrame([(1, 2, 3)], "id int, x int, y int"), root)
    assert G.read_version(spark, root, first).columns == ["id", "x"]
    assert G.read_version(spark, root).columns == ["id", "x", "y"]


def test_audit_log_nested_and_ordered(spark):
    ev = spark.createDataFrame(
        [(1, dt.datetime(2024, 1, 20), "click", 1.0, '{"k": 5}'),
         (2, dt.datetime(2024, 1, 21), "view", 2.0, '{"k": 6}'),
         (3, dt.datetime(2024, 1, 22), "checkout", 3.0, '{"k": 7}'),
         (4, dt.datetime(2024, 1, 1), "click", 4.0, '{"k": 8}')],
        "user_id bigint, ts timestamp_ntz, event_type string, value double, props string")
    out = G.audit_log(ev, "c", "2024-01-15 00:00:00", prefix_on="action").collect()
    assert [(r.user, r.table_accessed) for r in out] == [(3, 7), (1, 5)]
    nested = ev.selectExpr("user_id AS who", "ts AS at", "event_type AS did",
                           """concat('{"req": {"name": "cat.t', user_id, '"}}') AS req""")
    out = G.audit_log(nested, "cat.t", "2024-01-15 00:00:00", user="who", time="at", action="did", params="req",
                      schema="req struct<name: string>", table="req.name", extra=()).collect()
    assert [(r.user, r.table_accessed) for r in out] == [(3, "cat.t3"), (2, "cat.t2"), (1, "cat.t1")]


DOCS = [(1, "The narrator's voice was lovely, a great audio experience."),
        (2, "Too slow for my taste, boring to listen to on a commute."),
        (3, "Short."), (4, None)]


def test_text_signals_and_long_texts(spark):
    df = spark.createDataFrame(DOCS, "review_id long, review_text string")
    out = {r.review_id: r for r in X.text_signals(df).collect()}
    assert out[1].mentions_narrator and not out[1].audiobook_risk
    assert out[2].mentions_pacing and out[2].audiobook_risk
    assert not out[4].mentions_narrator
    assert [r.review_id for r in X.long_texts(df).collect()] == [1, 2]


def test_fuse_sentiment(spark):
    sig = X.text_signals(spark.createDataFrame(DOCS, "review_id long, review_text string"))
    nlp = spark.createDataFrame([(1, "pos"), (2, "pos"), (3, "neg"), (4, "other")],
                                "review_id long, nlp_sentiment string")
    out = {r.review_id: r.final_sentiment for r in X.fuse_sentiment(nlp, sig).collect()}
    assert out == {1: "positive", 2: "negative", 3: "negative", 4: "neutral"}


def test_label_sentiment(spark):
    labels = spark.createDataFrame([(1, 1, 1), (2, 1, 0), (3, 0, 0)],
                                   "doc_id long, quality int, toxic int")
    out = {r.doc_id: r.nlp_sentiment for r in X.label_sentiment(labels).collect()}
    assert out == {1: "neg", 2: "pos", 3: "neutral"}


def test_retention_by_layer_and_share(spark):
    root = scratch_path(spark, "test_ret")
    df = spark.createDataFrame([("g", 1)], "genre string, n int")
    t0 = dt.datetime(2024, 1, 1)
    first = G.write_snapshot(df, root, now=t0)
    G.write_snapshot(df, root, now=t0 + dt.timedelta(days=1))
    out = G.apply_retention(spark, {"gold_mart": ("gold", root)}, now=t0 + dt.timedelta(days=9))
    assert out == {"gold_mart": [first]}


def test_share_is_built_as_an_aggregate(spark):
    df = spark.createDataFrame([("a", "b1", 1), ("a", "b2", 2), ("b", "b3", 5)], "genre string, book_id string, n int")
    out = G.share(df, ["genre"], {"books": ("count_distinct", "book_id"), "total": ("sum", "n")}, min_rows=2)
    assert [tuple(r) for r in out.collect()] == [("a", 2, 3)]
    for groups, aggs in ((["book_id"], {}), (["genre"], {"some": ("max", "book_id")}), (["genre"], {"x": ("first", "n")}),
                         ([], {"n": ("count", "n")}), (["missing"], {}), (["genre"], {"book_id": ("count", "n")})):
        with pytest.raises(ValueError):
            G.share(df, groups, aggs)


def test_erasure_by_request_table(spark):
    df = spark.createDataFrame([("r1", "b", "7", 5), ("r2", "b", "8", 4)], REVIEWS)
    req = spark.createDataFrame([(hashlib.sha256(b"8").hexdigest(),)], "_erase_hash string")
    assert [r.review_id for r in G.erase_subjects(df, req).collect()] == ["r1"]
