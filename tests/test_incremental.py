"""Incremental Silver and incremental tests: equal to full builds, reading and replacing only what a batch touches."""

from __future__ import annotations

import hashlib
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lectern.config import DEFAULT
from lectern.operators import enrich, quality
from lectern.plans import incremental as N
from lectern.plans import layers as L
from lectern.plans.incremental_tests import IncrementalTests
from lectern.sources import jsonl
from lectern.streaming import ingest as I

from .conftest import add_second_batch, book, review, write_jsonl


def rows_of(df) -> list[str]:
    keep = sorted(c for c in df.columns if not c.startswith("_"))
    return sorted(map(repr, df.select(*keep).collect()))


def same_as_full(spark, layout, silver):
    """Every Silver table equals that of a full build over the same Bronze."""
    L.build_silver(spark, layout, DEFAULT)
    full = {n: spark.read.parquet(layout.silver(n)) for n in ("stg_books", "stg_reviews", "stg_genres", "int_books_enriched")}
    mine = {"stg_books": silver.stg_books(), "stg_reviews": silver.stg_reviews(), "stg_genres": silver.stg_genres(),
            "int_books_enriched": silver.enriched()}
    for name, df in full.items():
        assert set(mine[name].columns) == set(df.columns), name
        assert rows_of(mine[name]) == rows_of(df), name


def state_files(silver, state) -> dict[str, bytes]:
    return {str(p.relative_to(state.path)): p.read_bytes() for p in Path(state.path).rglob("part-*.parquet")}


def ingest(spark, layout, batch):
    return L.ingest_bronze(spark, layout, batch_id=batch)


def test_three_batches_equal_a_full_build(spark, raw_catalogue, tmp_path):
    layout = L.Layout(str(raw_catalogue), str(tmp_path / "lake"), exclude=jsonl.SAMPLE_SUFFIX)
    silver = N.IncrementalSilver(spark, str(tmp_path / "state"), buckets=8)
    ingest(spark, layout, "b1")
    assert silver.refresh_from(layout.bronze)["books"] == 14
    same_as_full(spark, layout, silver)
    assert set(silver.refresh_from(layout.bronze).values()) == {0}          # nothing new, nothing read
    add_second_batch(raw_catalogue)
    write_jsonl(raw_catalogue / "reviews", "part2.json", [review("n1", "1", "u9", 2), review("n2", "9", "u1", 5, "2001-02-03")])
    ingest(spark, layout, "b2")
    silver.refresh_from(layout.bronze)
    same_as_full(spark, layout, silver)
    # a newer version without a title takes item 1 out, and an item comes that has had reviews for long
    write_jsonl(raw_catalogue / "books", "part3.json", [book("1", None), book("404", "Found")])
    ingest(spark, layout, "b3")
    silver.refresh_from(layout.bronze)
    same_as_full(spark, layout, silver)
    found = {r.book_id: r for r in silver.enriched().collect()}
    assert "1" not in found and found["404"].total_reviews == 1


def test_a_batch_replaces_only_the_buckets_it_touches(spark, tmp_path):
    silver = N.IncrementalSilver(spark, str(tmp_path / "state"), buckets=32)
    raw = tmp_path / "raw"
    write_jsonl(raw / "books", "a.json", [book(str(i)) for i in range(200)])
    write_jsonl(raw / "reviews", "a.json", [review(f"r{i}", str(i % 200)) for i in range(400)])
    write_jsonl(raw / "genres", "a.json", [{"book_id": "1", "genres": {"poetry": 3}}])
    layout = L.Layout(str(raw), str(tmp_path / "lake"))
    ingest(spark, layout, "b1")
    silver.refresh_from(layout.bronze)
    states = {s: state_files(silver, s) for s in (silver.items, silver.sums, silver.rows)}
    write_jsonl(raw / "reviews", "b.json", [review("new", "7", rating=1)])
    ingest(spark, layout, "b2")
    opened = []
    real = N.BucketState.read

    def spy(self, buckets=None):
        rows = real(self, buckets)
        if rows is not None:
            opened.append((Path(self.path).name, {f.split("_bucket=")[1].split("/")[0] for f in rows.inputFiles()}, buckets))
        return rows
    N.BucketState.read = spy
    try:
        silver.refresh_from(layout.bronze)
    finally:
        N.BucketState.read = real
    touched = silver.items.touched(spark.createDataFrame([("7",)], "book_id string"))
    assert opened and all(set(b) == touched for _, _, b in opened)           # one bucket of each state is asked for
    assert "items" in {n for n, _, _ in opened}
    for state, before in states.items():
        after = state_files(silver, state)
        changed = {p.split("/")[0] for p in {*before, *after} if before.get(p) != after.get(p)}
        assert changed <= {f"_bucket={b}" for b in touched}, Path(state.path).name
    assert silver.enriched().filter("book_id = '7'").first().total_reviews == 3


def test_a_batch_that_comes_again_changes_nothing(spark, tmp_path):
    silver = N.IncrementalSilver(spark, str(tmp_path / "state"), buckets=4)
    books = spark.createDataFrame([("1", "t", "4.0", 10)], "book_id string, title string, average_rating string, ratings_count long")
    books = books.selectExpr("*", "'9' AS text_reviews_count", "'100' AS num_pages", "array(named_struct('author_id', 'a')) AS authors",
                             "array(named_struct('name', 's')) AS popular_shelves", "1L AS _row_hash",
                             "timestamp'2024-01-01' AS _ingestion_timestamp")
    reviews = spark.createDataFrame([("r1", "1", "u", 5, "2024-01-01"), ("r2", "1", "v", 2, "2024-01-02")],
                                    "review_id string, book_id string, user_id string, rating long, date_added string")
    genres = spark.createDataFrame([("1", 3, 3)], "book_id string, genre_b long, genre_a long")
    new = {"books": books, "reviews": reviews, "genres": genres}
    silver.refresh(new, 0)
    once = rows_of(silver.enriched())
    silver.refresh(new, 0)
    assert rows_of(silver.enriched()) == once and silver.review_metrics().first().total_reviews == 2
    assert silver.stg_genres().first().primary_genre == "a"                  # ties go to the smaller name
    silver.refresh({"reviews": reviews}, 1)
    assert silver.review_metrics().first().total_reviews == 4


@pytest.mark.parametrize("moves", [0, 1, 2])
def test_a_replacement_cut_off_is_finished(spark, tmp_path, moves, monkeypatch):
    state = N.BucketState(spark, str(tmp_path / "s"), "k", buckets=4)
    put = lambda lo, hi, v: spark.range(lo, hi).selectExpr("cast(id AS string) AS k", f"{v} AS v")
    state.merge(put(0, 40, 1), lambda d: d.groupBy("k").agg(F.max("v").alias("v")))
    real = N.governance.remove
    calls = []

    class Lost(Exception):
        pass
    fs_of = N.governance._fs

    def failing_fs(spark_, path):
        if "_bucket=" in path and "__staging" not in path:
            calls.append(path)
            if len(calls) > moves:
                raise Lost(path)
        return fs_of(spark_, path)
    monkeypatch.setattr(N.governance, "_fs", failing_fs)
    with pytest.raises(Lost):
        state.merge(put(0, 20, 2), lambda d: d.groupBy("k").agg(F.max("v").alias("v")))
    monkeypatch.setattr(N.governance, "_fs", fs_of)
    got = {r.k: r.v for r in state.read().collect()}                       # reading finishes it
    assert got == {str(i): 2 if i < 20 else 1 for i in range(40)} and real is N.governance.remove
    state.replace(put(0, 0, 1), [0, 1, 2, 3])
    assert state.read() is None or state.read().count() == 0


def test_incomplete_staging_is_dropped(spark, tmp_path):
    state = N.BucketState(spark, str(tmp_path / "s"), "k", buckets=2)
    state.merge(spark.createDataFrame([("a", 1)], "k string, v int"), lambda d: d)
    spark.createDataFrame([("z", 9, 0)], "k string, v int, _bucket int").write.partitionBy("_bucket").parquet(state.staging)
    assert [r.k for r in state.read().collect()] == ["a"] and not Path(state.staging).exists()


def test_an_erasure_reaches_the_states(spark, raw_catalogue, tmp_path):
    layout = L.Layout(str(raw_catalogue), str(tmp_path / "lake"), exclude=jsonl.SAMPLE_SUFFIX)
    L.run_incremental(spark, layout, DEFAULT, gate=False, batch_id="b1")
    write_jsonl(raw_catalogue / "reviews", "part2.json", [review("n1", "1", "u9", 2), review("n2", "2", "u1", 5)])
    L.run_incremental(spark, layout, DEFAULT, gate=False, batch_id="b2")
    silver = L.silver_states(spark, layout)
    same_as_full(spark, layout, silver)
    h = hashlib.sha256(b"u1").hexdigest()
    rep = L.rebuild_after_erasure(spark, layout, [h, None], gate=False, incremental=True)
    assert rep.erased.rows == 4 and len(rep.tests) == 43
    assert silver.stg_reviews().filter(F.col("user_id_hashed") == h).count() == 0
    same_as_full(spark, layout, silver)
    write_jsonl(raw_catalogue / "reviews", "part3.json", [review("n3", "2", "u1", 5), review("n4", "2", "u2", 4)])
    L.run_incremental(spark, layout, DEFAULT, gate=False, batch_id="b3")
    same_as_full(spark, layout, silver)


def test_incremental_tests_equal_a_full_run(spark, tmp_path):
    rng = random.Random(2)
    silver = N.IncrementalSilver(spark, str(tmp_path / "state"), buckets=8)
    tests = IncrementalTests(silver)
    raw = tmp_path / "raw"
    layout = L.Layout(str(raw), str(tmp_path / "lake"))
    for k in range(3):
        write_jsonl(raw / "books", f"{k}.json", [book(
            rng.choice([None, *map(str, range(60))]), rng.choice([None, "t"]), rng.choice(["4.0", "x", "0"])) for _ in range(40)])
        write_jsonl(raw / "reviews", f"{k}.json", [review(
            rng.choice([None, *[f"r{i}" for i in range(40)]]), rng.choice([None, *map(str, range(90))]),
            rating=rng.choice([1, 5, 9, None])) for _ in range(80)])
        write_jsonl(raw / "genres", f"{k}.json", [{"book_id": rng.choice([None, "1", "2", "70"]), "genres": {"poetry": k}}
                                                  for _ in range(5)])
        ingest(spark, layout, f"b{k}")
        new = {n: I.read_bronze(spark, layout.bronze(n)).filter(F.col("_epoch") == k) for n in ("books", "reviews", "genres")}
        for _ in range(2 if k == 1 else 1):                               # the second batch comes twice
            touched = silver.refresh(new, k)
            tests.update({**{f"bronze_{n}": df for n, df in new.items()}, "stg_reviews": silver.reviews_of(k)}, touched, k)
        tables = L._state_tables(spark, layout, silver)
        full = quality.run_tests(tables, tests.tests)
        assert rows_of(tests.report()) == rows_of(full), k
    assert {r.status for r in tests.report().collect()} == {"pass", "fail", "warn"}


def test_bucketed_tables_are_joined_without_an_exchange(spark):
    items = spark.range(50).selectExpr(
        "cast(id AS string) AS book_id", "'t' AS title", "'a' AS primary_author_id", "4.0D AS average_rating", "5L AS ratings_count",
        "6L AS text_reviews_count", "7 AS num_pages", "'l' AS language_code", "'p' AS publisher", "'f' AS format",
        "'d' AS description", "'q' AS data_quality_flag", "'s' AS shelf_genre", "current_timestamp() AS _ingestion_timestamp")
    genres = spark.range(20).selectExpr("cast(id AS string) AS book_id", "'g' AS primary_genre")
    reviews = spark.range(300).selectExpr("cast(id AS string) AS review_id", "cast(id % 40 AS string) AS book_id",
                                          "cast(id % 5 AS int) AS rating", "'positive' AS sentiment", "current_date() AS review_date")
    tables = {"b_items": items, "b_genres": genres, "b_metrics": enrich.review_metrics(reviews)}
    report = jsonl.register_tables(spark, tables, bucket_by="book_id", buckets=4)
    assert [(r["rows"], r["error"]) for r in report] == [(50, None), (20, None), (40, None)]
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = enrich.enrich_items(*[spark.table(n) for n in tables])
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert rows_of(joined) == rows_of(enrich.enrich_items(items, genres, tables["b_metrics"]))
        counts = spark.table("b_metrics").groupBy("book_id").count()
        assert "Exchange" not in counts._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
