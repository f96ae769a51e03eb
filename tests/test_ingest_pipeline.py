"""Ingest (S1-S19) and the full native run (M6, G3) on raw JSON-lines fixtures."""

from __future__ import annotations

import gzip
import hashlib
import json
import os
from pathlib import Path

import pytest

from lectern.config import DEFAULT
from lectern.operators import governance as G
from lectern.operators import quality
from lectern.plans import layers as L
from lectern.sources import jsonl
from lectern.streaming import ingest as I

from .conftest import add_second_batch, review, write_jsonl


def test_read_json_lines_permissive_and_samples(spark, raw_catalogue, tmp_path):
    assert jsonl.read_json_lines(spark, str(raw_catalogue / "books")).filter("title = 'Sample'").count() == 1
    df = jsonl.read_json_lines(spark, str(raw_catalogue / "books"), exclude=jsonl.SAMPLE_SUFFIX)
    assert jsonl.CORRUPT in df.columns
    assert df.filter("title = 'Sample'").count() == 0            # left out as asked
    # Rejected lines are counted on the written Bronze table (Spark refuses a
    # raw-JSON query that reads only the corrupt-record column).
    bronze = str(tmp_path / "bronze")
    assert jsonl.write_counted(jsonl.add_audit_columns(df, "b1"), bronze) == 14
    rej = jsonl.rejected_records(spark.read.parquet(bronze)).collect()
    assert len(rej) == 1 and rej[0].rejected == 1 and rej[0].source_file.endswith("part1.json")


def test_corrupt_column_declared_without_bad_lines(spark, tmp_path):
    write_jsonl(tmp_path / "clean", "a.json", [{"a": 1}])
    df = jsonl.read_json_lines(spark, str(tmp_path / "clean"))
    assert jsonl.CORRUPT in df.columns and df.count() == 1


def test_schema_hints(spark, tmp_path):
    write_jsonl(tmp_path / "r", "a.json", [{"rating": 5, "book_id": 7}])
    df = jsonl.read_json_lines(spark, str(tmp_path / "r"), hints="rating STRING, extra INT")
    types = dict(df.dtypes)
    assert types["rating"] == "string" and types["book_id"] == "bigint" and "extra" in types


def test_flatten_and_clean_names(spark):
    df = spark.createDataFrame([("1", (3, 4), "x")],
                               "book_id string, genres struct<`comics, graphic`:int, "
                               "`non-fiction`:int>, `bad name;x` string")
    flat = jsonl.shape_bronze(df.drop("bad name;x"))
    assert flat.columns == ["book_id", "genre_comics_graphic", "genre_non-fiction"]
    assert jsonl.clean_column_names(df.drop("genres")).columns == ["book_id", "bad_name_x"]


def test_inventory_excludes_samples(spark, raw_catalogue):
    folders = {"books": str(raw_catalogue / "books"), "genres": str(raw_catalogue / "genres")}
    assert {r.dataset: r.files for r in jsonl.raw_inventory(spark, folders).collect()} == {"books": 2, "genres": 1}
    inv = {r.dataset: (r.files, r.bytes) for r in
           jsonl.raw_inventory(spark, folders, exclude=jsonl.SAMPLE_SUFFIX).collect()}
    assert inv["books"][0] == 1 and inv["genres"][0] == 1 and inv["books"][1] > 0


def test_write_counted_and_gate(spark, tmp_path):
    n = jsonl.write_counted(spark.range(150), str(tmp_path / "t"), partition_by=())
    assert n == 150
    assert jsonl.row_gate(n, "x")["status"] == "pass"
    assert jsonl.row_gate(50, "x")["status"] == "fail"
    assert jsonl.row_gate(n, "r", warn_below=jsonl.REVIEWS_WARN_BELOW)["status"] == "warn"
    assert jsonl.read_path_sql(spark, str(tmp_path / "t")).count() == 150


def test_incremental_exactly_once_new_columns_and_flatten(spark, raw_catalogue, tmp_path):
    spec = I.IngestSpec("books", str(raw_catalogue / "books"), str(tmp_path / "bronze_books"),
                        str(tmp_path / "ck_books"), exclude=jsonl.SAMPLE_SUFFIX)
    r1 = I.ingest_incremental(spark, spec, "b1")
    assert r1.rows_added == 14                       # 13 books + 1 corrupt line, no sample
    assert I.ingest_incremental(spark, spec, "b2").rows_added == 0
    gspec = I.IngestSpec("genres", str(raw_catalogue / "genres"), str(tmp_path / "bronze_genres"),
                         str(tmp_path / "ck_genres"))
    I.ingest_incremental(spark, gspec, "b1")
    add_second_batch(raw_catalogue)
    r3 = I.ingest_incremental(spark, spec, "b3")
    assert r3.rows_added == 1
    bronze = I.read_bronze(spark, spec.target)
    assert bronze.count() == 15 and "edition" in bronze.columns   # new column after restart
    assert set(r._batch_id for r in bronze.select("_batch_id").distinct().collect()) == {"b1", "b3"}
    assert bronze.filter("_source_file is null").count() == 0
    I.ingest_incremental(spark, gspec, "b2")
    genres = I.read_bronze(spark, gspec.target)
    assert "genres" not in genres.columns                        # flattened on every batch
    assert {"genre_fantasy_paranormal", "genre_comics_graphic", "genre_poetry"} <= set(genres.columns)
    assert genres.count() == 5


def test_plan_records_failures(spark, raw_catalogue, tmp_path):
    specs = [I.IngestSpec("books", str(raw_catalogue / "books"), str(tmp_path / "b"),
                          str(tmp_path / "cb")),
             I.IngestSpec("missing", str(tmp_path / "nope"), str(tmp_path / "m"),
                          str(tmp_path / "cm"))]
    res = {r.name: r for r in I.run_plan(spark, specs, "b1")}
    assert res["books"].total_rows == 15 and res["books"].status == "fail"      # below the row gate
    assert res["missing"].status == "error" and res["missing"].error


def test_full_run_and_erasure(spark, raw_catalogue, tmp_path):
    layout = L.Layout(str(raw_catalogue), str(tmp_path / "lake"), exclude=jsonl.SAMPLE_SUFFIX)
    rep = L.run_all(spark, layout, DEFAULT, gate=False, batch_id="b1")
    assert {r.name: r.status for r in rep.bronze}["reviews"] in ("warn", "fail")
    tests = {r["test"]: r for r in rep.tests}
    assert len(tests) == 43
    assert tests["unique_stg_reviews_review_id"]["failures"] == 1      # r11 twice, by design
    assert tests["relationships_stg_reviews_book_id"]["status"] == "warn"
    assert tests["not_null_bronze_books_title"]["failures"] >= 1

    silver = {r.book_id: r for r in spark.read.parquet(layout.silver("stg_books")).collect()}
    assert set(silver) == {"1", "2", "3", "4", "5", "6", "9", "10", "11", "12"}
    assert silver["4"].num_pages is None and silver["5"].num_pages is None
    assert silver["5"].primary_author_id is None and silver["5"].shelf_genre is None
    assert silver["6"].data_quality_flag == "high_confidence"
    assert silver["9"].data_quality_flag == "low_confidence"

    enriched = {r.book_id: r for r in
                spark.read.parquet(layout.silver("int_books_enriched")).collect()}
    assert enriched["1"].primary_genre == "fantasy_paranormal"   # tie with young-adult: name order
    assert enriched["2"].primary_genre == "fantasy"              # all NULL counts → shelf
    assert enriched["3"].primary_genre == "fiction"              # all zero → shelf
    assert enriched["5"].primary_genre == "Uncategorised"
    assert enriched["1"].total_reviews == 4 and enriched["1"].positive_review_pct == 50.0
    assert enriched["2"].total_reviews == 2                       # r5 (bad date) + r8 (rating 2)
    assert enriched["4"].total_reviews == 0

    cands = {r.book_id: r for r in G.read_version(
        spark, layout.gold("mart_audiobook_candidates")).collect()}
    assert set(cands) == {"1", "2", "3", "4", "6", "11", "12"}   # 5 Uncategorised, 9 low, 10 comics
    # 11 and 12 (all reviews positive) tie at the top; RANK then skips to 3
    assert cands["11"].weighted_score == cands["12"].weighted_score
    assert cands["11"].audiobook_rank == cands["12"].audiobook_rank == 1
    assert cands["1"].audiobook_rank == 3
    assert cands["6"].length_category == "unknown"

    # Analyst SQL over the registered layers equals the DataFrame reports.
    from lectern.operators import report
    from lectern.plans import analyst
    analyst.register_layers(spark, layout)
    gold = G.read_version(spark, layout.gold("mart_audiobook_candidates"))
    mart = G.read_version(spark, layout.gold("mart_genre_performance"))
    pairs = {"top_candidates": report.top_candidates(gold, 10),
             "best_per_genre": report.best_per_genre(gold, DEFAULT.excluded_genres),
             "genre_strategy": report.genre_strategy(mart)}
    for name, df in pairs.items():
        cols = sorted(df.columns)
        assert sorted(map(tuple, analyst.run(spark, name).select(cols).collect())) == \
            sorted(map(tuple, df.select(cols).collect())), name
    lq = {r.layer: r.total_records for r in analyst.run(spark, "layer_quality").collect()}
    assert lq == {"bronze_books": 14, "silver_books": 10, "gold_candidates": 7}

    # An erasure lasts: not in Bronze, not after a new file with the subject, with the layout as it was.
    h = hashlib.sha256(b"u1").hexdigest()
    L.rebuild_after_erasure(spark, layout, [h.upper(), None], gate=False)
    assert I.read_bronze(spark, layout.bronze("reviews")).filter("user_id = 'u1'").count() == 0
    after = {r.book_id: r for r in spark.read.parquet(layout.silver("int_books_enriched")).collect()}
    assert after["1"].total_reviews == 3 and after["11"].total_reviews == 0
    assert G.history(spark, layout.gold("mart_audiobook_candidates")).count() == 2
    write_jsonl(raw_catalogue / "reviews", "part3.json", [review("r20", "1", "u1", 1), review("r21", "1", "u21", 5)])
    again = L.Layout(str(raw_catalogue), str(tmp_path / "lake"), exclude=jsonl.SAMPLE_SUFFIX)
    L.run_all(spark, again, DEFAULT, gate=False, batch_id="b2")
    bronze = I.read_bronze(spark, again.bronze("reviews"))
    assert bronze.filter("user_id = 'u1'").count() == 0 and bronze.filter("review_id = 'r21'").count() == 1
    left = {r.review_id for r in bronze.collect()}
    assert left == {"r2", "r3", "r4", "r6", "r7", "r8", "r9", "r11", "r21"}
    assert spark.read.parquet(again.silver("stg_reviews")).filter(f"user_id_hashed = '{h}'").count() == 0


def test_a_failing_suite_leaves_gold_as_it_was(spark, raw_catalogue, tmp_path):
    layout = L.Layout(str(raw_catalogue), str(tmp_path / "lake"), exclude=jsonl.SAMPLE_SUFFIX)
    with pytest.raises(quality.DataTestError, match="unique_stg_reviews_review_id"):
        L.run_all(spark, layout)                                  # gate=True
    assert not Path(layout.gold("mart_genre_performance")).exists()
    fine = [t for t in quality.declared_tests() if t.model != "stg_reviews" and not t.model.startswith("bronze")]
    first = L.run_all(spark, layout, tests=fine).versions
    assert set(first) == {"mart_audiobook_candidates", "mart_genre_performance"}
    bad_mart = [*fine, quality.Test("accepted_values", "mart_genre_performance", "genre", ("nothing",))]
    with pytest.raises(quality.DataTestError):
        L.run_all(spark, layout, tests=bad_mart)
    assert G.latest_version(spark, layout.gold("mart_genre_performance")) == first["mart_genre_performance"]
    with pytest.raises(quality.DataTestError, match="not run"):
        L.run_all(spark, layout, tests=[*fine, quality.Test("not_null", "mart_missing", "x")])


def test_compressed_and_oddly_named_files_are_read(spark, tmp_path):
    src = tmp_path / "src"
    write_jsonl(src, "a.json", [{"id": 1}])
    write_jsonl(src, "c.ndjson", [{"id": 7}])
    with gzip.open(src / "b.json.gz", "wt") as f:
        f.write("".join(json.dumps({"id": i}) + "\n" for i in range(2, 7)))
    assert sorted(r.id for r in jsonl.read_json_lines(spark, str(src)).collect()) == list(range(1, 8))
    spec = I.IngestSpec("x", str(src), str(tmp_path / "b"), str(tmp_path / "ck"), key="id")
    assert I.ingest_incremental(spark, spec, "b1").rows_added == 7
    assert jsonl.raw_inventory(spark, {"x": str(src)}).first().files == 3


def _rescued(spark, target):
    """JSON text of what the schema misses, by id; None on rows that conform."""
    from pyspark.sql import functions as F
    rows = I.read_bronze(spark, target).select("id", F.to_json(jsonl.RESCUED).alias("rest")).collect()
    return {r.id: r.rest for r in rows}


def test_no_new_field_is_lost(spark, tmp_path):
    """An old-looking file with a new column, a new field inside an array of structs, and a fixed schema."""
    src = tmp_path / "src"
    write_jsonl(src, "a.json", [{"id": "1", "authors": [{"author_id": "x"}], "n": 5}])
    spec = I.IngestSpec("x", str(src), str(tmp_path / "b"), str(tmp_path / "ck"), key="id")
    I.ingest_incremental(spark, spec, "b1")
    late = write_jsonl(src, "z.json", [{"id": "2", "authors": [{"author_id": "y", "role": "editor"}], "edition": "2nd", "n": 1.5}])
    os.utime(late, (1, 1))                                        # written long ago, renamed into the folder now
    I.ingest_incremental(spark, spec, "b2")
    row = I.read_bronze(spark, spec.target).filter("id = '2'").first()
    assert row.edition == "2nd" and row.authors[0].role == "editor"
    assert dict(I.read_bronze(spark, spec.target).dtypes)["n"] == "bigint"        # a known leaf keeps its type
    assert json.loads(_rescued(spark, spec.target)["2"]) == {"n": 1.5}             # and the value survives
    fixed = I.IngestSpec("x", str(src), str(tmp_path / "b2"), str(tmp_path / "ck2"), key="id", schema="id STRING")
    I.ingest_incremental(spark, fixed, "b1")
    rescued = _rescued(spark, fixed.target)
    assert json.loads(rescued["1"]) == {"authors": [{"author_id": "x"}], "n": 5}
    assert json.loads(rescued["2"]) == {"authors": [{"author_id": "y", "role": "editor"}], "edition": "2nd", "n": 1.5}


def test_tables_are_registered_counted_and_errors_reported(spark):
    good = spark.range(5)
    bad = spark.range(1).selectExpr("raise_error('no') AS x")
    report = {r["table"]: r for r in jsonl.register_tables(spark, {"t_good": good, "t_bad": bad, "t_last": good})}
    assert report["default.t_good"]["rows"] == report["default.t_last"]["rows"] == 5
    assert report["default.t_bad"]["error"] and report["default.t_good"]["error"] is None
    assert spark.sql("SELECT count(*) FROM t_good").first()[0] == 5


def _ingest_in_batches(spark, root, rows, cuts):
    src, spec = root / "src", None
    spec = I.IngestSpec("books", str(src), str(root / "bronze"), str(root / "ck"))
    start = 0
    for i, end in enumerate([*cuts, len(rows)]):
        write_jsonl(src, f"part{i}.json", rows[start:end])
        I.ingest_incremental(spark, spec, f"b{i}")
        start = end
    assert I.ingest_incremental(spark, spec, "again").rows_added == 0
    return sorted((r.book_id, r.title) for r in I.read_bronze(spark, spec.target).collect())


def test_any_batching_gives_the_same_rows(spark, tmp_path):
    from .conftest import book
    rows = [book(str(i), f"t{i}") for i in range(12)]
    one = _ingest_in_batches(spark, tmp_path / "one", rows, [])
    three = _ingest_in_batches(spark, tmp_path / "three", rows, [2, 7])
    assert one == three and len(one) == 12


def test_mark_seen_then_only_new_files(spark, tmp_path):
    from .conftest import book
    src = tmp_path / "src"
    write_jsonl(src, "old.json", [book("1"), book("2")])
    spec = I.IngestSpec("books", str(src), str(tmp_path / "bronze"), str(tmp_path / "ck"))
    I.mark_seen(spark, spec)                    # Bronze holds no data files yet
    write_jsonl(src, "new.json", [book("3")])
    assert I.ingest_incremental(spark, spec, "b1").rows_added == 1
    assert [r.book_id for r in I.read_bronze(spark, spec.target).collect()] == ["3"]


def test_bounded_batches_and_archive(spark, tmp_path):
    from .conftest import book
    src = tmp_path / "land" / "books"
    for i in range(4):
        write_jsonl(src, f"p{i}.json", [book(str(2 * i)), book(str(2 * i + 1))])
    spec = I.IngestSpec("books", str(src), str(tmp_path / "bronze"), str(tmp_path / "ck"),
                        schema=None, max_files_per_trigger=1, clean_source="archive",
                        archive_dir=str(tmp_path / "archive"))
    r = I.ingest_incremental(spark, spec, "b1")
    assert r.rows_added == 8 and len(r.batches) == 4          # one file per micro-batch
    assert I.read_bronze(spark, spec.target).count() == 8
    write_jsonl(src, "p9.json", [book("99")])
    assert I.ingest_incremental(spark, spec, "b2").rows_added == 1


def test_variant_landing_keeps_drifting_rows(spark, tmp_path):
    from lectern.functions import scalar as S
    src = tmp_path / "src"
    write_jsonl(src, "a.json", [{"book_id": "1", "genres": {"fiction": 3}}],
                raw_lines=["not json"])
    write_jsonl(src, "b.json", [{"book_id": 2, "genres": "fiction", "extra": [1]}])
    spec = I.IngestSpec("genres", str(src), str(tmp_path / "bronze"), str(tmp_path / "ck"),
                        variant_column="raw")
    assert I.ingest_incremental(spark, spec, "b1").rows_added == 3
    df = I.read_bronze(spark, spec.target)
    rows = sorted(df.select(S.variant_field("raw", "$.book_id", "string").alias("id"),
                            S.variant_field("raw", "$.genres.fiction", "int").alias("f"),
                            jsonl.CORRUPT).collect(), key=lambda r: str(r.id))
    assert [(r.id, r.f) for r in rows] == [("1", 3), ("2", None), (None, None)]
    assert rows[2][jsonl.CORRUPT] == "not json"
