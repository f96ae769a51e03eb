"""Erasure from Bronze (G2, G3): affected files only, landing not read, Gold behind its tests."""

from __future__ import annotations

import hashlib
from pathlib import Path

import pytest

from lectern.config import DEFAULT
from lectern.operators import governance as G
from lectern.operators import quality
from lectern.plans import layers as L
from lectern.sources import jsonl
from lectern.streaming import erasure
from lectern.streaming import ingest as I

from .conftest import review, write_jsonl


def sha(subject: str) -> str:
    return hashlib.sha256(subject.encode()).hexdigest()


def files(target) -> dict[str, bytes]:
    return {str(p): p.read_bytes() for p in Path(target).rglob("_epoch=*/**/part-*.parquet")}


def reviews_spec(tmp_path, **more) -> I.IngestSpec:
    return I.IngestSpec("reviews", str(tmp_path / "raw"), str(tmp_path / "bronze"), str(tmp_path / "ck"), key="review_id",
                        schema=L.SCHEMAS["reviews"], subject_index=True, **more)


def test_rows_of_cleaned_landing_files_stay(spark, tmp_path):
    """The landing files of reviews 1 to 3 are gone when u4 is erased: only r4 goes."""
    spec = reviews_spec(tmp_path)
    a = write_jsonl(tmp_path / "raw", "a.json", [review("r1", "1", "u1"), review("r2", "1", "u2"), review("r3", "1", "u3")])
    I.ingest_incremental(spark, spec, "b1")
    write_jsonl(tmp_path / "raw", "b.json", [review("r4", "1", "u4"), review("r5", "2", "u5")])
    I.ingest_incremental(spark, spec, "b2")
    a.unlink()
    before = files(spec.target)
    done = erasure.erase(spark, spec, [sha("u4").upper(), None])
    assert {r.review_id for r in I.read_bronze(spark, spec.target).collect()} == {"r1", "r2", "r3", "r5"}
    after = files(spec.target)
    changed = {p for p in before if after.get(p) != before[p]}
    assert set(after) == set(before) and {Path(p).name for p in changed} == {Path(f).name for f in done.files}
    assert len(changed) == 1 and all("_epoch=1" in p for p in changed) and done.rows == 1 and done.epochs == [1]
    loads = {r.epoch: r for r in I.load_records(spark, spec.target).collect()}
    assert (loads[0].rows, loads[1].rows, loads[1].erased) == (3, 1, 1)
    assert not list(Path(spec.target).rglob("_erasing/*"))


def test_erasing_twice_or_nobody_changes_nothing(spark, tmp_path):
    spec = reviews_spec(tmp_path)
    write_jsonl(tmp_path / "raw", "a.json", [review("r1", "1", "u1"), review("r2", "1", "u2"), review("r3", "1", None)])
    I.ingest_incremental(spark, spec, "b1")
    assert erasure.erase(spark, spec, [None]).files == []
    assert erasure.erase(spark, spec, [sha("nobody")]).files == []
    assert erasure.erase(spark, spec, [sha("u1")]).rows == 1
    before = files(spec.target)
    again = erasure.erase(spark, spec, [sha("u1")])           # the index forgot the subject as well
    assert again.files == [] and files(spec.target) == before
    assert {r.review_id for r in I.read_bronze(spark, spec.target).collect()} == {"r2", "r3"}


def test_a_file_of_erased_subjects_alone_is_deleted(spark, tmp_path):
    spec = reviews_spec(tmp_path)
    write_jsonl(tmp_path / "raw", "a.json", [review("r1", "1", "u1"), review("r2", "1", "u1")])
    I.ingest_incremental(spark, spec, "b1")
    write_jsonl(tmp_path / "raw", "b.json", [review("r3", "1", "u2")])
    I.ingest_incremental(spark, spec, "b2")
    done = erasure.erase(spark, spec, [sha("u1")])
    assert done.rows == 2 and done.deleted and not done.files
    assert [r.review_id for r in I.read_bronze(spark, spec.target).collect()] == ["r3"]


def test_many_requests_as_a_table_and_an_attempt_cut_off(spark, tmp_path, monkeypatch):
    """A first attempt replaces one file and fails; the second one ends it, with no row lost or doubled."""
    spec = reviews_spec(tmp_path)
    for k in range(4):
        write_jsonl(tmp_path / "raw", f"{k}.json", [review(f"r{k}{i}", "1", f"u{i}") for i in range(6)])
        I.ingest_incremental(spark, spec, f"b{k}")
    requests = spark.createDataFrame([(sha("u1"),), (sha("u4"),), (None,)], "_erase_hash string")
    real, calls = erasure._replace, []

    def fails(spark_, source, target):
        if calls:
            raise OSError("lost")
        calls.append(target)
        real(spark_, source, target)
    monkeypatch.setattr(erasure, "_replace", fails)
    with pytest.raises(OSError, match="lost"):
        erasure.erase(spark, spec, requests)
    want = {f"r{k}{i}" for k in range(4) for i in (0, 2, 3, 5)}
    between = [r.review_id for r in I.read_bronze(spark, spec.target).collect()]
    assert want <= set(between) and len(between) == len(set(between))
    monkeypatch.setattr(erasure, "_replace", real)
    erasure.erase(spark, spec, requests)
    left = [r.review_id for r in I.read_bronze(spark, spec.target).collect()]
    assert set(left) == want and len(left) == len(want)
    assert erasure.affected_files(spark, spec.target, [sha("u1"), sha("u4")]).count() == 0


def test_erased_subjects_do_not_come_back(spark, tmp_path):
    G.request_table(spark, [sha("u1")]).write.parquet(str(tmp_path / "requests"))
    spec = reviews_spec(tmp_path, erase_requests=str(tmp_path / "requests"))
    write_jsonl(tmp_path / "raw", "a.json", [review("r1", "1", "u1"), review("r2", "1", "u2"), review("r3", "1", None)], ["", "{bad"])
    res = I.ingest_incremental(spark, spec, "b1")
    assert (res.rows_added, res.erased, res.corrupt) == (3, 1, 1)
    assert {r.review_id for r in I.read_bronze(spark, spec.target).collect()} == {"r2", "r3", None}


def test_gold_stays_when_its_tests_fail_after_an_erasure(spark, raw_catalogue, tmp_path):
    layout = L.Layout(str(raw_catalogue), str(tmp_path / "lake"), exclude=jsonl.SAMPLE_SUFFIX)
    fine = [t for t in quality.declared_tests() if t.model != "stg_reviews" and not t.model.startswith("bronze")]
    first = L.run_all(spark, layout, DEFAULT, tests=fine, batch_id="b1").versions["mart_genre_performance"]
    for p in (raw_catalogue / "reviews").iterdir():
        p.unlink()                                              # landing is clean
    bad = [*fine, quality.Test("accepted_values", "mart_genre_performance", "genre", ("nothing",))]
    with pytest.raises(quality.DataTestError):
        L.rebuild_after_erasure(spark, layout, [sha("u1")], tests=bad)
    assert G.latest_version(spark, layout.gold("mart_genre_performance")) == first
    assert I.read_bronze(spark, layout.bronze("reviews")).filter("user_id = 'u1'").count() == 0
    rep = L.rebuild_after_erasure(spark, layout, [sha("u2")], tests=fine)
    assert rep.versions["mart_genre_performance"] > first and rep.erased.rows == 2         # r2, and one of the two r11
    left = {r.review_id for r in I.read_bronze(spark, layout.bronze("reviews")).collect()}
    assert left == {"r3", "r4", "r6", "r7", "r8", "r9", "r11"}


def test_the_erased_lake_holds_little_disk(spark, monkeypatch):
    """Landed files are gzip in parts, lines aren't exchanged, and no job's shuffle files outlive it; all rows stay but the subject's."""
    import time

    from pyspark.sql import functions as F

    from lectern.config import star_config
    from lectern.plans import star_landing
    from lectern.session import LEAN
    monkeypatch.setitem(getattr(star_landing, "LANDED", {}), "maxRecordsPerFile", 40)
    monkeypatch.setattr(star_landing, "BRONZE_ROWS", 30, raising=False)

    def shuffled() -> set:
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().iterator()
        names = set()
        while found.hasNext():
            names.add(found.next().getName())
        return {n for n in names if n.startswith("shuffle_")}

    items = spark.range(120).select(
        F.col("id").cast("string").alias("book_id"), F.lit("T").alias("title"),
        F.expr("array(named_struct('author_id', 'a'))").alias("authors"),
        F.expr("array(named_struct('name', 'fiction'))").alias("popular_shelves"), F.lit("4.0").alias("average_rating"),
        F.lit("20000").alias("ratings_count"), F.lit("10").alias("text_reviews_count"), F.lit("300").alias("num_pages"))
    reviews = spark.range(400).repartition(3).select(
        F.col("id").cast("string").alias("review_id"), (F.col("id") % 120).cast("string").alias("book_id"),
        F.when(F.col("id") > 9, (F.col("id") % 50).cast("string")).alias("user_id"), F.lit(4).cast("bigint").alias("rating"),
        F.lit(None).cast("string").alias("review_text"), F.lit("2024-01-01").alias("date_added"))
    genres = spark.range(120).select(F.col("id").cast("string").alias("book_id"), *[
        F.lit(3).cast("bigint").alias(f"genre_{k}") for k in star_landing.RAW_GENRE_NAMES])
    kept, before = {k: spark.conf.get(k, None) for k in LEAN}, shuffled()
    layout = star_landing.erased_lake(spark, items, reviews, genres, [sha("7"), None], star_config())
    landed = [p.name for p in (Path(layout.raw.removeprefix("file:")) / "books").glob("part-*")]
    assert len(landed) >= 3 and all(name.endswith(".json.gz") for name in landed)
    deadline = time.time() + 20
    while (left := shuffled() - before) and time.time() < deadline:
        time.sleep(0.2)
    assert not left
    assert {k: spark.conf.get(k, None) for k in LEAN} == kept
    silver = spark.read.parquet(layout.silver("stg_reviews"))
    assert {int(r["review_id"]) for r in silver.select("review_id").collect()} == {k for k in range(400) if k < 10 or k % 50 != 7}
    bronze = spark.read.parquet(layout.bronze("reviews"))
    assert bronze.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0] <= 30 and bronze.count() == silver.count()
