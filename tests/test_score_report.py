"""Enrichment, scoring, ranks and reports."""

from __future__ import annotations

import datetime as dt
import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from lectern.config import DEFAULT, LEGACY3, PRESETS
from lectern.operators import enrich, quality, report, score
from lectern.session import scratch_path

ENRICHED = ("book_id string, title string, primary_author_id string, average_rating double, "
            "ratings_count bigint, num_pages int, data_quality_flag string, "
            "primary_genre string, total_reviews bigint, positive_review_pct double, "
            "negative_review_pct double, text_reviews_count bigint, "
            "_enriched_timestamp timestamp")
NOW = dt.datetime(2024, 1, 1)


def enriched(spark, rows):
    full = [(*r, NOW) for r in rows]
    return spark.createDataFrame(full, ENRICHED)


def row(book_id, rating=4.0, count=20_000, pages=300, genre="fiction", total=0, pos=0.0,
        flag="medium_confidence", neg=0.0):
    return (book_id, f"T{book_id}", "a", rating, count, pages, flag, genre, total, pos, neg, 5)


def test_review_metrics_shares_and_dates(spark):
    rows = [("r1", "b", 5, "positive", dt.date(2017, 1, 1)), ("r2", "b", 3, "neutral", None),
            ("r3", "b", 1, "negative", dt.date(2018, 1, 1)), ("r4", "c", 4, "positive", None)]
    df = spark.createDataFrame(rows, "review_id string, book_id string, rating int, "
                                     "sentiment string, review_date date")
    out = {r.book_id: r for r in enrich.review_metrics(df).collect()}
    b = out["b"]
    assert b.total_reviews == 3 and b.avg_review_rating == 3.0
    assert (b.positive_review_pct, b.neutral_review_pct, b.negative_review_pct) == (33.33, 33.33, 33.33)
    assert abs(b.positive_review_pct + b.neutral_review_pct + b.negative_review_pct - 100) <= 0.02
    assert b.first_review_date == dt.date(2017, 1, 1) and b.latest_review_date == dt.date(2018, 1, 1)


def test_enrich_fallbacks_and_fill(spark):
    items = spark.createDataFrame(
        [("1", "shelf"), ("2", "shelf"), ("3", None)], "book_id string, shelf_genre string"
    ).select("*", *[F.lit(None).cast(t).alias(c) for c, t in [
        ("title", "string"), ("primary_author_id", "string"), ("average_rating", "double"),
        ("ratings_count", "bigint"), ("text_reviews_count", "bigint"), ("num_pages", "int"),
        ("language_code", "string"), ("publisher", "string"), ("format", "string"),
        ("description", "string"), ("data_quality_flag", "string"),
        ("_ingestion_timestamp", "timestamp")]])
    genres = spark.createDataFrame([("1", "fantasy")], "book_id string, primary_genre string")
    metrics = spark.createDataFrame([("2", 4, 4.5, 50.0, 25.0, 25.0, None, None)],
                                    "book_id string, total_reviews bigint, avg_review_rating double, "
                                    "positive_review_pct double, neutral_review_pct double, "
                                    "negative_review_pct double, first_review_date date, "
                                    "latest_review_date date")
    out = {r.book_id: r for r in enrich.enrich_items(items, genres, metrics).collect()}
    assert [out[k].primary_genre for k in "123"] == ["fantasy", "shelf", "Uncategorised"]
    assert out["1"].total_reviews == 0 and out["1"].avg_review_rating == 0.0
    assert out["2"].positive_review_pct == 50.0


def test_orphans_skip_null_keys(spark):
    kids = spark.createDataFrame([("r1", "1"), ("r2", "9"), ("r3", None)],
                                 "review_id string, book_id string")
    parents = spark.createDataFrame([("1",), ("1",)], "book_id string")
    assert [r.review_id for r in enrich.orphans(kids, parents).collect()] == ["r2"]


def test_candidates_contract_filters_and_ranks(spark):
    rows = [row("1", 4.5, 150_000, 320, "fantasy", 4, 75.0, "high_confidence"),
            row("2", 4.0, 20_000, 300, "fiction"), row("3", 4.0, 20_000, 300, "fiction"),
            row("4", 3.0, 20_000, 900, "fiction"),
            row("5", 4.9, 9_000, 300, "fiction", flag="low_confidence"),
            row("6", 4.9, 90_000, 300, "comics_graphic"),
            row("7", 4.9, 90_000, 300, "Uncategorised")]
    c = score.candidates(enriched(spark, rows), DEFAULT)
    quality.enforce_contract(c, "mart_audiobook_candidates")
    out = {r.book_id: r for r in c.collect()}
    assert set(out) == {"1", "2", "3", "4"}
    assert out["1"].audiobook_rank == 1
    assert out["2"].audiobook_rank == out["3"].audiobook_rank == 2   # tie
    assert out["4"].audiobook_rank == 4                              # RANK leaves a gap
    assert out["1"].genre_rank == 1 and out["4"].genre_rank == 3
    want = round(4.5 / 5 * .35 + math.log(150_001) / math.log(5_000_001) * .25
                 + .75 * .25 + 1.0 * .15, 4)
    assert out["1"].weighted_score == want
    for r in out.values():
        parts = (r.rating_contribution + r.popularity_contribution + r.sentiment_contribution
                 + r.length_contribution)
        assert abs(parts - r.weighted_score) <= 0.00025


def test_score_can_exceed_one_without_cap(spark):
    c = score.candidates(enriched(spark, [row("1", 5.0, 9_000_000_000, 300, total=1, pos=100.0)]))
    assert c.first().weighted_score > 1.0


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from(["g1", "g2", "g3"]),
                          st.one_of(st.none(), st.integers(0, 6).map(lambda x: x / 4))),
                min_size=1, max_size=40))
def test_histogram_rank_equals_sql_rank(spark, pairs):
    df = spark.createDataFrame([(str(i), g, s) for i, (g, s) in enumerate(pairs)],
                               "id string, g string, s double")
    got = {r.id: (r.gr, r.ar) for r in
           score.with_ranks(df, "s", ["g"], rank_col="gr", global_rank_col="ar").collect()}
    want = {r.id: (r.gr, r.ar) for r in df.select(
        "id", F.rank().over(Window.partitionBy("g").orderBy(F.col("s").desc())).alias("gr"),
        F.rank().over(Window.orderBy(F.col("s").desc())).alias("ar")).collect()}
    assert got == want


def single_partition_rows(spark, df) -> int:
    """Most rows that a shuffle into a single partition carried in the finished plan."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    most, todo = 0, [plan]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
            continue
        if name.endswith("QueryStageExec"):
            todo.append(node.plan())
            continue
        if name == "ShuffleExchangeExec" and "SinglePartition" in node.outputPartitioning().toString():
            most = max(most, node.metrics().apply("shuffleRecordsWritten").value())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return most


def test_no_single_partition_over_rows(spark):
    # Unrounded, all different: the histogram is as long as the data, and no task may get it whole.
    n = 20_000
    df = spark.range(n).select("id", (F.rand(3) * 0.9).alias("s"), F.lit("g").alias("g"))
    df = df.repartition(4)
    assert single_partition_rows(spark, score.rank_window(df, "s")) == n           # the check can fail
    assert single_partition_rows(spark, score.global_rank(df, "s")) <= 4 * 8       # partial sums per range
    small = spark.createDataFrame([(1, None), (2, 0.5), (3, 0.50001), (4, 0.5), (5, None), (6, -2.0)], "id long, s double")
    got = {r.id: r.audiobook_rank for r in score.global_rank(small, "s").collect()}
    assert got == {3: 1, 2: 2, 4: 2, 6: 4, 1: 5, 5: 5}
    plan = score.global_rank(df, "s")._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" not in plan


@pytest.mark.parametrize("shape", ["wide", "narrow", "hot_group"])
def test_ranges_hold_equally_many_scores(spark, shape):
    """Scores from 0 to 5 million, or all inside one thousandth, or nearly all of one group: no range is much larger."""
    n, x = 40_000, F.rand(5)
    s = {"wide": x * x * x * 5_000_000, "narrow": 0.5 + x / 1000, "hot_group": x}[shape]
    df = spark.range(n).select("id", s.alias("s"), F.when(F.col("id") % 50 == 0, "a").otherwise("b").alias("g")).repartition(4)
    df.write.mode("overwrite").parquet(path := scratch_path(spark, "rank_test"))
    df = spark.read.parquet(path)
    groups = ["g"] if shape == "hot_group" else []
    sizes = []
    kept, score.materialize = score.materialize, lambda d, label: _sized(kept(d, label), sizes)
    try:
        got = score.with_ranks(df, "s", groups, "r") if groups else None
        table = score.rank_table(df, "s", groups, "r", ranges=16)
    finally:
        score.materialize = kept
    sizes = sizes[-1]
    assert len(sizes) >= 15 and max(sizes) < 2 * sorted(sizes)[len(sizes) // 2]
    want = df.withColumn("r", F.rank().over((Window.partitionBy("g") if groups else Window.partitionBy()).orderBy(F.desc("s"))))
    assert {(r.s, r.r) for r in table.collect()} == {(r.s, r.r) for r in want.collect()}
    if got is not None:
        assert {(r.id, r.r) for r in got.collect()} == {(r.id, r.r) for r in want.collect()}


def _sized(parts, sizes):
    sizes.append([r["count"] for r in parts.groupBy("_range").count().collect()])
    return parts


def test_strategy_ranks_each_preset(spark):
    rows = [row(str(i), 3 + i / 10, 20_000 * (i + 1), 200 + 50 * i) for i in range(6)]
    out = score.strategy_ranks(enriched(spark, rows), PRESETS).collect()
    assert {r.strategy for r in out} == set(PRESETS)
    assert len(out) == 6 * len(PRESETS)
    d = [r for r in out if r.strategy == "default"]
    ref = {r.book_id: r.weighted_score for r in score.candidates(enriched(spark, rows)).collect()}
    assert {r.book_id: r.weighted_score for r in d} == ref
    assert "CartesianProduct" not in score.strategy_ranks(enriched(spark, rows))._jdf \
        .queryExecution().executedPlan().toString()


def test_legacy_three_part(spark):
    rows = [row("1", 4.5, 150_000, 900, "comics_graphic", 4, 10.0)]
    out = score.legacy_candidates(enriched(spark, rows), LEGACY3).first()
    want = round(4.5 / 5 * .4 + math.log(150_001) / math.log(5_000_001) * .3 + 1.0 * .3, 4)
    assert out.weighted_score == want and out.primary_genre == "comics_graphic"


def test_genre_mart_and_reports(spark):
    rows = [row("1", 4.5, 150_000, 320, "fantasy", 4, 75.0, "high_confidence", 25.0),
            row("2", 4.0, 20_000, 300, "fiction"), row("3", 3.5, 30_000, 300, "fiction"),
            row("4", 4.0, 20_000, 300, "Uncategorised")]
    e = enriched(spark, rows)
    mart = report.genre_performance(e, DEFAULT)
    quality.enforce_contract(mart, "mart_genre_performance")
    m = {r.genre: r for r in mart.collect()}
    assert set(m) == {"fantasy", "fiction"}
    again = report.genre_performance(e.union(e), DEFAULT)                       # COUNT DISTINCT, whatever the rows
    assert {r.genre: r.total_books for r in again.collect()} == {"fantasy": 1, "fiction": 2}
    strategy = [r.genre_rank for r in report.genre_strategy(mart).collect()]
    assert strategy == sorted(strategy)
    assert m["fiction"].total_books == 2 and m["fiction"].total_ratings == 50_000
    assert m["fantasy"].genre_rank == 1 and m["fiction"].genre_rank == 2
    # avg score omits the length part
    want = round(4.5 / 5 * .35 + math.log(150_001) / math.log(5_000_001) * .25 + .75 * .25, 4)
    assert m["fantasy"].avg_weighted_score == want

    cands = score.candidates(e)
    top = report.top_candidates(cands, 2).collect()
    assert [r.book_id for r in top] == ["1", "2"] and top[0].total_ratings == "150,000"
    best = {r.genre: r.book_id for r in report.best_per_genre(cands).collect()}
    assert best == {"fantasy": "1", "fiction": "2"}
    rec = {r.kind: r.name for r in report.recommendation(cands, mart).collect()}
    assert rec == {"top_item": "T1", "top_genre": "fantasy"}
    assert report.genre_coverage(e).first().asDict() == {"books_with_genre": 3, "total_books": 4}
    assert report.reviewed_items(e).first().reviewed_books == 1
    lq = {r.layer: (r.total_records, r.null_ids)
          for r in report.layer_quality([("a", e), ("b", cands)]).collect()}
    assert lq == {"a": (4, 0), "b": (3, 0)}


def test_best_per_group_plans_group_limit(spark):
    rows = [row(str(i), 3 + i / 10) for i in range(5)]
    df = report.best_per_group(score.score_items(enriched(spark, rows)))
    assert "WindowGroupLimit" in df._jdf.queryExecution().executedPlan().toString()


def test_top_genres_and_distribution(spark):
    rows = [row("1", genre="a"), row("2", genre="b"), row("3", genre="b"),
            row("4", genre="c", flag="low_confidence")]
    e = enriched(spark, rows)
    assert [(r.primary_genre, r.books) for r in report.top_genres(e, DEFAULT, 2).collect()] == \
        [("b", 2), ("a", 1)]
    dist = [(r.data_quality_flag, r.books) for r in report.quality_distribution(e).collect()]
    assert dist == [("medium_confidence", 3), ("low_confidence", 1)]


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(1, 5)),
                min_size=1, max_size=60))
def test_sentiment_shares_sum_to_100(spark, reviews):
    from lectern.functions import scalar as S
    df = spark.createDataFrame([(f"r{i}", b, r) for i, (b, r) in enumerate(reviews)],
                               "review_id string, book_id string, rating int") \
        .withColumn("sentiment", S.classify_rating("rating")) \
        .withColumn("review_date", F.lit(None).cast("date"))
    for r in enrich.review_metrics(df).collect():
        total = r.positive_review_pct + r.neutral_review_pct + r.negative_review_pct
        assert abs(total - 100) <= 0.02


def test_ranked_rows_are_never_the_broadcast_side(spark):
    """Files of few MB may be hundreds in memory; joined from the other side, all rows came out of the histogram's tasks."""
    path = scratch_path(spark, "ranked_rows")
    rows = [(i, "ab"[i % 2], None if i % 50 == 0 else float(i % 40)) for i in range(400)]
    spark.createDataFrame(rows, "id long, g string, s double").repartition(4).write.parquet(path)
    df = spark.read.parquet(path)
    ranked = score.with_ranks(df, "s", ["g"], "r", "all_r")
    assert "BuildLeft" not in ranked._jdf.queryExecution().executedPlan().toString()
    want = score.rank_window(score.rank_window(df, "s", "g", "r"), "s", None, "all_r")
    assert sorted(map(repr, ranked.collect())) == sorted(map(repr, want.collect()))


def test_null_group_is_ranked(spark):
    df = spark.createDataFrame([("1", None, 0.5), ("2", None, 0.7), ("3", "g", 0.6)],
                               "id string, g string, s double")
    out = {r.id: (r.gr, r.ar) for r in
           score.with_ranks(df, "s", ["g"], rank_col="gr", global_rank_col="ar").collect()}
    assert out == {"1": (2, 3), "2": (1, 1), "3": (1, 2)}


def test_hot_keys_a_third_of_rows(spark):
    """One book holds a third of the reviews; one (genre, score) pair a third of the items."""
    n = 600
    reviews = [(f"r{i}", "hot" if i % 3 == 0 else f"b{i % 50}", 1 + i % 5) for i in range(n)]
    df = spark.createDataFrame(reviews, "review_id string, book_id string, rating int") \
        .withColumn("sentiment", F.when(F.col("rating") >= 4, "positive")
                    .when(F.col("rating") == 3, "neutral").otherwise("negative")) \
        .withColumn("review_date", F.lit(None).cast("date")).repartition(6)
    hot = [r for r in enrich.review_metrics(df).collect() if r.book_id == "hot"][0]
    assert hot.total_reviews == n // 3
    assert hot.avg_review_rating == round(sum(1 + i % 5 for i in range(0, n, 3)) / (n // 3), 2)

    items = [(str(i), "g1" if i % 3 == 0 else f"g{i % 4}", 0.5 if i % 3 == 0 else (i % 7) / 10)
             for i in range(n)]
    sdf = spark.createDataFrame(items, "id string, g string, s double").repartition(6)
    old = spark.conf.get("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes")
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "1k")
    try:
        got = {r.id: (r.gr, r.ar) for r in
               score.with_ranks(sdf, "s", ["g"], rank_col="gr", global_rank_col="ar").collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", old)
    want = {}
    for i, g, s in items:
        gr = 1 + sum(1 for _, g2, s2 in items if g2 == g and s2 > s)
        ar = 1 + sum(1 for _, _, s2 in items if s2 > s)
        want[i] = (gr, ar)
    assert got == want
