"""Gold reports and analyst queries: A2, A4-A7, L1-L3, L5, W5, W6.

Everything is an aggregate, a per-group top-1 or a bounded top-k.  No report
orders a whole table: ``orderBy(...).limit(k)`` plans a ``TakeOrderedAndProject``
(per-partition top-k, then a k-row merge); only aggregates with one row per
genre or flag are sorted or ranked whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, UNCATEGORISED, ScoringConfig
from ..functions import scalar as S
from . import score as SC

GENRE_COLUMNS = ("genre_rank", "genre", "total_books", "avg_rating", "total_ratings",
                 "avg_positive_pct", "avg_negative_pct", "avg_weighted_score",
                 "_mart_timestamp")


def _score_without_length(cfg: ScoringConfig) -> Column:
    sent = S.sentiment_score("positive_review_pct", "total_reviews", "average_rating", cfg)
    r, p, s, _ = S.score_parts("average_rating", "ratings_count", sent, F.lit(0.0), cfg)
    return r + p + s


def genre_performance(enriched: DataFrame, cfg: ScoringConfig = DEFAULT,
                      excluded: Sequence[str] | None = None) -> DataFrame:
    """A2 + A3 + W5: genre mart (9 columns).  The average score omits length.

    One aggregate per genre, then ``RANK`` over its rows: the window holds one row per genre, so it needs no
    staging, no join and no second pass.
    """
    rows = SC.eligible_items(enriched, cfg, excluded)
    books = F.count_distinct("book_id")
    agg = rows.groupBy(F.col("primary_genre").alias("genre")).agg(
        books.alias("total_books"),
        F.round(F.avg("average_rating"), 2).alias("avg_rating"),
        F.sum("ratings_count").alias("total_ratings"),
        F.round(F.avg(F.col("positive_review_pct").cast("double")), 1).alias("avg_positive_pct"),
        F.round(F.avg(F.col("negative_review_pct").cast("double")), 1).alias("avg_negative_pct"),
        F.round(F.avg(_score_without_length(cfg)), 4).alias("avg_weighted_score"),
    )
    return _ranked(agg).withColumn("_mart_timestamp", F.current_timestamp()).select(*GENRE_COLUMNS)


def _ranked(per_genre: DataFrame) -> DataFrame:
    """``RANK`` over the rows of an aggregate (one per genre)."""
    return per_genre.withColumn("genre_rank", F.rank().over(Window.orderBy(F.col("avg_weighted_score").desc())))


def legacy_genre_summary(enriched: DataFrame, cfg: ScoringConfig) -> DataFrame:
    """Older genre summary: proxy-sentiment share in percent, only Uncategorised dropped."""
    rows = SC.eligible_items(enriched, cfg, excluded=(UNCATEGORISED,))
    proxy = S.rating_proxy("average_rating")
    agg = rows.groupBy("primary_genre").agg(
        F.count("book_id").alias("total_books"),
        F.round(F.avg("average_rating"), 2).alias("avg_rating"),
        F.sum("ratings_count").alias("total_ratings"),
        F.round(F.avg(proxy) * 100, 1).alias("positive_pct"),
        F.round(F.avg(_score_without_length(cfg)), 4).alias("avg_weighted_score"),
    )
    return _ranked(agg)


def quality_distribution(items: DataFrame) -> DataFrame:
    """A4: items per confidence flag, most first (a sort of one row per flag)."""
    return (items.groupBy("data_quality_flag").agg(F.count(F.lit(1)).alias("books"))
            .orderBy(F.col("books").desc(), F.col("data_quality_flag").asc()))


def top_genres(items: DataFrame, cfg: ScoringConfig = DEFAULT, n: int = 10) -> DataFrame:
    """A5: the ``n`` genres with most reliable items; ties by genre name."""
    return (items.filter(F.col("data_quality_flag").isin(*cfg.kept_flags))
            .groupBy("primary_genre").agg(F.count(F.lit(1)).alias("books"))
            .orderBy(F.col("books").desc(), F.col("primary_genre").asc()).limit(n))


def genre_coverage(items: DataFrame, default: str = UNCATEGORISED) -> DataFrame:
    """Items with a real genre, next to the total."""
    return items.agg(F.count_if(F.col("primary_genre") != default).alias("books_with_genre"),
                     F.count(F.lit(1)).alias("total_books"))


def reviewed_items(items: DataFrame) -> DataFrame:
    """Items whose sentiment comes from real reviews."""
    return items.agg(F.count_if(F.col("total_reviews") > 0).alias("reviewed_books"),
                     F.count(F.lit(1)).alias("total_books"))


def best_per_group(df: DataFrame, group: str = "primary_genre", score: str = "weighted_score",
                   key: str = "book_id") -> DataFrame:
    """The top row per group (``ROW_NUMBER() = 1``), ties by ``key``.

    Planned with a partial ``WindowGroupLimit`` before the shuffle, so a hot
    group sends one row per map task, not all of its rows.
    """
    w = Window.partitionBy(group).orderBy(F.col(score).desc_nulls_last(), F.col(key).asc())
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def best_per_genre(cands: DataFrame, excluded: Sequence[str] = ()) -> DataFrame:
    rows = cands.filter(~F.col("primary_genre").isin(*excluded)) if excluded else cands
    return best_per_group(rows).select(
        F.col("primary_genre").alias("genre"), "book_id", "title",
        F.col("average_rating").alias("rating"), F.col("weighted_score").alias("score"))


def top_candidates(cands: DataFrame, n: int = 10) -> DataFrame:
    """L1: first ``n`` by rank; ``book_id`` breaks rank ties so LIMIT is exact."""
    return (cands.orderBy(F.col("audiobook_rank").asc(), F.col("book_id").asc()).limit(n)
            .select(F.col("audiobook_rank").alias("rank"), "book_id", "title",
                    F.col("primary_genre").alias("genre"),
                    F.col("average_rating").alias("rating"),
                    S.thousands("ratings_count").alias("total_ratings"),
                    "num_pages", "length_category",
                    F.col("weighted_score").alias("score")))


def genre_strategy(mart: DataFrame) -> DataFrame:
    """L2: the genre report in order of ``genre_rank`` (a sort of one row per genre)."""
    return mart.select("genre_rank", "genre", "total_books", "avg_rating",
                       S.thousands("total_ratings").alias("total_ratings"),
                       F.col("avg_weighted_score").alias("avg_score")).orderBy("genre_rank", "genre")


def recommendation(items: DataFrame, mart: DataFrame) -> DataFrame:
    """L3: the top item and the top genre, one row each: two bounded top-1s by score, no rank of all rows."""
    item = (items.orderBy(F.col("weighted_score").desc_nulls_last(), F.col("book_id").asc()).limit(1)
            .select(F.lit("top_item").alias("kind"), F.col("title").alias("name"),
                    F.col("primary_genre").alias("genre"),
                    F.col("weighted_score").alias("score"),
                    F.col("ratings_count").alias("ratings")))
    genre = (mart.orderBy(F.col("avg_weighted_score").desc_nulls_last(), F.col("genre").asc()).limit(1)
             .select(F.lit("top_genre").alias("kind"), F.col("genre").alias("name"),
                     F.col("genre").alias("genre"),
                     F.col("avg_weighted_score").alias("score"),
                     F.col("total_ratings").alias("ratings")))
    return item.unionByName(genre)


def layer_quality(layers: Sequence[tuple[str, DataFrame]], key: str = "book_id") -> DataFrame:
    """Rows and NULL keys per layer, one aggregate each, ``UNION ALL``."""
    parts = [df.agg(F.count(F.lit(1)).alias("total_records"),
                    F.count_if(F.col(key).isNull()).alias("null_ids"))
             .select(F.lit(name).alias("layer"), "total_records", "null_ids")
             for name, df in layers]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def footer_session(spark: SparkSession) -> SparkSession:
    """A session of the same application whose Parquet aggregates are answered from footers (the caller's keeps its options).

    Counts and minima and maxima of whole files are in their footers; Spark's V2 reader takes them from there.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.sources.useV1SourceList", "avro,csv,json,kafka,orc,text")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return session


def footer_counts(spark: SparkSession, path: str, key: str) -> DataFrame:
    """Rows of a Parquet table and values of ``key``, from its footers."""
    return footer_session(spark).read.parquet(path).agg(F.count(F.lit(1)).alias("rows"), F.count(key).alias("there"))


def layer_quality_of_files(spark: SparkSession, layers: Sequence[tuple[str, str]], key: str = "book_id") -> DataFrame:
    """L5 / A8 over written Parquet tables ``(name, path)``: rows and NULL keys per layer, without reading a row.

    ``count(key)`` counts values that aren't NULL, so both numbers are sums over row groups of what footers say.  One
    row per layer passes the driver; a table without a row group has no sums, which are 0.
    """
    found = []
    for name, path in layers:
        row = footer_counts(spark, path, key).first()
        rows, there = (0 if n is None else n for n in (row["rows"], row["there"]))
        found.append((name, rows, rows - there))
    return spark.createDataFrame(found, "layer STRING, total_records BIGINT, null_ids BIGINT")
