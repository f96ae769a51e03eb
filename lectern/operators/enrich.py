"""Per-item review metrics and the enrichment joins.

All three inputs are keyed by ``book_id`` and every right side is unique by
key (metrics and primary genre are aggregates, items are de-duplicated), so
the left joins never multiply rows.  The aggregates come out hash-partitioned
by ``book_id`` and the de-duplicated items too, so with matching partition
counts the joins are co-partitioned and add no further exchange; AQE turns a
side into a broadcast only when its *measured* size is under the threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import UNCATEGORISED

REVIEW_FILL = ("total_reviews", "avg_review_rating", "positive_review_pct",
               "neutral_review_pct", "negative_review_pct")


def _pct(label: str) -> "F.Column":
    hits = F.sum(F.when(F.col("sentiment") == label, 1).otherwise(0))
    return F.round(hits * 100.0 / F.count("review_id"), 2)


def review_metrics(reviews: DataFrame, key: str = "book_id") -> DataFrame:
    """A1: count, mean stars (2 dp), sentiment shares in percent (2 dp), date span."""
    return reviews.groupBy(key).agg(
        F.count("review_id").alias("total_reviews"),
        F.round(F.avg(F.col("rating").cast("double")), 2).alias("avg_review_rating"),
        _pct("positive").alias("positive_review_pct"),
        _pct("neutral").alias("neutral_review_pct"),
        _pct("negative").alias("negative_review_pct"),
        F.min("review_date").alias("first_review_date"),
        F.max("review_date").alias("latest_review_date"),
    )


def items_with_genre(items: DataFrame, genres: DataFrame,
                     default: str = UNCATEGORISED) -> DataFrame:
    """J1 + F6: genre from the genre table, else the first shelf, else a label."""
    return (items.join(genres.select("book_id", "primary_genre"), "book_id", "left")
            .withColumn("primary_genre",
                        F.coalesce("primary_genre", "shelf_genre", F.lit(default))))


def items_with_metrics(items: DataFrame, metrics: DataFrame, fill_avg: bool = True) -> DataFrame:
    """J2 + F7: review metrics, missing ones filled with 0 (dates stay NULL)."""
    fill = {c: 0 for c in REVIEW_FILL if fill_avg or c != "avg_review_rating"}
    return items.join(metrics, "book_id", "left").fillna(fill)


ENRICHED_COLUMNS = (
    "book_id", "title", "primary_author_id", "average_rating", "ratings_count",
    "text_reviews_count", "num_pages", "language_code", "publisher", "format",
    "description", "data_quality_flag", "primary_genre", *REVIEW_FILL,
    "first_review_date", "latest_review_date", "_ingestion_timestamp",
)


def enrich_items(items: DataFrame, genres: DataFrame, metrics: DataFrame,
                 default_genre: str = UNCATEGORISED, fill_avg: bool = True) -> DataFrame:
    """J4 (int_books_enriched): one row per valid item, genre and metrics attached."""
    j = items_with_metrics(items_with_genre(items, genres, default_genre), metrics, fill_avg)
    return j.select(*ENRICHED_COLUMNS, F.current_timestamp().alias("_enriched_timestamp"))


def orphans(children: DataFrame, parents: DataFrame, key: str = "book_id",
            parent_key: str | None = None) -> DataFrame:
    """Child rows with a key that has no parent (``left_anti``).

    NULL keys are not orphans (a relationships test skips them).  No
    ``distinct`` on the parent side: duplicates cannot change an anti join.
    """
    p = parents.select(F.col(parent_key or key).alias("_parent_key"))
    return (children.filter(F.col(key).isNotNull())
            .join(p, F.col(key) == p["_parent_key"], "left_anti"))
