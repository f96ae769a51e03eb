"""Silver cleaning: typed casts, validity filters, de-duplication, reviews.

P1-P5, P8, P10, W1, W2.  All narrow except ``dedup``, which shuffles once on
its key.  ``dedup`` is written as ``row_number() = 1`` so Catalyst plans a
partial ``WindowGroupLimit`` *before* the exchange: a key holding a third of
all rows is cut to one row per map task before it is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, ScoringConfig
from ..functions import scalar as S

ITEM_TEXT_COLUMNS = ("language_code", "publisher", "format", "description", "isbn", "isbn13")


def _opt(df: DataFrame, name: str, dtype: str = "string") -> Column:
    """Column if present, else a typed NULL (raw feeds differ in optional fields)."""
    if name in df.columns:
        return F.col(f"`{name}`")
    return F.lit(None).cast(dtype)


#: Audit column with a hash of the raw record: narrow, the same when a file is landed again.
ROW_HASH = "_row_hash"


def row_tiebreak(df: DataFrame) -> list[Column]:
    """Last-resort order of a table: its raw-record hash, where ingest has kept one."""
    return [F.col(ROW_HASH).asc()] if ROW_HASH in df.columns else []


def dedup(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep one row per ``keys``: the first under ``order``.

    ``order`` is a list of sort expressions; rows that tie in all of them are told apart by the raw-record hash
    (a bootstrap batch shares one ingestion time), so the kept row does not depend on input order.  Only keys
    and order columns are needed besides what the caller selects.
    """
    w = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*order, *row_tiebreak(df))
    return (df.withColumn("_dedup_rn", F.row_number().over(w))
            .filter(F.col("_dedup_rn") == 1).drop("_dedup_rn"))


def dedup_latest(df: DataFrame, keys: Sequence[str], ts_col: str = "_ingestion_timestamp",
                 then: Sequence[Column] = ()) -> DataFrame:
    """Latest version per key (by ingestion time)."""
    return dedup(df, keys, [F.col(ts_col).desc_nulls_last(), *then])


def dedup_by_metric(df: DataFrame, keys: Sequence[str], metric: Column,
                    then: Sequence[Column] = ()) -> DataFrame:
    """Version with the largest metric per key."""
    return dedup(df, keys, [metric.desc_nulls_last(), *then])


def items_order_latest() -> list[Column]:
    """Order of typed items: the latest, then the most rated."""
    return [F.col("_ingestion_timestamp").desc_nulls_last(), F.col("ratings_count").desc_nulls_last()]


def items_order_most_rated() -> list[Column]:
    return [F.col("ratings_count").desc_nulls_last(), F.col("_ingestion_timestamp").desc_nulls_last()]


def typed_items(raw: DataFrame, cfg: ScoringConfig = DEFAULT) -> DataFrame:
    """P1 + P2 + P3: raw strings → typed columns, nested fields pulled up."""
    rc = S.clean_numeric("ratings_count", "bigint")
    return raw.select(
        F.col("book_id").cast("string").alias("book_id"),
        F.col("title"),
        S.first_field("authors", "author_id").alias("primary_author_id"),
        S.clean_numeric("average_rating", "double").alias("average_rating"),
        rc.alias("ratings_count"),
        S.clean_numeric("text_reviews_count", "bigint").alias("text_reviews_count"),
        S.clean_numeric("num_pages", "int").alias("num_pages"),
        *[_opt(raw, c).alias(c) for c in ITEM_TEXT_COLUMNS],
        S.first_field("popular_shelves", "name").alias("shelf_genre"),
        S.quality_flag(rc, cfg).alias("data_quality_flag"),
        _opt(raw, "_ingestion_timestamp", "timestamp").alias("_ingestion_timestamp"),
        *[F.col(ROW_HASH) for c in raw.columns if c == ROW_HASH],
    )


def valid_items(typed: DataFrame) -> DataFrame:
    """Id, title and a positive rating are required."""
    return typed.filter(F.col("book_id").isNotNull() & F.col("title").isNotNull()
                        & F.col("average_rating").isNotNull()
                        & (F.col("average_rating") > 0))


def silver_items(raw: DataFrame, cfg: ScoringConfig = DEFAULT,
                 order: Sequence[Column] | None = None) -> DataFrame:
    """stg_books: dedup *then* validate (a kept invalid version drops the id).

    Columns are typed and projected before the window, so it carries the columns of Silver and nothing else of the raw
    record; ``order`` sorts typed rows.
    """
    typed = typed_items(raw.filter(F.col("book_id").isNotNull()), cfg)
    kept = dedup(typed, ["book_id"], order if order is not None else items_order_latest())
    return valid_items(kept).drop(ROW_HASH).withColumn("_silver_timestamp", F.current_timestamp())


def valid_reviews(raw: DataFrame) -> DataFrame:
    """P5: ids present, star rating between 1 and 5 (text ratings tolerated)."""
    r = S.clean_numeric("rating", "int")
    return raw.filter(F.col("review_id").isNotNull() & F.col("book_id").isNotNull()
                      & r.between(1, 5))


def silver_reviews(raw: DataFrame, salt: str | None = None) -> DataFrame:
    """P10 = P5 + F1-F4: the raw user id is replaced by its hash."""
    rating = S.clean_numeric("rating", "int")
    date = S.parse_date("date_added")
    return valid_reviews(raw).select(
        F.col("review_id").cast("string").alias("review_id"),
        F.col("book_id").cast("string").alias("book_id"),
        S.hash_id("user_id", salt).alias("user_id_hashed"),
        rating.alias("rating"),
        S.classify_rating(rating).alias("sentiment"),
        date.alias("review_date"),
        S.year_of(date).alias("review_year"),
        _opt(raw, "review_text").alias("review_text"),
        _opt(raw, "_ingestion_timestamp", "timestamp").alias("_ingestion_timestamp"),
        F.current_timestamp().alias("_silver_timestamp"),
    )


def critical_nulls(df: DataFrame, cols: Sequence[str] = ("book_id", "average_rating")) -> DataFrame:
    """Rows where any critical column is NULL, counted in one pass."""
    cond = F.lit(False)
    for c in cols:
        cond = cond | F.col(c).isNull()
    return df.agg(F.count_if(cond).alias("null_rows"))
