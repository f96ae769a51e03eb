"""Driver star tables → the raw catalogue shapes (books, reviews, wide genres).

The driver ships TPC-H-like tables, not catalogue JSON.  These functions map
them onto the same raw (Bronze) shapes the JSON ingest produces, so every
operator downstream runs unchanged on either input:

* ``raw_items``   several versions per part, numerics as *strings* like the raw
                  feed, ``authors``/``popular_shelves`` as arrays of structs: the
                  newest sums up all order lines, older ones (one per supplier)
                  theirs; some newest versions are dirty (no title, rating 0,
                  text for a number, no author), some tie with older ones;
* ``raw_reviews`` one row per order line, ``review_id`` deliberately not
                  unique; the lines of a tenth of the parts carry a NULL
                  ``book_id`` (invalid reviews), so those items have none;
* ``raw_genres``  one row per part, one count column per market segment,
                  NULL when zero, all NULL for a seventh of the parts.

The modulo rules below only shape *values* (dirty ids, NULL counts and pages,
unparseable dates, invalid ratings) so every edge case occurs; no rule drops
a row: every line of every table reaches Bronze and is aggregated.

All three are lazy plans: lineitem is aggregated by part with partial (map
side) aggregation and joined to orders/customer on their keys; nothing is
collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the star mapping (FIXTURES.md §2):
#   num_pages = p_size * 20, NULL when p_size % 13 = 0
#   items: per part a newest version over all its lines (2024-01-01; 2023-06-01, as
#   the older ones, when p_partkey % 5 = 0) and one older version per supplier over
#   that supplier's lines; _row_hash = 0 for the newest, else l_suppkey
#   newest version only: title NULL when p_partkey % 17 = 0, average_rating '0' when
#   % 19 = 0 and 'not rated' when % 23 = 0, no authors when % 29 = 0; num_pages 'n/a'
#   instead of NULL when p_partkey is even
#   average_rating = least(5.0, avg(l_quantity) / 6.0)
#   ratings_count = sum(l_quantity); shelf = lower(p_type), NULL when p_partkey % 49 = 0
#   review book_id NULL for lines with l_partkey % 10 = 0 (FIXTURES drops them;
#   a NULL id keeps the row and gives the same items without reviews)
#   review_id = l_orderkey * 10 + l_linenumber
#   rating = 0 when l_linenumber = 7, else ceil(l_quantity / 10)
#   date_added = l_shipdate as yyyy-MM-dd, text 'n/a' when l_suppkey % 11 = 0
#   genre counts all NULL for parts with p_partkey % 7 = 0 (FIXTURES drops the
#   row; all-NULL counts give the same shelf fallback); one column per c_mktsegment
#: Order lines that one task of a shuffle by key is dealt, so that its sorts and hash maps keep their size as tables grow.
LINES_PER_TASK = 500_000
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
BATCH = "star"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _reader(spark: SparkSession, sf_dir: str, read=None):
    """``read(name)``: the caller's shared table reader, else a fresh read."""
    return read if read is not None else (lambda name: table(spark, sf_dir, name))


def dealt(lines: DataFrame, *keys: str, counted: DataFrame | None = None) -> DataFrame:
    """``lines`` in as many partitions of ``keys`` as their count asks for; unchanged where the session's number is enough.

    AQE merges partitions of a shuffle but never makes more, so with the session's number a task's memory would grow with
    the table.  The count comes from the Parquet footers; for lines that are joined already, from the table ``counted``.
    """
    tasks = -(-(lines if counted is None else counted).count() // LINES_PER_TASK)
    if tasks <= int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return lines
    return lines.repartition(tasks, *keys)


def _batch_ts() -> "F.Column":
    # Fixed stamp: the star tables are one bootstrap batch.
    return F.lit("2024-01-01 00:00:00").cast("timestamp")


def raw_items(spark: SparkSession, sf_dir: str, read=None) -> DataFrame:
    """All versions of all parts.  ``lineitem`` is added up once per part and supplier; both kinds of version use that."""
    read = _reader(spark, sf_dir, read)
    part = read("part").select("p_partkey", "p_name", "p_type", "p_size")
    # Dealt by part, which the sums per supplier, those per part and the joins all go by; no part is without a key.
    lines = dealt(read("lineitem").select("l_partkey", "l_suppkey", "l_quantity"), "l_partkey").filter("l_partkey IS NOT NULL")
    per_supplier = lines.groupBy("l_partkey", "l_suppkey").agg(
        F.sum("l_quantity").alias("sum_q"), F.count(F.lit(1)).alias("n_lines"))
    old = per_supplier.select("l_partkey", F.struct(
        F.lit(False).alias("newest"), F.col("l_suppkey").alias("supp"), "sum_q", "n_lines").alias("v"))
    newest = per_supplier.groupBy("l_partkey").agg(F.struct(
        F.lit(True).alias("newest"), F.min("l_suppkey").alias("supp"), F.sum("sum_q").alias("sum_q"),
        F.sum("n_lines").alias("n_lines")).alias("v"))
    old_rows = part.join(old, part.p_partkey == old.l_partkey)
    new_rows = part.join(newest, part.p_partkey == newest.l_partkey, "left")  # a part without lines has one version
    rows = old_rows.unionByName(new_rows)
    key, is_new = F.col("p_partkey"), F.coalesce("v.newest", F.lit(True))
    rating = F.least(F.lit(5.0), F.col("v.sum_q") / F.col("v.n_lines") / 6.0).cast("string")
    rating = F.when(is_new & (key % 19 == 0), "0").when(is_new & (key % 23 == 0), "not rated").otherwise(rating)
    pages = F.when(F.col("p_size") % 13 != 0, (F.col("p_size") * 20).cast("string")).when(key % 2 == 0, "n/a")
    shelf = F.when(key % 49 != 0, F.lower("p_type"))
    author = F.when(~(is_new & (key % 29 == 0)), F.col("v.supp").cast("string"))
    stamp = F.when(is_new & (key % 5 != 0), F.lit("2024-01-01 00:00:00")).otherwise(F.lit("2023-06-01 00:00:00"))
    return rows.select(
        key.cast("string").alias("book_id"),
        F.when(~(is_new & (key % 17 == 0)), F.col("p_name")).alias("title"),
        F.when(author.isNotNull(), F.array(F.struct(author.alias("author_id"))))
        .otherwise(F.array().cast("array<struct<author_id:string>>")).alias("authors"),
        F.when(shelf.isNotNull(), F.array(F.struct(shelf.alias("name"))))
        .otherwise(F.array().cast("array<struct<name:string>>")).alias("popular_shelves"),
        rating.alias("average_rating"),
        F.col("v.sum_q").cast("bigint").cast("string").alias("ratings_count"),
        F.col("v.n_lines").cast("string").alias("text_reviews_count"),
        pages.alias("num_pages"),
        stamp.cast("timestamp").alias("_ingestion_timestamp"),
        F.lit(f"{sf_dir.rstrip('/')}/part.parquet").alias("_source_file"),
        F.lit(BATCH).alias("_batch_id"),
        F.when(is_new, F.lit(0).cast("long")).otherwise(F.col("v.supp").cast("long")).alias("_row_hash"),
    )


LINE_COLUMNS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate")


def lines_with_orders(spark: SparkSession, sf_dir: str, read=None) -> DataFrame:
    """Order lines with their customer; reviews and genre counts are both made from it."""
    read = _reader(spark, sf_dir, read)
    lines, orders = read("lineitem").select(*LINE_COLUMNS), read("orders").select("o_orderkey", "o_custkey")
    lines = dealt(lines, "l_orderkey")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).drop("o_orderkey")


def raw_reviews(spark: SparkSession, sf_dir: str, read=None, lines: DataFrame | None = None) -> DataFrame:
    j = lines if lines is not None else lines_with_orders(spark, sf_dir, read)
    rating = F.when(F.col("l_linenumber") == 7, F.lit(0)).otherwise(
        F.ceil(F.col("l_quantity") / 10).cast("int"))
    date_txt = F.when(F.col("l_suppkey") % 11 == 0, F.lit("n/a")).otherwise(
        F.date_format("l_shipdate", "yyyy-MM-dd"))
    return j.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string").alias("review_id"),
        F.when(F.col("l_partkey") % 10 != 0, F.col("l_partkey").cast("string")).alias("book_id"),
        F.col("o_custkey").cast("string").alias("user_id"),
        rating.cast("bigint").alias("rating"),
        F.lit(None).cast("string").alias("review_text"),
        date_txt.alias("date_added"),
        # Raw ordering columns, used as the total dedup order of reviews.
        F.col("l_shipdate").alias("shipped_at"),
        F.col("l_partkey").alias("o_part"),
        F.col("l_suppkey").alias("o_supp"),
        F.col("l_quantity").alias("o_qty"),
        F.col("l_extendedprice").alias("o_price"),
        _batch_ts().alias("_ingestion_timestamp"),
        F.lit(BATCH).alias("_batch_id"),
    )


def review_order() -> list:
    """Total order of star reviews sharing an id: latest ship date first."""
    return [F.col("shipped_at").desc_nulls_last(), F.col("o_part").asc(),
            F.col("o_supp").asc(), F.col("o_qty").asc(), F.col("o_price").asc()]


def raw_genres(spark: SparkSession, sf_dir: str, read=None, lines: DataFrame | None = None) -> DataFrame:
    """Wide genre counts: conditional aggregation, one partial-aggregated pass."""
    read = _reader(spark, sf_dir, read)
    cust = read("customer").select("c_custkey", "c_mktsegment")
    lines = lines if lines is not None else lines_with_orders(spark, sf_dir, read)
    # Dealt by customer too: where customers are too many to broadcast, both sides of this join are sorted.
    lines = dealt(lines.select("l_partkey", "o_custkey"), "o_custkey", counted=read("lineitem"))
    seg = lines.join(cust, lines.o_custkey == cust.c_custkey)
    counts = seg.groupBy("l_partkey").agg(*[
        F.count_if(F.col("c_mktsegment") == s).alias(f"n_{s.lower()}") for s in SEGMENTS])
    part = read("part").select("p_partkey")
    j = part.join(counts, part.p_partkey == counts.l_partkey, "left")
    listed = F.col("p_partkey") % 7 != 0
    return j.select(
        F.col("p_partkey").cast("string").alias("book_id"),
        *[F.when(listed, F.nullif(F.col(f"n_{s.lower()}"), F.lit(0))).cast("bigint")
          .alias(f"genre_{s.lower()}") for s in SEGMENTS],
        _batch_ts().alias("_ingestion_timestamp"),
        F.lit(BATCH).alias("_batch_id"),
    )
