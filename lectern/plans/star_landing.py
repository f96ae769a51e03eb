"""Land the star tables as a raw JSON-lines catalogue (books, reviews, genres).

Gives the full run (``layers.run_all``) the input shape of the raw feed:
numerics as strings, arrays of structs, and genre counts nested in a
``genres`` struct whose field names contain commas and hyphens, so Bronze has
to flatten and clean them.  Every row of the star mapping is landed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import governance
from ..session import lean_disk, run_concurrently, scratch_path
from ..sources import jsonl, star
from . import layers

# Raw genre field names: the segment name, with a comma-and-space or a hyphen
# in two of them, as in the raw feed's struct.
RAW_GENRE_NAMES = {"automobile": "automobile, transport", "building": "building",
                   "furniture": "furniture-home", "household": "household",
                   "machinery": "machinery"}

#: Fields of the landed datasets.
SCHEMAS = {**layers.SCHEMAS, "genres": layers.genre_schema(list(RAW_GENRE_NAMES.values()))}


#: How the erased lake's files are landed (lines of a file, gzip), and rows of its Bronze files.
LANDED = {"compression": "gzip", "maxRecordsPerFile": 100_000}
BRONZE_ROWS = 200_000

#: Characters of a document that a landed review or description carries.
TEXT_CHARS = 400


def _with_text(df: DataFrame, docs: DataFrame, number: Column, column: str, docs_count: int) -> DataFrame:
    """``df`` with the start of the document whose id is ``number`` modulo their count as ``column``."""
    numbered = df.withColumn("_doc", F.pmod(number.cast("long"), F.lit(docs_count)))
    texts = docs.select(F.col("doc_id").alias("_doc"), F.substring("text", 1, TEXT_CHARS).alias(column))
    return numbered.drop(column).join(texts, "_doc", "left").drop("_doc")


def land(spark: SparkSession, sf_dir: str, raw_root: str) -> dict[str, int]:
    """Write ``books``, ``reviews``, ``genres`` (plus tiny ``authors``/``series``), with texts of realistic length."""
    docs = star.table(spark, sf_dir, "documents")
    docs_count = docs.count()
    items = star.raw_items(spark, sf_dir).drop("_ingestion_timestamp", "_source_file", "_batch_id", "_row_hash")
    items = _with_text(items, docs, F.col("book_id"), "description", docs_count)
    reviews = star.raw_reviews(spark, sf_dir).select(
        "review_id", "book_id", "user_id", "rating", "review_text", "date_added")
    reviews = _with_text(reviews, docs, F.col("review_id"), "review_text", docs_count)
    g = star.raw_genres(spark, sf_dir)
    genres = g.select("book_id", F.struct(*[
        F.col(f"genre_{k}").alias(v) for k, v in RAW_GENRE_NAMES.items()]).alias("genres"))
    authors = items.select(F.explode("authors").alias("a")).select("a.author_id").distinct()
    series = items.select(F.col("book_id").alias("series_id"), F.col("title"))
    out = {}
    for name, df in (("books", items), ("reviews", reviews), ("genres", genres),
                     ("authors", authors), ("series", series)):
        # NULL fields are written out so inference sees every column.
        out[name] = jsonl.write_counted(df, f"{raw_root}/{name}", fmt="json",
                                        options={"ignoreNullFields": "false"})
    return out


def erased_lake(spark: SparkSession, items: DataFrame, reviews: DataFrame, genres: DataFrame, hashes: list,
                cfg) -> layers.Layout:
    """The whole catalogue landed and ingested, the landed reviews cleaned away, then the subjects erased.

    Landed files are gzip and of even size, so ingest parses them without the exchange of all lines.
    """
    with lean_disk(spark):
        return _erased_lake(spark, items, reviews, genres, hashes, cfg)


def _erased_lake(spark: SparkSession, items: DataFrame, reviews: DataFrame, genres: DataFrame, hashes: list,
                 cfg) -> layers.Layout:
    root = scratch_path(spark, "erased_lake")
    layout = layers.Layout(f"{root}/raw", f"{root}/lake", schemas=SCHEMAS, file_bytes=None, file_rows=BRONZE_ROWS)
    stamps = ("_ingestion_timestamp", "_source_file", "_batch_id", "_row_hash")
    wide = genres.select("book_id", F.struct(*[F.col(f"genre_{k}").alias(v) for k, v in RAW_GENRE_NAMES.items()]).alias("genres"))
    landed = {"books": items.drop(*stamps), "reviews": reviews.drop(*stamps), "genres": wide}
    done = run_concurrently({name: (lambda name=name: landed[name].write.options(**LANDED).json(f"{layout.raw}/{name}")) for name in landed})
    if failed := {k: v for k, v in done.items() if isinstance(v, Exception)}:
        raise RuntimeError(f"landing failed: {failed}")
    ingested = layers.ingest_bronze(spark, layout, tuple(landed), "landed")
    if failed := [r for r in ingested if r.status == "error"]:
        raise RuntimeError(f"ingest failed: {failed}")
    governance.remove(spark, f"{layout.raw}/reviews")
    layers.rebuild_after_erasure(spark, layout, hashes, cfg, gate=False)
    return layout
