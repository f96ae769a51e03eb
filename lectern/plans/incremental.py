"""Silver kept up to date batch by batch.

Every keyed table of Silver is a state in buckets of the item key, all with the same bucketing: the winning version of
an item, its best genre, the sums of its reviews, the enriched row.  A batch is reduced by key first, and only the
buckets that it touches are read, merged and replaced; the reviews themselves are append-only and live by epoch.
What a refresh reads is the new rows and those buckets, never a whole table.

All merges are associative, so the result is that of a full build over all batches in any order.  Versions and genres merge
to the same whatever is merged twice; sums remember per item up to which epoch they count, so an epoch that comes
again after a crash adds nothing.

A merge writes its buckets to a staging folder of the state, complete before the first bucket is replaced.  Replacing goes
bucket by bucket; one that was cut off is finished from the staging folder before anything else is read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT, ScoringConfig
from ..functions import scalar as S
from ..operators import clean, enrich, governance, quality, reshape
from ..session import materialize
from ..streaming import ingest

BUCKETS = 256
DATASETS = ("books", "reviews", "genres")


class BucketState:
    """A keyed table in buckets, ``<path>/_bucket=b``, of which only some are replaced at a time."""

    def __init__(self, spark: SparkSession, path: str, key: str, buckets: int = BUCKETS):
        self.spark, self.path, self.key, self.buckets = spark, path.rstrip("/"), key, buckets
        self.staging = f"{self.path}__staging"

    def _exists(self, path: str) -> bool:
        fs, p = governance._fs(self.spark, path)
        return fs.exists(p)

    def bucket_of(self, key: str | None = None) -> Column:
        return F.pmod(F.xxhash64(F.col(key or self.key).cast("string")), F.lit(self.buckets)).cast("int")

    def read(self, buckets: Iterable[int] | None = None) -> DataFrame | None:
        """The table, or some buckets of it (the others aren't opened); None while it has no row."""
        self.finish()
        fs, p = governance._fs(self.spark, self.path)
        if not fs.exists(p) or not any(f.getPath().getName().startswith("_bucket=") for f in fs.listStatus(p)):
            return None
        rows = self.spark.read.parquet(self.path)
        return rows if buckets is None else rows.filter(F.col("_bucket").isin(sorted(buckets)))

    def touched(self, keyed: DataFrame, key: str | None = None) -> set[int]:
        """Buckets of the keys of a table: at most as many numbers as there are buckets."""
        return {r[0] for r in keyed.select(self.bucket_of(key)).distinct().collect()}

    def replace(self, rows: DataFrame, buckets: Iterable[int]) -> None:
        """Put ``rows`` in the place of the given buckets (one that has no row any more is emptied)."""
        buckets = sorted(buckets)
        self.finish()
        if "_bucket" not in rows.columns:
            rows = rows.withColumn("_bucket", self.bucket_of())
        (rows.repartition("_bucket").sortWithinPartitions("_bucket", self.key).write.mode("overwrite")
         .partitionBy("_bucket").parquet(self.staging))
        for b in buckets:
            if not self._exists(f"{self.staging}/_bucket={b}"):
                self._mark(f"_emptied/{b}")
        self._mark("_complete")                        # from here on the replacement will be finished, whatever happens
        self.finish()

    def _mark(self, name: str) -> None:
        fs, p = governance._fs(self.spark, f"{self.staging}/{name}")
        fs.create(p, True).close()

    def finish(self) -> None:
        """Finish a replacement that is complete in the staging folder; drop one that isn't.

        A bucket is deleted only while its successor is in the staging folder or it has none, so this can be cut off
        and begun again at any place.
        """
        if not self._exists(self.staging):
            return
        if self._exists(f"{self.staging}/_complete"):
            fs, staging = governance._fs(self.spark, self.staging)
            _, path = governance._fs(self.spark, self.path)
            fs.mkdirs(path)
            for part in fs.listStatus(staging):
                name = part.getPath().getName()
                if name.startswith("_bucket="):
                    _, target = governance._fs(self.spark, f"{self.path}/{name}")
                    fs.delete(target, True)
                    if not fs.rename(part.getPath(), target):
                        raise OSError(f"could not move {name} of {self.staging}")
            if self._exists(f"{self.staging}/_emptied"):
                for mark in fs.listStatus(governance._fs(self.spark, f"{self.staging}/_emptied")[1]):
                    governance.remove(self.spark, f"{self.path}/_bucket={mark.getPath().getName()}")
        governance.remove(self.spark, self.staging)
        self.spark.catalog.refreshByPath(self.path)

    def merge(self, new: DataFrame, combine: Callable[[DataFrame], DataFrame]) -> set[int]:
        """Merge rows that have the state's columns: ``combine`` reduces old and new rows to one per key."""
        touched = self.touched(new)
        if touched:
            old = self.read(touched)
            both = new if old is None else old.drop("_bucket").unionByName(new, allowMissingColumns=True)
            self.replace(combine(both), touched)
        return touched


# --- what is merged ------------------------------------------------------------------

def best_genre(genres: DataFrame) -> DataFrame:
    """Per item ``_best``: the largest positive count (negative, for order) and its column; mergeable by ``min``."""
    columns = reshape.category_columns(genres)
    each = [F.when(F.col(reshape._q(c)) > 0, F.struct((-F.col(reshape._q(c)).cast("bigint")).alias("n"),
                                                      F.lit(c).alias("name"))) for c in columns]
    if not each:
        return genres.sparkSession.createDataFrame([], "book_id string, _best struct<n: bigint, name: string>")
    rows = genres.select(F.col("book_id").cast("string").alias("book_id"),
                         F.array_min(F.array(*each, F.lit(None))).alias("_best"))
    return merge_genres(rows.filter(F.col("_best").isNotNull()))


def merge_genres(rows: DataFrame) -> DataFrame:
    return rows.groupBy("book_id").agg(F.min("_best").alias("_best"))


def genres_of(state: DataFrame) -> DataFrame:
    return state.select("book_id", S.strip_prefix(F.col("_best.name"), "genre_").alias("primary_genre"))


SUMS = ("_n", "_stars", "_rated", "_positive", "_neutral", "_negative")


def review_sums(reviews: DataFrame, epoch: int) -> DataFrame:
    """Per item the mergeable part of its review metrics (A1), marked with the epoch."""
    hits = lambda label: F.sum(F.when(F.col("sentiment") == label, 1).otherwise(0))
    return reviews.groupBy("book_id").agg(
        F.count("review_id").alias("_n"), F.sum(F.col("rating").cast("long")).alias("_stars"),
        F.count("rating").alias("_rated"), hits("positive").alias("_positive"), hits("neutral").alias("_neutral"),
        hits("negative").alias("_negative"), F.min("review_date").alias("_first"), F.max("review_date").alias("_last"),
    ).withColumn("_upto", F.lit(epoch).cast("long")).withColumn("_new", F.lit(True))


def merge_sums(rows: DataFrame) -> DataFrame:
    """Sums per item; a new row of an epoch that the item's sums already hold counts nothing."""
    known = rows.groupBy("book_id").agg(F.max(F.when(~F.coalesce("_new", F.lit(False)), F.col("_upto"))).alias("_known"))
    fresh = rows.join(known, "book_id").filter(
        ~F.coalesce("_new", F.lit(False)) | F.col("_known").isNull() | (F.col("_upto") > F.col("_known")))
    return fresh.groupBy("book_id").agg(
        *[F.sum(c).alias(c) for c in SUMS], F.min("_first").alias("_first"), F.max("_last").alias("_last"),
        F.max("_upto").alias("_upto")).withColumn("_new", F.lit(False))


def metrics_of(state: DataFrame) -> DataFrame:
    """The review metrics (A1) of summed items; the formulas of ``enrich.review_metrics``."""
    pct = lambda c: F.round(F.col(c) * 100.0 / F.col("_n"), 2)
    return state.select(
        "book_id", F.col("_n").alias("total_reviews"), F.round(F.col("_stars").cast("double") / F.col("_rated"), 2)
        .alias("avg_review_rating"), pct("_positive").alias("positive_review_pct"), pct("_neutral").alias("neutral_review_pct"),
        pct("_negative").alias("negative_review_pct"), F.col("_first").alias("first_review_date"),
        F.col("_last").alias("latest_review_date"))


#: Columns of the states while they have no row.
ITEMS = ", ".join(f"{c} {t}" for c, t in quality.CONTRACTS["stg_books"].items() if c != "_silver_timestamp")
GENRES = "book_id string, _best struct<n: bigint, name: string>"
SUMMED = "book_id string, " + ", ".join(f"{c} bigint" for c in SUMS) + ", _first date, _last date"


# --- the layer -------------------------------------------------------------------------

class IncrementalSilver:
    """Silver of a lake as states under ``root``."""

    def __init__(self, spark: SparkSession, root: str, cfg: ScoringConfig = DEFAULT,
                 item_order: Callable[[], Sequence[Column]] = clean.items_order_latest, buckets: int = BUCKETS):
        self.spark, self.root, self.cfg, self.item_order = spark, root.rstrip("/"), cfg, item_order
        state = lambda name: BucketState(spark, f"{self.root}/{name}", "book_id", buckets)
        self.items, self.genres, self.sums, self.rows = (state(n) for n in ("items", "genres", "sums", "enriched"))
        self.reviews = f"{self.root}/reviews"

    def _merge_items(self, rows: DataFrame) -> DataFrame:
        return clean.dedup(rows, ["book_id"], self.item_order())

    def refresh(self, new: dict[str, DataFrame], epoch: int) -> set[int]:
        """Take in the new Bronze rows of some datasets; the buckets of items whose enriched row may have changed.

        An epoch may come again (after a crash): it changes nothing then.
        """
        touched: set[int] = set()
        if "books" in new:
            typed = clean.typed_items(new["books"].filter(F.col("book_id").isNotNull()), self.cfg)
            touched |= self.items.merge(materialize(self._merge_items(typed), "new_items"), self._merge_items)
        if "genres" in new:
            touched |= self.genres.merge(materialize(best_genre(new["genres"]), "new_genres"), merge_genres)
        if "reviews" in new:
            path = f"{self.reviews}/_epoch={epoch}"
            clean.silver_reviews(new["reviews"]).write.mode("overwrite").parquet(path)
            written = self.spark.read.parquet(path)
            touched |= self.sums.merge(materialize(review_sums(written, epoch), "new_sums"), merge_sums)
        self._enrich(touched)
        return touched

    def _enrich(self, touched: set[int]) -> None:
        """Enriched rows of the given buckets, from the same buckets of the three states."""
        items = self.items.read(touched) if touched else None
        if items is None:
            return
        empty = self.spark.createDataFrame
        genres, sums = self.genres.read(touched), self.sums.read(touched)
        genres = genres_of(empty([], GENRES) if genres is None else genres)
        metrics = metrics_of(empty([], SUMMED) if sums is None else sums)
        self.rows.replace(enrich.enrich_items(self._valid(items), genres, metrics), touched)

    def _valid(self, items: DataFrame) -> DataFrame:
        return clean.valid_items(items).drop("_bucket", clean.ROW_HASH).withColumn("_silver_timestamp", F.current_timestamp())

    def _rows(self, state: BucketState, ddl: str) -> DataFrame:
        rows = state.read()
        return self.spark.createDataFrame([], ddl) if rows is None else rows

    def stg_books(self) -> DataFrame:
        return self._valid(self._rows(self.items, ITEMS))

    def stg_genres(self) -> DataFrame:
        return genres_of(self._rows(self.genres, GENRES))

    def stg_reviews(self) -> DataFrame:
        fs, p = governance._fs(self.spark, self.reviews)
        if not fs.exists(p):
            return self.spark.createDataFrame([], "review_id string, book_id string, rating int, sentiment string, review_date date")
        return self.spark.read.parquet(self.reviews).drop("_epoch")

    def reviews_of(self, epoch: int) -> DataFrame:
        """The Silver reviews of one epoch."""
        return self.spark.read.parquet(f"{self.reviews}/_epoch={epoch}")

    def review_metrics(self) -> DataFrame:
        return metrics_of(self._rows(self.sums, SUMMED))

    def enriched(self) -> DataFrame:
        rows = self.rows.read()
        if rows is None:
            return enrich.enrich_items(self.stg_books(), self.stg_genres(), self.review_metrics())
        return rows.drop("_bucket")

    # --- epochs of a Bronze lake ---

    def progress(self) -> dict[str, int]:
        """Last epoch taken in, per dataset (-1: none)."""
        path = f"{self.root}/_progress"
        fs, p = governance._fs(self.spark, path)
        if not fs.exists(p):
            return dict.fromkeys(DATASETS, -1)
        row = self.spark.read.schema(", ".join(f"{d} BIGINT" for d in DATASETS)).json(f"{path}/*").agg(
            *[F.max(d).alias(d) for d in DATASETS]).first()
        return {d: -1 if row[d] is None else int(row[d]) for d in DATASETS}

    def refresh_from(self, bronze: Callable[[str], str]) -> dict[str, int]:
        """Take in every Bronze epoch that came since; returns the rows of the new epochs per dataset.

        Epochs are known from load records; only their folders are read.  An epoch is recorded as taken in when all
        its states are replaced.
        """
        upto, taken = self.progress(), dict.fromkeys(DATASETS, 0)
        for name in DATASETS:
            loads = ingest.load_records(self.spark, bronze(name)).filter(F.col("epoch") > upto[name])
            for load in sorted(loads.select("epoch", "rows").collect()):
                rows = ingest.read_bronze(self.spark, bronze(name)).filter(F.col("_epoch") == load["epoch"])
                self.refresh({name: rows}, load["epoch"])
                upto[name], taken[name] = load["epoch"], taken[name] + load["rows"]
                (self.spark.createDataFrame([tuple(upto.values())], ", ".join(f"{d} BIGINT" for d in DATASETS)).coalesce(1)
                 .write.mode("overwrite").json(f"{self.root}/_progress/{'_'.join(map(str, upto.values()))}"))
        return taken

    def forget(self, bronze: Callable[[str], str], epochs: Iterable[int], hashes: Sequence[str | None]) -> set[int]:
        """Follow an erasure of Bronze: the epochs' reviews are written anew, and the sums of the subjects' items counted anew."""
        epochs, upto = sorted(epochs), self.progress()["reviews"]
        epochs = [e for e in epochs if e <= upto]
        if not epochs:
            return set()
        requests = governance.request_table(self.spark, hashes)
        old = self.spark.read.parquet(self.reviews).filter(F.col("_epoch").isin(epochs))
        keys = materialize(old.join(requests, F.col("user_id_hashed") == F.col("_erase_hash"), "left_semi")
                           .select("book_id").distinct(), "forgotten")
        for e in epochs:
            rows = ingest.read_bronze(self.spark, bronze("reviews")).filter(F.col("_epoch") == e)
            clean.silver_reviews(rows).write.mode("overwrite").parquet(f"{self.reviews}/_epoch={e}")
        self.spark.catalog.refreshByPath(self.reviews)
        touched = self.sums.touched(keys)
        if touched:
            counted = review_sums(self.stg_reviews().join(keys, "book_id", "left_semi"), upto).withColumn("_new", F.lit(False))
            kept = self.sums.read(touched).drop("_bucket").join(keys, "book_id", "left_anti")
            self.sums.replace(kept.unionByName(counted), touched)
            self._enrich(touched)
        return touched
