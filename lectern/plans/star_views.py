"""The star-table inputs of every registered query, built once per query call.

``Inputs`` holds lazy DataFrames (no ``cache()``): Bronze-shaped raw tables
from the star adapter and the Silver/Gold layers derived from them.  Each
registered query takes what it needs, so Catalyst prunes the rest and every
query still reads the whole base tables it depends on.  Layers named in
``stage`` are the exception: they are written once (a Parquet table under
``spark.checkpoint.dir``) when first used, because the query reads them in
more than one branch.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..config import ScoringConfig, star_config
from ..session import materialize, run_concurrently
from ..operators import clean, enrich, quality, report, reshape, score
from ..sources import star


@dataclass
class Inputs:
    spark: SparkSession
    sf_dir: str
    cfg: ScoringConfig = None  # type: ignore[assignment]
    # Layers written once (Parquet under spark.checkpoint.dir) before use:
    # "bronze" for the three raw tables, "enriched" for int_books_enriched.
    # Queries whose plan reads a layer in several branches stage it; the
    # others stay one lazy plan.
    stage: frozenset = frozenset()

    def __post_init__(self):
        if self.cfg is None:
            self.cfg = star_config()
        self._schemas: dict = {}

    def table(self, name: str) -> DataFrame:
        """A fresh read of a base table; its schema is read once per query.

        Fresh reads keep attribute ids distinct across branches (no self-join
        de-duplication during analysis); the known schema skips footer reads.
        """
        path = f"{self.sf_dir.rstrip('/')}/{name}.parquet"
        if name not in self._schemas:
            df = self.spark.read.parquet(path)
            self._schemas[name] = df.schema
            return df
        return self.spark.read.schema(self._schemas[name]).parquet(path)

    def _staged(self, layer: str, df: DataFrame, label: str) -> DataFrame:
        return materialize(df, label) if layer in self.stage else df

    @cached_property
    def lines(self) -> DataFrame | None:
        """The joined order lines, written once for both tables that read them, where Bronze is staged."""
        if "bronze" not in self.stage:
            return None
        return materialize(star.lines_with_orders(self.spark, self.sf_dir, self.table), "lines")

    # Bronze-shaped raw tables
    @cached_property
    def raw_items(self) -> DataFrame:
        return self._staged("bronze", star.raw_items(self.spark, self.sf_dir, self.table),
                            "bronze_items")

    @cached_property
    def raw_reviews(self) -> DataFrame:
        return self._staged("bronze", star.raw_reviews(self.spark, self.sf_dir, self.table, self.lines),
                            "bronze_reviews")

    @cached_property
    def raw_genres(self) -> DataFrame:
        return self._staged("bronze", star.raw_genres(self.spark, self.sf_dir, self.table, self.lines),
                            "bronze_genres")

    # Silver
    @cached_property
    def silver_items(self) -> DataFrame:
        return clean.silver_items(self.raw_items, self.cfg)

    @cached_property
    def silver_reviews(self) -> DataFrame:
        return clean.silver_reviews(self.raw_reviews)

    @cached_property
    def primary_genre(self) -> DataFrame:
        return reshape.primary_category(self.raw_genres)

    @cached_property
    def review_metrics(self) -> DataFrame:
        return enrich.review_metrics(self.silver_reviews)

    @cached_property
    def enriched(self) -> DataFrame:
        """int_books_enriched (staged when the query ranks or reuses it).

        Ranking joins the scored rows back to their histogram; without a
        staged input both branches would re-run the whole star lineage
        (column pruning makes them different plans, so no exchange is reused).
        """
        built = enrich.enrich_items(self.silver_items, self.primary_genre, self.review_metrics)
        return self._staged("enriched", built, "enriched")

    # Gold
    @cached_property
    def candidates(self) -> DataFrame:
        return score.candidates(self.enriched, self.cfg)

    @cached_property
    def scored(self) -> DataFrame:
        return score.score_items(score.eligible_items(self.enriched, self.cfg), self.cfg)

    @cached_property
    def genre_mart(self) -> DataFrame:
        return report.genre_performance(self.enriched, self.cfg)

    @cached_property
    def models(self) -> dict[str, DataFrame]:
        """Every tested model of the reference, built from the star tables."""
        if "bronze" in self.stage:  # independent writes, side by side
            self.lines  # noqa: B018 - read by two of them
            done = run_concurrently({n: (lambda n=n: getattr(self, n)) for n in ("raw_items", "raw_reviews", "raw_genres")})
            for failed in (e for e in done.values() if isinstance(e, Exception)):
                raise failed
        return {
            "bronze_books": self.raw_items, "bronze_reviews": self.raw_reviews,
            "bronze_genres": self.raw_genres, "stg_books": self.silver_items,
            "stg_reviews": self.silver_reviews, "stg_genres": self.primary_genre,
            "int_books_enriched": self.enriched,
            "mart_audiobook_candidates": self.candidates,
            "mart_genre_performance": self.genre_mart,
        }


# Parameters of the star queries (not data subsets):
# the documented listening words never occur in the driver's invented prose,
# so the oracle runs the same operator with patterns that do.
ORACLE_PATTERNS = {"mentions_narrator": "the", "mentions_pacing": "tion",
                   "audiobook_risk": "ment|ness"}
# Erasure request: the subjects are users 7 and 42, named only by their hash.
SUBJECT_HASHES = tuple(hashlib.sha256(u.encode()).hexdigest() for u in ("7", "42"))
AUDIT_PREFIX = "c"
AUDIT_TABLES = "1"
# Rules that the driver's raw tables break (three of five languages are not allowed, and so on).
DOMAIN_TESTS = (
    quality.Test("accepted_values", "documents", "lang", ("en", "fr")),
    quality.Test("accepted_values", "orders", "o_orderstatus", ("F", "O")),
    quality.Test("accepted_values", "labels", "toxic", (0,)),
    quality.Test("relationships", "lineitem", "l_suppkey", (), "part", "p_size", "warn"),
)
AUDIT_SINCE = "2024-01-15 00:00:00"
