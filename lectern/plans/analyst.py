"""Analyst queries over the written layers (the reference's third entry point).

``register_layers`` exposes a run's tables as temp views (no copy: each view
is a Parquet scan of the written files); ``run`` applies the report functions
(L1, L2, L5, W6) to the views.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..config import DEFAULT, ScoringConfig
from ..operators import governance, report
from ..streaming.ingest import read_bronze
from .layers import Layout

#: Analyst queries: the report functions over the registered views.
QUERIES = {
    "top_candidates": lambda t, cfg: report.top_candidates(t("gold_audiobook_candidates"), 10),
    "best_per_genre": lambda t, cfg: report.best_per_genre(t("gold_audiobook_candidates"), cfg.excluded_genres),
    "genre_strategy": lambda t, cfg: report.genre_strategy(t("gold_genre_summary")),
    "layer_quality": lambda t, cfg: report.layer_quality([
        ("bronze_books", t("bronze_books")), ("silver_books", t("silver_books")),
        ("gold_candidates", t("gold_audiobook_candidates"))]),
}


def register_layers(spark: SparkSession, layout: Layout) -> list[str]:
    """The run's tables as temp views (latest Gold versions)."""
    views = {
        "bronze_books": read_bronze(spark, layout.bronze("books")),
        "silver_books": spark.read.parquet(layout.silver("int_books_enriched")),
        "silver_reviews": spark.read.parquet(layout.silver("stg_reviews")),
        "gold_audiobook_candidates": governance.read_version(
            spark, layout.gold("mart_audiobook_candidates")),
        "gold_genre_summary": governance.read_version(
            spark, layout.gold("mart_genre_performance")),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)


def run(spark: SparkSession, name: str, cfg: ScoringConfig = DEFAULT) -> DataFrame:
    return QUERIES[name](spark.table, cfg)
