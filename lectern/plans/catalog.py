"""Registered queries: name → (spark, sf_dir) → DataFrame.

Each entry runs one operator of SURVEY §2 over the whole star tables (through
``star_views.Inputs``) and drops ``current_timestamp`` columns so the result
can be compared with its DuckDB twin in ``oracle.SQL``.  Parameters that the
star data needs (thresholds, oracle text patterns, subject ids) are fixed in
``star_views``; none of them subsets the input.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import LEGACY3, PRESETS, star_config
from ..functions import scalar as S
from ..operators import clean, enrich, governance, quality, report, reshape, score, text
from ..sources import jsonl, star
from . import star_views as V
from .star_views import Inputs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


GOLD = frozenset({"enriched"})


def register(name: str, stage: frozenset = frozenset()):
    """Register ``fn`` under ``name``; ``stage`` names layers written once first."""
    def deco(fn: Callable[[Inputs], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Inputs(spark, sf_dir, stage=stage))
        run.__doc__ = fn.__doc__
        run.__name__ = name
        QUERIES[name] = run
        return fn
    return deco


def drop_stamps(df: DataFrame) -> DataFrame:
    """Remove clock columns (``_*_timestamp``) that cannot match an oracle."""
    return df.drop(*[c for c in df.columns if c.startswith("_") and c.endswith("_timestamp")])


# --- P: projections and filters --------------------------------------------

@register("typed_items")
def q_typed_items(i: Inputs) -> DataFrame:
    """Raw numeric strings → double / bigint / int (bad text → NULL)."""
    return clean.typed_items(i.raw_items, i.cfg).select(
        "book_id", "average_rating", "ratings_count", "text_reviews_count", "num_pages")


@register("primary_contributor")
def q_primary_contributor(i: Inputs) -> DataFrame:
    """First element's field of arrays of structs."""
    return i.raw_items.select(
        "book_id", S.first_field("authors", "author_id").alias("primary_author_id"),
        S.first_field("popular_shelves", "name").alias("shelf_genre"))


@register("quality_flag")
def q_quality_flag(i: Inputs) -> DataFrame:
    """Confidence flag from the ratings count."""
    return clean.typed_items(i.raw_items, i.cfg).select(
        "book_id", "ratings_count", "data_quality_flag")


@register("valid_items")
def q_valid_items(i: Inputs) -> DataFrame:
    """Items with id, title and a positive rating."""
    return clean.valid_items(clean.typed_items(i.raw_items, i.cfg)).select(
        "book_id", "title", "average_rating")


@register("valid_reviews")
def q_valid_reviews(i: Inputs) -> DataFrame:
    """P5: reviews with ids and a 1-5 star rating."""
    return clean.valid_reviews(i.raw_reviews).select("review_id", "book_id", "rating",
                                                     "date_added")


@register("eligible_items")
def q_eligible_items(i: Inputs) -> DataFrame:
    """Reliable items outside the excluded genres."""
    return score.eligible_items(i.enriched, i.cfg).select(
        "book_id", "primary_genre", "data_quality_flag")


@register("long_texts")
def q_long_texts(i: Inputs) -> DataFrame:
    """Whole documents longer than 50 characters."""
    return text.long_texts(i.table("documents"), "text").select(
        "doc_id", "lang", F.length("text").alias("text_length"))


@register("critical_nulls", GOLD)
def q_critical_nulls(i: Inputs) -> DataFrame:
    """Rows with a NULL id or rating, per layer."""
    parts = [clean.critical_nulls(df).select(F.lit(name).alias("layer"), "null_rows")
             for name, df in (("bronze_books", clean.typed_items(i.raw_items, i.cfg)),
                              ("silver_books", i.silver_items), ("enriched", i.enriched))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("silver_reviews")
def q_silver_reviews(i: Inputs) -> DataFrame:
    """P10: validated reviews, user id replaced by its SHA-256, sentiment, date."""
    return drop_stamps(i.silver_reviews)


# --- U: reshape --------------------------------------------------------------

@register("genre_long")
def q_genre_long(i: Inputs) -> DataFrame:
    """Wide genre counts → long with ``stack`` (NULL counts kept)."""
    return reshape.stack_long(i.raw_genres)


@register("genre_unpivot")
def q_genre_unpivot(i: Inputs) -> DataFrame:
    """``UNPIVOT`` semantics: NULLs dropped, then counts > 0."""
    return reshape.unpivot_long(i.raw_genres)


@register("primary_genre")
def q_primary_genre(i: Inputs) -> DataFrame:
    """Largest positive genre count per item, ties by genre name."""
    return i.primary_genre


# --- J: joins ----------------------------------------------------------------

@register("items_with_genre")
def q_items_with_genre(i: Inputs) -> DataFrame:
    """Items ⟕ primary genre, shelf fallback, default label."""
    return enrich.items_with_genre(i.silver_items, i.primary_genre).select(
        "book_id", "primary_genre", "shelf_genre")


@register("items_with_metrics")
def q_items_with_metrics(i: Inputs) -> DataFrame:
    """Items ⟕ review metrics, missing metrics filled with 0."""
    return enrich.items_with_metrics(i.silver_items, i.review_metrics).select(
        "book_id", *enrich.REVIEW_FILL, "first_review_date", "latest_review_date")


@register("fused_sentiment")
def q_fused_sentiment(i: Inputs) -> DataFrame:
    """Label-table sentiment ⋈ text signals, fused (risk wins)."""
    signals = text.text_signals(i.table("documents").select("doc_id", "text"), "text",
                                V.ORACLE_PATTERNS)
    nlp = text.label_sentiment(i.table("labels"))
    return text.fuse_sentiment(nlp, signals.drop("text"), key="doc_id").select(
        "doc_id", "nlp_sentiment", "audiobook_risk", "final_sentiment")


ENRICHED_OUT = ("book_id", "title", "primary_author_id", "average_rating", "ratings_count",
                "text_reviews_count", "num_pages", "data_quality_flag", "primary_genre",
                *enrich.REVIEW_FILL, "first_review_date", "latest_review_date")


@register("enriched_items")
def q_enriched_items(i: Inputs) -> DataFrame:
    """The whole intermediate model (int_books_enriched)."""
    return i.enriched.select(*ENRICHED_OUT)


@register("orphan_reviews")
def q_orphan_reviews(i: Inputs) -> DataFrame:
    """Valid reviews whose item is not in the Silver items."""
    return enrich.orphans(i.silver_reviews, i.silver_items).select("review_id", "book_id")


# --- A: aggregates -----------------------------------------------------------

@register("review_metrics")
def q_review_metrics(i: Inputs) -> DataFrame:
    """A1: per-item review count, mean stars, sentiment shares, date span."""
    return i.review_metrics


@register("genre_performance")
def q_genre_performance(i: Inputs) -> DataFrame:
    """The genre mart."""
    return drop_stamps(i.genre_mart)


@register("quality_distribution")
def q_quality_distribution(i: Inputs) -> DataFrame:
    """A4: Silver items per confidence flag."""
    return report.quality_distribution(i.silver_items)


@register("top_genres")
def q_top_genres(i: Inputs) -> DataFrame:
    """A5: the 10 genres with most reliable items."""
    return report.top_genres(i.enriched, i.cfg, 10)


@register("genre_coverage")
def q_genre_coverage(i: Inputs) -> DataFrame:
    """Items with a real genre."""
    return report.genre_coverage(i.enriched)


@register("reviewed_items")
def q_reviewed_items(i: Inputs) -> DataFrame:
    """Items with review-based sentiment."""
    return report.reviewed_items(i.enriched)


# --- W: windows --------------------------------------------------------------

DEDUP_OUT = ("review_id", "book_id", "user_id", "rating", "date_added")


@register("dedup_latest")
def q_dedup_latest(i: Inputs) -> DataFrame:
    """One review per id, the latest by ship date (total tie-break)."""
    order = star.review_order()
    return clean.dedup(i.raw_reviews, ["review_id"], order).select(*DEDUP_OUT)


@register("dedup_items")
def q_dedup_items(i: Inputs) -> DataFrame:
    """The latest version per item, ties by ratings and then by the raw-record hash."""
    typed = clean.typed_items(i.raw_items, i.cfg)
    return clean.dedup_latest(typed, ["book_id"], then=[F.col("ratings_count").desc_nulls_last()]).select(
        "book_id", "title", "ratings_count", "average_rating")


@register("dedup_by_metric")
def q_dedup_by_metric(i: Inputs) -> DataFrame:
    """One review per id, the highest rating (then the W1 order)."""
    return clean.dedup_by_metric(i.raw_reviews, ["review_id"], F.col("rating"),
                                 then=star.review_order()).select(*DEDUP_OUT)


@register("global_rank", GOLD)
def q_global_rank(i: Inputs) -> DataFrame:
    """Global RANK by score, from a bounded histogram (no single-partition window)."""
    return score.global_rank(i.scored.select("book_id", "weighted_score"))


@register("global_rank_unrounded")
def q_global_rank_unrounded(i: Inputs) -> DataFrame:
    """Global RANK of every order line by its unrounded revenue."""
    lines = i.table("lineitem").select("l_orderkey", "l_linenumber", (
        F.col("l_extendedprice").cast("double") * (F.lit(1.0) - F.col("l_discount").cast("double"))).alias("revenue"))
    return score.global_rank(lines, "revenue", "revenue_rank")


@register("genre_rank", GOLD)
def q_genre_rank(i: Inputs) -> DataFrame:
    """RANK within genre by score."""
    return score.group_rank(i.scored.select("book_id", "primary_genre", "weighted_score"))


@register("best_per_genre", GOLD)
def q_best_per_genre(i: Inputs) -> DataFrame:
    """Best candidate per genre (ROW_NUMBER = 1, ties by id)."""
    return report.best_per_genre(i.candidates, i.cfg.excluded_genres)


# --- L: sort, limit, union ---------------------------------------------------

@register("top_candidates", GOLD)
def q_top_candidates(i: Inputs) -> DataFrame:
    """L1: the top 10 candidates."""
    return report.top_candidates(i.candidates, 10)


@register("genre_strategy")
def q_genre_strategy(i: Inputs) -> DataFrame:
    """L2: the genre strategy report."""
    return report.genre_strategy(i.genre_mart)


@register("recommendation", GOLD)
def q_recommendation(i: Inputs) -> DataFrame:
    """L3: top item and top genre."""
    return report.recommendation(i.scored, i.genre_mart)


@register("layer_quality", GOLD)
def q_layer_quality(i: Inputs) -> DataFrame:
    """Rows and NULL ids per layer (UNION ALL of three aggregates)."""
    return report.layer_quality([("bronze_books", i.raw_items),
                                 ("silver_books", i.silver_items),
                                 ("gold_candidates", i.candidates)])


@register("layer_quality_files", GOLD)
def q_layer_quality_files(i: Inputs) -> DataFrame:
    """The same of the written tables, from their footers."""
    from ..session import scratch_path
    paths = []
    for name, df in (("bronze_books", i.raw_items), ("silver_books", i.silver_items), ("gold_candidates", i.candidates)):
        paths.append((name, scratch_path(i.spark, "layers", name)))
        df.write.parquet(paths[-1][1])
    return report.layer_quality_of_files(i.spark, paths)


# --- F: scalar functions -----------------------------------------------------

@register("hashed_users")
def q_hashed_users(i: Inputs) -> DataFrame:
    """SHA-256 pseudonym of every distinct user."""
    return (i.raw_reviews.select("user_id").distinct()
            .select("user_id", S.hash_id("user_id").alias("user_id_hashed")))


@register("rating_sentiment")
def q_rating_sentiment(i: Inputs) -> DataFrame:
    """star rating → positive / neutral / negative."""
    return i.raw_reviews.select("review_id", "book_id", "rating",
                                S.classify_rating("rating").alias("sentiment"))


@register("review_dates")
def q_review_dates(i: Inputs) -> DataFrame:
    """Text date → date (bad text → NULL) and its year."""
    d = S.parse_date("date_added")
    return i.raw_reviews.select("review_id", "book_id", "date_added", d.alias("review_date"),
                                S.year_of(d).alias("review_year"))


@register("popularity_score")
def q_popularity_score(i: Inputs) -> DataFrame:
    """F8: log popularity, normalised by the ceiling (shown to 6 dp)."""
    return i.silver_items.select("book_id", "ratings_count",
                                 F.round(S.popularity("ratings_count", i.cfg), 6)
                                 .alias("popularity_score"))


@register("sentiment_score")
def q_sentiment_score(i: Inputs) -> DataFrame:
    """review share, else rating proxy."""
    return i.enriched.select(
        "book_id", "total_reviews", "positive_review_pct", "average_rating",
        S.sentiment_score("positive_review_pct", "total_reviews", "average_rating", i.cfg)
        .alias("sentiment_score"))


@register("length_score")
def q_length_score(i: Inputs) -> DataFrame:
    """Overlapping page bands, first match wins."""
    return i.silver_items.select("book_id", "num_pages",
                                 S.length_score("num_pages").alias("length_score"),
                                 S.length_category("num_pages").alias("length_category"))


@register("weighted_score")
def q_weighted_score(i: Inputs) -> DataFrame:
    """the four-part score, rounded to 4 dp."""
    return i.scored.select("book_id", "weighted_score")


@register("score_breakdown")
def q_score_breakdown(i: Inputs) -> DataFrame:
    """each weighted part rounded on its own."""
    return i.scored.select("book_id", "weighted_score", "rating_contribution",
                           "popularity_contribution", "sentiment_contribution",
                           "length_contribution")


@register("legacy_score", GOLD)
def q_legacy_score(i: Inputs) -> DataFrame:
    """The older three-part model (proxy sentiment, no genre exclusion)."""
    return score.legacy_candidates(i.enriched, star_config(LEGACY3))


@register("legacy_genre_summary")
def q_legacy_genre_summary(i: Inputs) -> DataFrame:
    """M5: the older genre summary (only Uncategorised dropped)."""
    return report.legacy_genre_summary(i.enriched, star_config(LEGACY3))


@register("masked_ids")
def q_masked_ids(i: Inputs) -> DataFrame:
    """F16: tail mask for the analyst role, clear text otherwise."""
    c = i.table("customer").select("c_custkey", "c_name")
    both = governance.masked(governance.masked(c, "c_name", True, "analyst_view"), "c_name", False, "engineer_view")
    return both.drop("c_name")


@register("text_signals")
def q_text_signals(i: Inputs) -> DataFrame:
    """case-insensitive pattern flags over whole documents."""
    return text.text_signals(i.table("documents"), "text", V.ORACLE_PATTERNS).select(
        "doc_id", *V.ORACLE_PATTERNS)


# --- M: whole jobs -----------------------------------------------------------

@register("silver_items")
def q_silver_items(i: Inputs) -> DataFrame:
    """M1: stg_books (dedup, typed, validated)."""
    return drop_stamps(i.silver_items).select(
        "book_id", "title", "primary_author_id", "average_rating", "ratings_count",
        "text_reviews_count", "num_pages", "shelf_genre", "data_quality_flag")


@register("candidates", GOLD)
def q_candidates(i: Inputs) -> DataFrame:
    """M2: the candidates mart (the flagship query)."""
    return drop_stamps(i.candidates)


@register("strategy_ranks", GOLD)
def q_strategy_ranks(i: Inputs) -> DataFrame:
    """M4: each item ranked under the four weight presets."""
    return score.strategy_ranks(i.enriched, PRESETS, i.cfg)


# --- Q: data tests -----------------------------------------------------------

def _dq(i: Inputs, kinds: tuple[str, ...]) -> DataFrame:
    return quality.run_tests(i.models, kinds=kinds)


@register("dq_not_null", GOLD | {"bronze"})
def q_dq_not_null(i: Inputs) -> DataFrame:
    """Q1: the 32 not_null tests, failures per test."""
    return _dq(i, ("not_null",))


@register("dq_unique", GOLD | {"bronze"})
def q_dq_unique(i: Inputs) -> DataFrame:
    """Q2: the 6 unique tests (review_id duplicates are reported, by design)."""
    return _dq(i, ("unique",))


@register("dq_accepted_values", GOLD | {"bronze"})
def q_dq_accepted_values(i: Inputs) -> DataFrame:
    """Q3: the 4 accepted_values tests."""
    return _dq(i, ("accepted_values",))


@register("dq_domains")
def q_dq_domains(i: Inputs) -> DataFrame:
    """Q3 / Q4 on raw tables whose values do break the rules (languages, priorities, labels of documents)."""
    tables = {n: i.table(n) for n in ("documents", "orders", "labels", "part", "lineitem")}
    return quality.run_tests(tables, V.DOMAIN_TESTS)


@register("dq_relationships", frozenset({"bronze"}))
def q_dq_relationships(i: Inputs) -> DataFrame:
    """Q4: reviews of items that Silver doesn't hold, counted per item before the join."""
    return _dq(i, ("relationships",))


# --- G: compliance -----------------------------------------------------------

@register("subject_lookup")
def q_subject_lookup(i: Inputs) -> DataFrame:
    """G1: a subject's rows found by the hash of the raw id."""
    return governance.subject_lookup(i.raw_reviews, V.SUBJECT_HASHES).select(
        "review_id", "book_id", "user_id", "rating")


@register("genre_versions")
def q_genre_versions(i: Inputs) -> DataFrame:
    """A3: COUNT DISTINCT items per shelf over all versions, next to the rows."""
    typed = clean.typed_items(i.raw_items, i.cfg)
    return typed.groupBy("shelf_genre").agg(F.count_distinct("book_id").alias("books"), F.count(F.lit(1)).alias("versions"))


@register("subject_erasure")
def q_subject_erasure(i: Inputs) -> DataFrame:
    """Bronze reviews without the erased subjects."""
    return governance.erase_subjects(i.raw_reviews, V.SUBJECT_HASHES).select(
        "review_id", "book_id", "user_id", "rating")


@register("audit_log")
def q_audit_log(i: Inputs) -> DataFrame:
    """Actions with a prefix after a date, nested request field, newest first."""
    return governance.audit_log(i.table("events"), V.AUDIT_PREFIX, V.AUDIT_SINCE, prefix_on="action")


@register("audit_tables")
def q_audit_tables(i: Inputs) -> DataFrame:
    """Accesses to the tables whose (nested) name has a prefix, newest first."""
    return governance.audit_log(i.table("events"), V.AUDIT_TABLES, V.AUDIT_SINCE)


@register("snapshot_history", GOLD)
def q_snapshot_history(i: Inputs) -> DataFrame:
    """The mart written twice, a table and its erasure: operations and rows per table, in order of time."""
    from ..session import scratch_path
    root, bronze_root = scratch_path(i.spark, "snapshots"), scratch_path(i.spark, "bronze_reviews")
    governance.write_snapshot(drop_stamps(i.candidates), root, "CREATE OR REPLACE")
    governance.write_snapshot(drop_stamps(i.candidates), root, "WRITE")
    governance.write_snapshot(i.raw_reviews.select("review_id", "book_id", "user_id"), bronze_root, "WRITE")
    governance.erase_and_commit(i.spark, bronze_root, V.SUBJECT_HASHES)
    found = [governance.history(i.spark, path).withColumn("table_name", F.lit(name))
             for name, path in (("gold_candidates", root), ("bronze_reviews", bronze_root))]
    order = F.row_number().over(Window.partitionBy("table_name").orderBy("version")) - 1
    return found[0].unionByName(found[1]).select(order.cast("bigint").alias("version"), "operation", "rows", "table_name")


# --- S: ingest ---------------------------------------------------------------

@register("ingest_incremental")
def q_ingest_incremental(i: Inputs) -> DataFrame:
    """Events landed as JSON files in two batches, ingested exactly once."""
    from ..streaming import events_ingest
    return events_ingest.ingest_events(i.spark, i.table("events"))


@register("ingest_compressed")
def q_ingest_compressed(i: Inputs) -> DataFrame:
    """The same from gzip files."""
    from ..streaming import events_ingest
    return events_ingest.ingest_events(i.spark, i.table("events"), compression="gzip")


@register("ingest_evolving")
def q_ingest_evolving(i: Inputs) -> DataFrame:
    """A column that only the second landing has appears with it (NULL before)."""
    from ..streaming import events_ingest
    return events_ingest.ingest_events(i.spark, i.table("events"), later_column="props")


@register("ingest_rescue")
def q_ingest_rescue(i: Inputs) -> DataFrame:
    """What a schema misses, at any depth, is kept; lines that conform have nothing there."""
    from ..streaming import events_ingest
    return events_ingest.ingest_rescue(i.spark, i.table("events"))


@register("rejected_lines")
def q_rejected_lines(i: Inputs) -> DataFrame:
    """Lines that are no JSON, have a value of another type or an unknown field, per landing."""
    from ..streaming import events_ingest
    return events_ingest.rejected_lines(i.spark, i.table("events"))


@register("subject_erasure_rebuild")
def q_subject_erasure_rebuild(i: Inputs) -> DataFrame:
    """Silver reviews after the erasure of subjects from an ingested lake whose landed reviews are gone."""
    from . import star_landing
    layout = star_landing.erased_lake(i.spark, i.raw_items, i.raw_reviews, i.raw_genres, [*V.SUBJECT_HASHES, None], i.cfg)
    return drop_stamps(i.spark.read.parquet(layout.silver("stg_reviews")))


def _in_batches(i: Inputs, batches: int = 3, tested: bool = False):
    """Incremental Silver (and its tests) fed with the raw tables in batches, by a hash of the row; no row is left out."""
    from ..session import scratch_path
    from .incremental import IncrementalSilver
    from .incremental_tests import IncrementalTests
    silver = IncrementalSilver(i.spark, scratch_path(i.spark, "incremental"), i.cfg, buckets=16)
    tests = IncrementalTests(silver)
    parts = {name: df.withColumn("_part", F.pmod(F.xxhash64(*keys), F.lit(batches))) for name, df, keys in (
        ("books", i.raw_items, ("book_id", "_row_hash")), ("reviews", i.raw_reviews, ("book_id", "user_id", "review_id")),
        ("genres", i.raw_genres, ("book_id",)))}
    for k in range(batches):
        new = {name: df.filter(F.col("_part") == k).drop("_part") for name, df in parts.items()}
        touched = silver.refresh(new, k)
        if tested:
            bronze = {"bronze_books": new["books"], "bronze_reviews": new["reviews"],
                      "bronze_genres": new["genres"], "stg_reviews": silver.reviews_of(k)}
            tests.update(bronze, touched, k)
    return tests if tested else silver


@register("incremental_enriched", frozenset({"bronze"}))
def q_incremental_enriched(i: Inputs) -> DataFrame:
    """M1 / J4 kept up to date over three batches: equal to a full build."""
    return _in_batches(i).enriched().select(*ENRICHED_OUT)


@register("incremental_metrics", frozenset({"bronze"}))
def q_incremental_metrics(i: Inputs) -> DataFrame:
    """A1 from mergeable sums over three batches."""
    return _in_batches(i).review_metrics()


@register("incremental_tests", frozenset({"bronze"}))
def q_incremental_tests(i: Inputs) -> DataFrame:
    """Q1-Q4 of Bronze and Silver, each batch tested once; equal to a run over the whole tables."""
    return _in_batches(i, tested=True).report()


@register("enriched_bucketed")
def q_enriched_bucketed(i: Inputs) -> DataFrame:
    """The three Silver inputs as catalog tables in buckets of the key, joined without an exchange."""
    import uuid
    run = uuid.uuid4().hex[:12]
    tables = {f"stg_books_{run}": i.silver_items, f"stg_genres_{run}": i.primary_genre, f"metrics_{run}": i.review_metrics}
    if bad := [r for r in jsonl.register_tables(i.spark, tables, bucket_by="book_id", buckets=16) if r["error"]]:
        raise RuntimeError(f"tables not saved: {bad}")
    return enrich.enrich_items(*[i.spark.table(n) for n in tables]).select(*ENRICHED_OUT)
