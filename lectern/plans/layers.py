"""The full run: raw JSON-lines → Bronze → Silver → Gold → data tests.

Each layer is written once and the next layer reads the written table (the
lineage is cut at every layer, a lost executor re-reads files).  Counts come
from ``observe`` during the writes; contracts are checked on the plan before
a write starts.  The declared tests of Bronze and Silver run before the marts
are built, those of the marts on staged marts before they are published: a
failing suite leaves Gold as it was.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT, ScoringConfig
from ..operators import clean, enrich, governance, quality, report, reshape, score
from ..session import run_concurrently, scratch_path
from ..sources import jsonl
from ..streaming import erasure
from ..streaming.ingest import IngestResult, IngestSpec, read_bronze, run_plan

DATASETS = ("books", "reviews", "genres", "authors", "series")
# The genres of the raw feed, and the fields of each dataset.
GENRES = ("children", "comics, graphic", "fantasy, paranormal", "fiction", "history, historical fiction, biography",
          "mystery, thriller, crime", "non-fiction", "poetry", "romance", "young-adult")


def genre_schema(names: Sequence[str]) -> str:
    return "book_id STRING, genres STRUCT<" + ", ".join(f"`{n}`: BIGINT" for n in names) + ">"


SCHEMAS = {
    "books": "book_id STRING, title STRING, average_rating STRING, ratings_count STRING, "
             "text_reviews_count STRING, num_pages STRING, authors ARRAY<STRUCT<author_id: STRING, role: STRING>>, "
             "popular_shelves ARRAY<STRUCT<count: STRING, name: STRING>>, language_code STRING, publisher STRING, "
             "format STRING, description STRING, isbn STRING, isbn13 STRING",
    "reviews": "review_id STRING, book_id STRING, user_id STRING, rating BIGINT, review_text STRING, date_added STRING",
    "genres": genre_schema(GENRES),
    "authors": "author_id STRING, name STRING, average_rating STRING, ratings_count STRING, text_reviews_count STRING",
    "series": "series_id STRING, title STRING, description STRING, note STRING",
}


@dataclass
class Layout:
    """Folder layout of one deployment (all on shared storage).

    ``schemas``: fields per dataset (None: inferred); ``exclude``: file-name suffix that ingest leaves out;
    ``max_rejected``: share of a file's lines that may be rejected before a gated run stops (None: any share);
    ``file_bytes``, ``file_rows``: how lines are dealt to tasks and Bronze files (``IngestSpec``).
    """
    raw: str
    root: str
    schemas: dict = field(default_factory=lambda: dict(SCHEMAS))
    exclude: str | None = None
    max_rejected: float | None = None
    file_bytes: int | None = IngestSpec.file_bytes
    file_rows: int | None = None

    def bronze(self, name: str) -> str:
        return f"{self.root}/bronze/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/bronze/_checkpoints/{name}"

    def silver(self, name: str) -> str:
        return f"{self.root}/silver/{name}"

    def gold(self, name: str) -> str:
        return f"{self.root}/gold/{name}"

    @property
    def requests(self) -> str:
        """Table of all erased subjects (``_erase_hash``)."""
        return f"{self.root}/erase_requests"


@dataclass
class RunReport:
    bronze: list[IngestResult] = field(default_factory=list)
    counts: dict[str, int] = field(default_factory=dict)
    versions: dict[str, int] = field(default_factory=dict)
    tests: list[dict] = field(default_factory=list)
    erased: erasure.Erased | None = None
    rejected: list[dict] = field(default_factory=list)


def _spec(spark: SparkSession, layout: Layout, name: str) -> IngestSpec:
    fs, p = governance._fs(spark, layout.requests)
    return IngestSpec(name, f"{layout.raw}/{name}", layout.bronze(name), layout.checkpoint(name),
                      schema=layout.schemas.get(name), exclude=layout.exclude, subject_index=name == "reviews",
                      file_bytes=layout.file_bytes, file_rows=layout.file_rows,
                      erase_requests=layout.requests if name == "reviews" and fs.exists(p) else None,
                      warn_below=jsonl.REVIEWS_WARN_BELOW if name == "reviews" else None)


def ingest_bronze(spark: SparkSession, layout: Layout, datasets: Sequence[str] = DATASETS,
                  batch_id: str | None = None) -> list[IngestResult]:
    """Every dataset through the incremental ingest; failures are reported."""
    return run_plan(spark, [_spec(spark, layout, name) for name in datasets], batch_id)


def _written(results: dict) -> dict:
    bad = {k: v for k, v in results.items() if isinstance(v, Exception)}
    if bad:
        raise RuntimeError(f"layer writes failed: {bad}")
    return results


def build_silver(spark: SparkSession, layout: Layout, cfg: ScoringConfig = DEFAULT,
                 item_order=None) -> dict[str, int]:
    """stg_reviews, stg_genres and stg_books (independent, written side by side),
    then int_books_enriched from the three written tables."""
    books = read_bronze(spark, layout.bronze("books"))
    reviews = read_bronze(spark, layout.bronze("reviews"))
    genres = read_bronze(spark, layout.bronze("genres"))

    # Contracts and the privacy check are plan-time: they fail before any write.
    stg = {
        "stg_reviews": governance.assert_no_columns(
            quality.enforce_contract(clean.silver_reviews(reviews), "stg_reviews"),
            ["user_id"], "silver"),
        "stg_genres": quality.enforce_contract(reshape.primary_category(genres), "stg_genres"),
        "stg_books": quality.enforce_contract(clean.silver_items(books, cfg, item_order),
                                              "stg_books"),
    }
    counts = _written(run_concurrently(
        {name: (lambda name=name, df=df: jsonl.write_counted(df, layout.silver(name)))
         for name, df in stg.items()}))

    metrics = enrich.review_metrics(spark.read.parquet(layout.silver("stg_reviews")))
    enriched = enrich.enrich_items(spark.read.parquet(layout.silver("stg_books")),
                                   spark.read.parquet(layout.silver("stg_genres")), metrics)
    counts["int_books_enriched"] = jsonl.write_counted(
        enriched, layout.silver("int_books_enriched"))
    return counts


def stage_marts(spark: SparkSession, layout: Layout, cfg: ScoringConfig = DEFAULT,
                enriched: DataFrame | None = None) -> dict[str, DataFrame]:
    """Both marts from the enriched table, written to the scratch folder and read back; Gold isn't touched."""
    if enriched is None:
        enriched = spark.read.parquet(layout.silver("int_books_enriched"))
    marts = {
        "mart_audiobook_candidates": governance.assert_no_columns(
            quality.enforce_contract(score.candidates(enriched, cfg), "mart_audiobook_candidates"),
            ["user_id", "user_id_hashed"], "gold"),
        "mart_genre_performance": quality.enforce_contract(report.genre_performance(enriched, cfg),
                                                           "mart_genre_performance"),
    }
    paths = {name: scratch_path(spark, "marts", name) for name in marts}
    _written(run_concurrently({name: (lambda name=name: marts[name].write.parquet(paths[name])) for name in marts}))
    return {name: spark.read.schema(marts[name].schema).parquet(paths[name]) for name in marts}


def publish(layout: Layout, marts: dict[str, DataFrame]) -> dict[str, int]:
    """The staged marts as new Gold versions, written side by side."""
    return _written(run_concurrently({name: (lambda name=name: governance.write_snapshot(marts[name], layout.gold(name)))
                                      for name in marts}))


def build_gold(spark: SparkSession, layout: Layout, cfg: ScoringConfig = DEFAULT) -> dict[str, int]:
    return publish(layout, stage_marts(spark, layout, cfg))


def model_tables(spark: SparkSession, layout: Layout) -> dict[str, DataFrame]:
    """Every tested model of Bronze and Silver, read from the written layers."""
    return {
        "bronze_books": read_bronze(spark, layout.bronze("books")),
        "bronze_reviews": read_bronze(spark, layout.bronze("reviews")),
        "bronze_genres": read_bronze(spark, layout.bronze("genres")),
        "stg_books": spark.read.parquet(layout.silver("stg_books")),
        "stg_reviews": spark.read.parquet(layout.silver("stg_reviews")),
        "stg_genres": spark.read.parquet(layout.silver("stg_genres")),
        "int_books_enriched": spark.read.parquet(layout.silver("int_books_enriched")),
    }


def run_all(spark: SparkSession, layout: Layout, cfg: ScoringConfig = DEFAULT,
            gate: bool = True, batch_id: str | None = None,
            tests: Sequence[quality.Test] | None = None) -> RunReport:
    """M6: ingest → Silver → tests → marts staged → tests → Gold published.

    With ``gate`` a failed ``error`` test, or one that could not run, raises before anything is published.
    """
    rep = RunReport()
    rep.bronze = ingest_bronze(spark, layout, batch_id=batch_id)
    failed = [r for r in rep.bronze if r.status == "error" and r.name in ("books", "reviews", "genres")]
    if failed:
        raise RuntimeError(f"bronze ingest failed: {[(r.name, r.error) for r in failed]}")
    rep.rejected = check_rejects(spark, layout, rep.bronze, gate)
    _refine(spark, layout, cfg, gate, tests, rep)
    return rep


def check_rejects(spark: SparkSession, layout: Layout, results: Sequence[IngestResult], gate: bool) -> list[dict]:
    """S2 in the gate: files of this run with too many rejected lines; only datasets whose load counted any are read.

    Reads the new epochs alone.  With ``gate`` such a file raises before Silver is touched.
    """
    if layout.max_rejected is None:
        return []
    bad = []
    for r in results:
        if r.corrupt:
            rows = read_bronze(spark, layout.bronze(r.name)).filter(F.col("_epoch").isin(r.batches))
            bad += [{"dataset": r.name, **f} for f in jsonl.reject_gate(rows, layout.max_rejected)]
    if bad and gate:
        raise quality.DataTestError("; ".join(
            f"{f['dataset']}: {f['rejected']} of {f['of_lines']} lines of {f['source_file']} rejected" for f in bad))
    return bad


def _refine(spark: SparkSession, layout: Layout, cfg: ScoringConfig, gate: bool,
            tests: Sequence[quality.Test] | None, rep: RunReport) -> None:
    """Bronze → Silver → tests → marts staged → tests → Gold published."""
    rep.counts = build_silver(spark, layout, cfg)
    _to_gold(spark, layout, cfg, gate, tests, rep, model_tables(spark, layout), None)


def _to_gold(spark: SparkSession, layout: Layout, cfg: ScoringConfig, gate: bool, tests: Sequence[quality.Test] | None,
             rep: RunReport, tables: dict[str, DataFrame], enriched: DataFrame | None) -> None:
    """Tests of Bronze and Silver → marts staged → their tests → Gold published."""
    suite = list(tests if tests is not None else quality.declared_tests())
    marts = [t for t in suite if t.model.startswith("mart_")]

    def check(tables: dict[str, DataFrame], part: list[quality.Test]) -> None:
        report_df = quality.run_tests(tables, part)
        rep.tests += quality.gate(report_df) if gate else [r.asDict() for r in report_df.collect()]

    check(tables, [t for t in suite if t not in marts])
    staged = stage_marts(spark, layout, cfg, enriched)
    check(staged, marts)
    rep.versions = publish(layout, staged)


def silver_states(spark: SparkSession, layout: Layout, cfg: ScoringConfig = DEFAULT):
    """The incremental Silver of a layout."""
    from .incremental import IncrementalSilver
    return IncrementalSilver(spark, f"{layout.root}/silver_state", cfg)


def run_incremental(spark: SparkSession, layout: Layout, cfg: ScoringConfig = DEFAULT, gate: bool = True,
                    batch_id: str | None = None, tests: Sequence[quality.Test] | None = None) -> RunReport:
    """M6 on what is new: ingest → Silver states take in the new epochs → tests → marts staged → tests → Gold published.

    Silver is kept by ``IncrementalSilver``, so a run reads the new Bronze epochs and the buckets that they touch.
    The result is that of ``run_all`` over everything ingested so far.
    """
    rep = RunReport()
    rep.bronze = ingest_bronze(spark, layout, batch_id=batch_id)
    failed = [r for r in rep.bronze if r.status == "error" and r.name in ("books", "reviews", "genres")]
    if failed:
        raise RuntimeError(f"bronze ingest failed: {[(r.name, r.error) for r in failed]}")
    rep.rejected = check_rejects(spark, layout, rep.bronze, gate)
    silver = silver_states(spark, layout, cfg)
    rep.counts = silver.refresh_from(layout.bronze)
    _to_gold(spark, layout, cfg, gate, tests, rep, _state_tables(spark, layout, silver), silver.enriched())
    return rep


def _state_tables(spark: SparkSession, layout: Layout, silver) -> dict[str, DataFrame]:
    return {**{f"bronze_{n}": read_bronze(spark, layout.bronze(n)) for n in ("books", "reviews", "genres")},
            "stg_books": silver.stg_books(), "stg_reviews": silver.stg_reviews(), "stg_genres": silver.stg_genres(),
            "int_books_enriched": silver.enriched()}


def rebuild_after_erasure(spark: SparkSession, layout: Layout, hashes: Sequence[str | None],
                          cfg: ScoringConfig = DEFAULT, gate: bool = True,
                          tests: Sequence[quality.Test] | None = None, incremental: bool = False) -> RunReport:
    """G2 + G3: the subjects leave Bronze, Silver and Gold for good.

    The hashes join the request table, which every later ingest applies, so a subject doesn't come back with
    a new file.  The Bronze files that hold them are rewritten in place (``streaming.erasure``); raw files aren't read, so
    rows whose landing files are gone stay.  Then Silver and Gold are rebuilt behind the same tests as in ``run_all``:
    with ``gate`` a failing suite raises and Gold stays as it was, while Bronze and Silver are already clean.
    With ``incremental`` Silver's states follow: only the erased epochs' reviews and the subjects' items are built anew.
    Raw files hold the subjects until the landing folder itself is cleaned.
    """
    governance.request_table(spark, hashes).write.mode("append").parquet(layout.requests)
    rep = RunReport(erased=erasure.erase(spark, _spec(spark, layout, "reviews"), hashes))
    if incremental:
        silver = silver_states(spark, layout, cfg)
        silver.forget(layout.bronze, rep.erased.epochs, hashes)
        _to_gold(spark, layout, cfg, gate, tests, rep, _state_tables(spark, layout, silver), silver.enriched())
        return rep
    _refine(spark, layout, cfg, gate, tests, rep)
    return rep
