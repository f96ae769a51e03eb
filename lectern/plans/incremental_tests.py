"""The declared data tests kept up to date batch by batch (Q1-Q4).

What a test has counted so far is mergeable, so a batch is tested once and never again:

* ``not_null`` and ``accepted_values`` of append-only models: failures per epoch;
* ``unique`` of append-only models: a count per value, in buckets; failures per bucket, of which a batch changes the touched;
* all tests of keyed models (``IncrementalSilver`` replaces buckets of them): failures per bucket;
* ``relationships``: children counted per key, in the buckets of the parents; failures per bucket, for buckets in which a child
  or a parent came or went.

The report adds these up.  It equals ``quality.run_tests`` over the whole tables.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import governance, quality
from ..operators.quality import Test
from ..session import materialize
from .incremental import BucketState, IncrementalSilver

APPENDED = ("bronze_books", "bronze_reviews", "bronze_genres", "stg_reviews")
KEYED = ("stg_books", "stg_genres", "int_books_enriched")


def merge_counts(rows: DataFrame) -> DataFrame:
    """``value, n`` summed; a new count of an epoch that a value's sum already holds counts nothing."""
    known = rows.groupBy("value").agg(F.max(F.when(~F.col("_new"), F.col("_upto"))).alias("_known"))
    fresh = rows.join(known, "value").filter(~F.col("_new") | F.col("_known").isNull() | (F.col("_upto") > F.col("_known")))
    return fresh.groupBy("value").agg(F.sum("n").alias("n"), F.max("_upto").alias("_upto")).withColumn("_new", F.lit(False))


class IncrementalTests:
    """Tests of the Bronze and Silver models of an incremental Silver; tests of other models aren't taken."""

    def __init__(self, silver: IncrementalSilver, tests: Sequence[Test] | None = None):
        self.silver, self.spark, self.root = silver, silver.spark, f"{silver.root}/_tests"
        asked = list(tests if tests is not None else quality.declared_tests())
        self.tests = [t for t in asked if t.model in (*APPENDED, *KEYED)]
        keyed = [t for t in self.tests if t.model in KEYED and t.kind == "unique" and t.column != silver.items.key]
        if keyed:
            raise ValueError(f"not unique within a bucket: {[t.name for t in keyed]}")

    def _of(self, model: str, *kinds: str) -> list[Test]:
        return [t for t in self.tests if t.model == model and t.kind in kinds]

    def _state(self, test: Test, what: str) -> BucketState:
        return BucketState(self.spark, f"{self.root}/{what}/{test.name}", "value", self.silver.items.buckets)

    def _failures(self, of: str) -> BucketState:
        """Failures per bucket (``test, failures``) of a test, or of all tests of a keyed model."""
        return BucketState(self.spark, f"{self.root}/failures/{of}", "test", self.silver.items.buckets)

    def _put(self, test: Test, per_bucket: DataFrame, touched: Iterable[int]) -> None:
        """Failures of the touched buckets (``_bucket, failures``); the others keep theirs."""
        self._failures(test.name).replace(per_bucket.select(
            "_bucket", F.lit(test.name).alias("test"), F.col("failures").cast("long").alias("failures")), touched)

    def update(self, new: dict[str, DataFrame], touched: set[int], epoch: int) -> None:
        """Test the new rows of append-only models and the touched buckets of the keyed ones.

        Call it after ``IncrementalSilver.refresh`` of the same epoch, with its result.  An epoch may come again.
        """
        new = {m: df for m, df in new.items() if m in APPENDED}
        for model, df in new.items():
            if counted := self._of(model, "not_null", "accepted_values"):
                quality._counted(model, df, counted).write.mode("overwrite").parquet(
                    f"{self.root}/counts/_model={model}/_epoch={epoch}")
            for t in self._of(model, "unique"):
                buckets = self._count(t, df, epoch)
                if buckets:
                    state = self._state(t, "values").read(buckets)
                    self._put(t, state.filter("n > 1").groupBy("_bucket").agg(F.count(F.lit(1)).alias("failures")), buckets)
        for t in [t for t in self.tests if t.kind == "relationships" and t.model in APPENDED]:
            changed = set(touched) | (self._count(t, new[t.model], epoch) if t.model in new else set())
            self._orphans(t, changed)
        for model in KEYED:
            self._keyed(model, touched)

    def _count(self, test: Test, df: DataFrame, epoch: int) -> set[int]:
        values = df.filter(F.col(test.column).isNotNull()).groupBy(F.col(test.column).cast("string").alias("value")).agg(
            F.count(F.lit(1)).alias("n")).withColumn("_upto", F.lit(epoch).cast("long")).withColumn("_new", F.lit(True))
        return self._state(test, "values").merge(materialize(values, "values"), merge_counts)

    def _orphans(self, test: Test, buckets: set[int]) -> None:
        children = self._state(test, "values").read(buckets) if buckets else None
        if children is None:
            return
        parents = self._model(test.to_model, buckets)
        parents = self.spark.createDataFrame([], "p string") if parents is None else parents.select(
            F.col(test.to_column).cast("string").alias("p"))
        orphans = children.join(parents, F.col("value") == F.col("p"), "left_anti")
        self._put(test, orphans.groupBy("_bucket").agg(F.sum("n").alias("failures")), buckets)

    def _model(self, model: str, buckets: set[int]) -> DataFrame | None:
        """Rows of a keyed model in some buckets, with ``_bucket``."""
        silver = self.silver
        state = {"stg_books": silver.items, "stg_genres": silver.genres, "int_books_enriched": silver.rows}[model].read(buckets)
        if state is None or model == "int_books_enriched":
            return state
        if model == "stg_genres":
            from .incremental import genres_of
            rows = genres_of(state)
        else:
            rows = silver._valid(state)
        return rows.withColumn("_bucket", silver.items.bucket_of("book_id"))

    def _keyed(self, model: str, buckets: set[int]) -> None:
        rows = self._model(model, buckets) if buckets else None
        if rows is None:
            return
        parts = []
        if counted := self._of(model, "not_null", "accepted_values"):
            wide = rows.groupBy("_bucket").agg(*[F.count_if(
                F.col(t.column).isNull() if t.kind == "not_null" else F.col(t.column).isNotNull() & ~F.col(t.column).isin(*t.values))
                .alias(t.name) for t in counted])
            parts.append(wide.unpivot("_bucket", [t.name for t in counted], "test", "failures"))
        for t in self._of(model, "unique"):
            repeated = rows.filter(F.col(t.column).isNotNull()).groupBy("_bucket", t.column).count().filter("count > 1")
            parts.append(repeated.groupBy("_bucket").agg(F.count(F.lit(1)).alias("failures")).withColumn("test", F.lit(t.name)))
        if parts:
            found = functools.reduce(DataFrame.unionByName, parts)
            self._failures(model).replace(found.filter("failures > 0").select("_bucket", "test", "failures"), buckets)

    def report(self) -> DataFrame:
        """One row per test with its failures so far; the columns of ``quality.run_tests``."""
        rows = []
        for t in self.tests:
            if t.model in APPENDED and t.kind in ("not_null", "accepted_values"):
                path = f"{self.root}/counts/_model={t.model}"
                fs, p = governance._fs(self.spark, path)
                found = self.spark.read.parquet(path) if fs.exists(p) else None
            else:
                found = self._failures(t.model if t.model in KEYED else t.name).read()
            rows.append((t, 0 if found is None else found.filter(F.col("test") == t.name).agg(
                F.sum("failures").alias("n")).first()["n"] or 0))
        table = self.spark.createDataFrame([(t.name, t.kind, t.model, t.column, t.severity, n) for t, n in rows],
                                           quality.REPORT_SCHEMA)
        return quality.with_status(table)
