"""The ``events`` table landed as JSON-lines files and ingested incrementally.

Used by the ``ingest_incremental`` query: it exercises S8 end to end on data
derived from the driver's tables.  The whole table is written as two landing
batches (split by event type, no row left out), each followed by an
``availableNow`` run; a third run must add nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources import jsonl
from .ingest import IngestSpec, ingest_incremental, read_bronze

EVENT_SCHEMA = ("event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
                "value DOUBLE, props STRING")
FIRST_BATCH_TYPES = ("view", "click")
# Microsecond timestamps in the landed text (Spark's JSON default keeps milliseconds).
TS_OPTIONS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


COLUMNS = ("event_id", "ts", "user_id", "event_type", "value", "props")


def land_json(df: DataFrame, folder: str, compression: str = "none") -> None:
    """Append ``df`` to a landing folder as new JSON-lines files."""
    df.write.mode("append").options(**TS_OPTIONS).option("compression", compression).json(folder)


def _halves(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    first = F.coalesce(F.col("event_type").isin(*FIRST_BATCH_TYPES), F.lit(False))
    return events.filter(first), events.filter(~first)


def ingest_events(spark: SparkSession, events: DataFrame, compression: str = "none",
                  later_column: str | None = None) -> DataFrame:
    """Two landings of all events, an ingest after each, and a third run that must add nothing.

    ``later_column`` is left out of the first landing; then the schema is inferred at each run (with the type of the
    timestamp as a hint) instead of given, and the column has to appear with the second batch.
    """
    root = scratch_path(spark, "ingest_events")
    spec = IngestSpec("events", f"{root}/raw", f"{root}/bronze", f"{root}/_checkpoint",
                      schema=None if later_column else EVENT_SCHEMA, hints="ts TIMESTAMP_NTZ", key="event_id",
                      options=TS_OPTIONS)
    first, rest = _halves(events)
    land_json(first.drop(later_column) if later_column else first, spec.source, compression)
    ingest_incremental(spark, spec, "batch_1")
    land_json(rest, spec.source, compression)
    ingest_incremental(spark, spec, "batch_2")
    if added := ingest_incremental(spark, spec, "batch_3").rows_added:
        raise RuntimeError(f"re-run ingested {added} rows twice")
    return read_bronze(spark, spec.target).select(*COLUMNS)


#: What the schema of ``ingest_rescue`` knows: not ``detail.user``, not ``tags[].v``.
RESCUE_SCHEMA = "event_id BIGINT, detail STRUCT<k: INT>, tags ARRAY<STRUCT<n: INT>>"


def ingest_rescue(spark: SparkSession, events: DataFrame) -> DataFrame:
    """All events as nested lines of which the second landing has fields that the schema doesn't know.

    ``conforms`` (nothing was missed) and the missed values, read back from the rescue column.
    """
    root = scratch_path(spark, "ingest_rescue")
    spec = IngestSpec("events", f"{root}/raw", f"{root}/bronze", f"{root}/_checkpoint", schema=RESCUE_SCHEMA, key="event_id")
    k = F.get_json_object("props", "$.k").cast("int").alias("k")
    first, rest = _halves(events)
    land_json(first.select("event_id", F.struct(k).alias("detail"), F.array(F.struct(F.lit(1).alias("n"))).alias("tags")),
              spec.source)
    ingest_incremental(spark, spec, "batch_1")
    land_json(rest.select("event_id", F.struct(k, F.col("user_id").alias("user")).alias("detail"),
                          F.array(F.struct(F.lit(1).alias("n"), F.col("value").alias("v"))).alias("tags")), spec.source)
    ingest_incremental(spark, spec, "batch_2")
    field = lambda path, kind: F.try_variant_get(jsonl.RESCUED, path, kind)
    return read_bronze(spark, spec.target).select(
        "event_id", F.col("detail.k").alias("k"), F.col(jsonl.RESCUED).isNull().alias("conforms"),
        field("$.detail.user", "bigint").alias("rescued_user"), field("$.tags[0].v", "double").alias("rescued_value"))


def rejected_lines(spark: SparkSession, events: DataFrame) -> DataFrame:
    """All events as lines of which some are cut off, have text for a number or a field too many: counts per landing and reason."""
    root = scratch_path(spark, "rejected_lines")
    spec = IngestSpec("events", f"{root}/raw", f"{root}/bronze", f"{root}/_checkpoint", key="event_id",
                      schema="event_id BIGINT, event_type STRING, value DOUBLE")
    kind = F.col("event_id") % 20
    line = lambda value, *more: F.to_json(F.struct("event_id", "event_type", value.alias("value"), *more))
    plain = line(F.col("value"))
    lines = (F.when(kind == 3, F.expr("left(plain, length(plain) - 1)"))
             .when(kind == 7, line(F.lit("n/a")))
             .when(kind == 11, line(F.col("value"), F.struct(F.col("user_id").alias("user")).alias("detail")))
             .otherwise(F.col("plain")))
    for part, batch in zip(_halves(events.withColumn("plain", plain)), ("batch_1", "batch_2")):
        part.select(lines.alias("value")).write.mode("append").text(spec.source)
        ingest_incremental(spark, spec, batch)
    found = jsonl.rejects_by_reason(read_bronze(spark, spec.target), "_batch_id")
    return found.select(F.col("source_file").alias("batch"), "reason", "lines", "of_lines")
