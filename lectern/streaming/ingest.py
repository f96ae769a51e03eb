"""Exactly-once incremental ingest of JSON-lines folders.

One Structured Streaming query per dataset finds the files (of any suffix, compressed or not) that its checkpoint has
not seen, with ``trigger(availableNow=True)``; each micro-batch is an epoch.  An epoch's lines are rebalanced, parsed,
shaped (flatten / clean names, audit columns) and written as one folder, ``_epoch=N/_batch_id=B``.  A re-run of an
epoch after a crash overwrites its folder, so every file's rows are there once.  The first run reads every file
(the bootstrap); because it is the same query as the increments, the same flattening applies to every batch.

Rebalancing is one exchange between the text read and the parse: a file that can't be split (gzip) is parsed by as many
tasks as it has parts of ``file_bytes``, and many small or a few skewed files give Bronze files of an even size.

Schema: given by the caller, or inferred from the epoch's lines in one aggregate (the lines are persisted, so raw files
are read once) with the types that the Bronze table already has; hints override inferred types.  What the
schema misses (a field at any depth, or a value of another type) is kept in the VARIANT column ``_rescued``.

Counts come from ``observe`` on the write: every epoch leaves a load record (rows, corrupt, rescued and erased lines,
and the table's schema so far).  Totals are sums of load records and readers take the schema from them: neither counts
the table nor merges its footers.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalar as S
from ..operators import governance
from ..sources import jsonl


@dataclass
class IngestSpec:
    name: str
    source: str
    target: str
    checkpoint: str
    schema: T.StructType | str | None = None
    hints: str | None = None
    struct_col: str = "genres"
    key: str = "book_id"
    min_rows: int = jsonl.MIN_ROWS
    warn_below: int | None = None
    options: dict = field(default_factory=dict)   # extra JSON reader options
    sampling_ratio: float = 1.0                     # rows read to infer a schema
    exclude: str | None = None                      # file-name suffix left out (e.g. sample files)
    rescue: bool = True                             # keep what the schema misses in _rescued
    # Bytes of lines (as shuffled) that one task parses and one Bronze file holds; None: no exchange, a task per
    # split of a file (for landing folders of large splittable files).
    file_bytes: int | None = 32 << 20
    # Rows of one Bronze file at most; None: as many as its task has.
    file_rows: int | None = None
    # A file is new by its path, however old its time looks (the source forgets, and then ignores, older files).
    max_file_age: str = "36500d"
    # Table of erased subjects (``_erase_hash``) and the raw id column they are hashes of; ``subject_index`` keeps, per
    # epoch, which file holds which subject, so that an erasure finds its files without reading the table.
    erase_requests: str | None = None
    erase_col: str = "user_id"
    subject_index: bool = False
    # Scale knobs: bound each micro-batch of a large backlog (availableNow
    # splits it into several batches), and move processed files out of the
    # landing folder so each run lists only new ones ("archive" needs
    # archive_dir; "delete" removes them).  Off by default: files are left as is.
    max_files_per_trigger: int | None = None
    clean_source: str | None = None
    archive_dir: str | None = None
    # S10 fallback for heavy schema drift: land each line whole as one VARIANT
    # column (no inference, no flattening; read fields with try_variant_get).
    variant_column: str | None = None


@dataclass
class IngestResult:
    name: str
    rows_added: int = 0
    corrupt: int = 0
    rescued: int = 0
    erased: int = 0
    total_rows: int = 0
    status: str = "pass"
    error: str | None = None
    batches: list = field(default_factory=list)


def new_batch_id(now: dt.datetime | None = None) -> str:
    return (now or dt.datetime.now(dt.timezone.utc)).strftime("%Y%m%d_%H%M%S")


def _known_type(old: T.DataType, new: T.DataType) -> T.DataType:
    """Fields only ever get added, at any depth (structs, arrays of structs, maps); a known leaf keeps its type."""
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        incoming = {f.name: f for f in new.fields}
        kept = [T.StructField(f.name, _known_type(f.dataType, incoming.pop(f.name).dataType)
                              if f.name in incoming else f.dataType, True) for f in old.fields]
        return T.StructType(kept + [f for f in new.fields if f.name in incoming])
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return T.ArrayType(_known_type(old.elementType, new.elementType), True)
    if isinstance(old, T.MapType) and isinstance(new, T.MapType):
        return T.MapType(old.keyType, _known_type(old.valueType, new.valueType), True)
    return old


# --- load records and schema --------------------------------------------------------

LOADS = ("epoch BIGINT, batch_id STRING, rows BIGINT, corrupt BIGINT, rescued BIGINT, erased BIGINT, schema STRING, "
         "loaded_at TIMESTAMP")
#: Partition columns of a Bronze table.
PARTITIONS = T.StructType([T.StructField("_epoch", T.LongType()), T.StructField("_batch_id", T.StringType())])


def epoch_path(target: str, epoch: int) -> str:
    return f"{target.rstrip('/')}/_epoch={epoch}"


def _loads_path(target: str) -> str:
    return f"{target.rstrip('/')}/_loads"          # hidden from readers of the table


def load_records(spark: SparkSession, target: str) -> DataFrame:
    """One row per epoch of a Bronze table; empty for a new one."""
    fs, p = governance._fs(spark, _loads_path(target))
    if not fs.exists(p):
        return spark.createDataFrame([], LOADS)
    return spark.read.schema(LOADS).json(f"{_loads_path(target)}/*")


def record_load(spark: SparkSession, target: str, record: dict) -> None:
    """Write (or replace) an epoch's load record."""
    names = [f.name for f in jsonl.parse_ddl(spark, LOADS).fields]
    row = spark.createDataFrame([tuple(record[n] for n in names)], LOADS)
    row.coalesce(1).write.mode("overwrite").json(f"{_loads_path(target)}/{record['epoch']}")


def bronze_schema(spark: SparkSession, target: str) -> T.StructType | None:
    """Columns of the table across all epochs, without its partition columns; None for a new table."""
    row = load_records(spark, target).filter("schema IS NOT NULL").orderBy(F.desc("epoch")).select("schema").first()
    return T._parse_datatype_json_string(row["schema"]) if row else None


def read_bronze(spark: SparkSession, target: str) -> DataFrame:
    """Bronze table across epochs; columns that came later are NULL before.

    The schema is that of the load records.  A folder without any (bulk-loaded elsewhere) is read with its files' schemas merged.
    """
    schema = bronze_schema(spark, target)
    if schema is None:
        return spark.read.option("mergeSchema", "true").parquet(target)
    return spark.read.schema(T.StructType(schema.fields + PARTITIONS.fields)).parquet(target)


def _merged(old: T.StructType | None, new: T.StructType) -> T.StructType:
    """All columns so far: the old ones (with fields that are new inside them), then the new ones."""
    return _known_type(old, new) if old else T.StructType([T.StructField(f.name, f.dataType) for f in new.fields])


def _schema(spec: IngestSpec, lines: DataFrame, old: T.StructType | None) -> T.StructType:
    """Explicit schema, or one inferred from the lines with the types the Bronze table has."""
    if isinstance(spec.schema, T.StructType):
        return spec.schema
    if isinstance(spec.schema, str):
        return jsonl.parse_ddl(lines.sparkSession, spec.schema)
    inferred = jsonl.infer_schema(lines, None, spec.sampling_ratio)
    known = {f.name: f.dataType for f in old.fields} if old else {}

    def kept(name: str, dtype: T.DataType) -> T.DataType:
        return _known_type(known[name], dtype) if name in known else dtype

    fields = []
    for f in inferred.fields:
        dtype = kept(jsonl.clean_name(f.name), f.dataType)
        if f.name == spec.struct_col and isinstance(f.dataType, T.StructType):  # its fields are Bronze columns
            dtype = T.StructType([T.StructField(g.name, kept(
                "genre_" + jsonl.clean_name(g.name, strip_edges=True), g.dataType), True) for g in f.dataType.fields])
        fields.append(T.StructField(f.name, dtype, True))
    return jsonl.merge_hints(T.StructType(fields), spec.hints, lines.sparkSession)


# --- one epoch -----------------------------------------------------------------------

def stream_lines(spark: SparkSession, spec: IngestSpec) -> DataFrame:
    """The streaming source: lines of unseen files, each with its file."""
    reader = spark.readStream.option("maxFileAge", spec.max_file_age)
    if spec.max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(spec.max_files_per_trigger))
    if spec.clean_source:
        reader = reader.option("cleanSource", spec.clean_source)
        if spec.archive_dir:
            reader = reader.option("sourceArchiveDir", spec.archive_dir)
    lines = jsonl.keep_files(reader.text(spec.source), spec.exclude)
    return lines.select("value", F.col("_metadata.file_path").alias("_source_file"))


def shape_lines(spec: IngestSpec, lines: DataFrame, batch_id: str, old: T.StructType | None = None) -> DataFrame:
    """Lines → Bronze columns, audit columns included (the batch id is the folder's); erased subjects are marked.

    Lazy but for the inference.  ``_erased`` is there only if the spec has a request table.
    """
    if spec.variant_column:
        value = F.try_parse_json("value")
        shaped = lines.filter(F.trim("value") != "").select(
            value.alias(spec.variant_column), F.when(value.isNull(), F.col("value")).alias(jsonl.CORRUPT),
            F.xxhash64("value").alias(jsonl.ROW_HASH), "_source_file")
    else:
        schema = _schema(spec, lines, old)
        shaped = jsonl.shape_bronze(jsonl.parse_lines(lines, schema, spec.options, spec.rescue), spec.struct_col, spec.key)
    shaped = jsonl.add_audit_columns(shaped, batch_id).drop("_batch_id")
    if spec.erase_requests and spec.erase_col in shaped.columns:
        requests = governance.request_table(lines.sparkSession, lines.sparkSession.read.schema(
            "_erase_hash string").parquet(spec.erase_requests))
        shaped = (shaped.withColumn("_h", S.hash_id(spec.erase_col)).join(requests, F.col("_h") == F.col("_erase_hash"), "left")
                  .withColumn("_erased", F.col("_erase_hash").isNotNull()).drop("_h", "_erase_hash"))
    return shaped


def index_epoch(spark: SparkSession, target: str, epoch: int, schema: T.StructType, id_col: str) -> None:
    """Which file of an epoch holds which subject: hashes in order, so that a look-up skips row groups by their range."""
    rows = spark.read.schema(schema).parquet(f"{epoch_path(target, epoch)}/*")
    # Told apart by the id, which is shorter than its hash.
    pairs = rows.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col("_metadata.file_path").alias("file")).distinct()
    (pairs.select(S.hash_id("id").alias("subject"), "file").sortWithinPartitions("subject").write.mode("overwrite")
     .parquet(f"{target.rstrip('/')}/_subjects/epoch={epoch}"))


def _write_epoch(spec: IngestSpec, batch_id: str, done: list[dict]):
    def write(lines: DataFrame, epoch: int) -> None:
        spark = lines.sparkSession
        old = bronze_schema(spark, spec.target)
        infers = spec.schema is None and not spec.variant_column
        if infers:
            lines = lines.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            settled = _fixed(spec, lines, old)
            if spec.file_bytes:
                spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(spec.file_bytes))
            shaped = shape_lines(settled, lines.hint("rebalance") if spec.file_bytes else lines, batch_id, old)
            erased = F.col("_erased") if "_erased" in shaped.columns else F.lit(False)
            rescued = F.col(jsonl.RESCUED).isNotNull() if jsonl.RESCUED in shaped.columns else F.lit(False)
            obs = Observation(f"{spec.name}_{epoch}")
            counted = shaped.observe(
                obs, F.count_if(~erased).alias("rows"), F.count_if(erased).alias("erased"),
                F.count_if(~erased & F.col(jsonl.CORRUPT).isNotNull()).alias("corrupt"),
                F.count_if(~erased & rescued).alias("rescued"))
            rows = counted.filter(~erased).drop("_erased")
            path = epoch_path(spec.target, epoch)
            governance.remove(spark, path)                # what a failed attempt has left
            rows.write.option("maxRecordsPerFile", spec.file_rows or 0).parquet(f"{path}/_batch_id={batch_id}")
            if spec.subject_index and spec.erase_col in rows.columns:
                index_epoch(spark, spec.target, epoch, rows.schema, spec.erase_col)
            record = {"epoch": epoch, "batch_id": batch_id, **{k: int(v or 0) for k, v in obs.get.items()},
                      "schema": _merged(old, rows.schema).json(), "loaded_at": dt.datetime.now(dt.timezone.utc)}
            record_load(spark, spec.target, record)
            done.append(record)
        finally:
            if infers:
                lines.unpersist()
    return write


def _fixed(spec: IngestSpec, lines: DataFrame, old: T.StructType | None) -> IngestSpec:
    """The spec with its schema settled, so that the exchanged lines aren't what it is inferred from."""
    if spec.variant_column or isinstance(spec.schema, T.StructType):
        return spec
    return replace(spec, schema=_schema(spec, lines, old))


def _run(spark: SparkSession, spec: IngestSpec, each) -> None:
    q = (stream_lines(spark, spec).writeStream.foreachBatch(each).option("checkpointLocation", spec.checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def ingest_incremental(spark: SparkSession, spec: IngestSpec,
                       batch_id: str | None = None) -> IngestResult:
    """Process every unseen file once, append to the Bronze table, stop.

    ``rows_added`` counts rows that were written: neither blank lines nor those of erased subjects.
    """
    done: list[dict] = []
    _run(spark, spec, _write_epoch(spec, batch_id or new_batch_id(), done))
    return IngestResult(spec.name, batches=[r["epoch"] for r in done], rows_added=sum(r["rows"] for r in done),
                        **{k: sum(r[k] for r in done) for k in ("corrupt", "rescued", "erased")})


def mark_seen(spark: SparkSession, spec: IngestSpec) -> None:
    """Record every file now in the folder as processed, loading nothing.

    For adopting a folder whose current files were already bulk-loaded: later ``ingest_incremental`` runs load
    only files that arrive afterwards.  (``ingest_incremental`` itself never needs this: its first run is the bootstrap.)
    """
    _run(spark, spec, lambda lines, epoch: None)


def _ingest_one(spark: SparkSession, spec: IngestSpec, batch_id: str) -> IngestResult:
    res = ingest_incremental(spark, spec, batch_id)
    res.total_rows = load_records(spark, spec.target).agg(F.sum("rows").alias("n")).first()["n"] or 0
    res.status = jsonl.row_gate(res.total_rows, spec.name, spec.min_rows, spec.warn_below)["status"]
    return res


def run_plan(spark: SparkSession, specs: Sequence[IngestSpec],
             batch_id: str | None = None, parallel: int = 4) -> list[IngestResult]:
    """Ingest every dataset; a failure is recorded (0 rows) and the rest go on.

    Datasets are independent streams with their own checkpoints, so up to
    ``parallel`` of them run at once.
    """
    from ..session import run_concurrently
    batch_id = batch_id or new_batch_id()
    done = run_concurrently({s.name: (lambda s=s: _ingest_one(spark, s, batch_id)) for s in specs},
                            parallel)
    out = []
    for spec in specs:
        r = done[spec.name]
        if isinstance(r, Exception):
            r = IngestResult(spec.name, status="error", error=f"{type(r).__name__}: {r}")
        out.append(r)
    return out
