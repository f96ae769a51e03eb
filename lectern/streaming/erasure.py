"""Lasting erasure of subjects from a Bronze table.

The table is never read from its raw files again (landing may have been cleaned since), and only the files that hold a
subject are touched.  The subject index, written with every epoch, says which those are.  They are rewritten without
the subjects' rows into a hidden folder of the table, one file for each, and then each takes its original's place by
one rename that overwrites (atomic on HDFS and local file systems; an object store copies): a reader sees a file with or
without the subjects, never none and never both.  A file that holds nothing else is deleted.

Every step can be repeated: an attempt that was cut off leaves whole files, some of them already clean, and the
request table, from which the next attempt starts.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import governance
from . import ingest

#: Requests of at most so many hashes are pushed down to the index's row groups as a list.
PUSHED = 200
#: Files that are rewritten by one job, which shuffles their rows and keeps both copies of them until it ends.
FILES_PER_JOB = 100


@dataclass
class Erased:
    files: list[str] = field(default_factory=list)      # rewritten
    deleted: list[str] = field(default_factory=list)    # held nothing else
    rows: int = 0
    epochs: list[int] = field(default_factory=list)


def affected_files(spark: SparkSession, target: str, hashes: Sequence[str | None] | DataFrame) -> DataFrame:
    """``epoch, file`` of the files that hold one of the subjects, by the index alone."""
    path = f"{target.rstrip('/')}/_subjects"
    fs, p = governance._fs(spark, path)
    if not fs.exists(p):
        return spark.createDataFrame([], "epoch BIGINT, file STRING")
    index = spark.read.schema("subject STRING, file STRING, epoch BIGINT").parquet(path)
    requests = governance.request_table(spark, hashes)
    if not isinstance(hashes, DataFrame) and len(hashes) <= PUSHED:
        found = index.filter(F.col("subject").isin([h.lower() for h in hashes if h is not None]))
    else:
        found = index.join(requests, F.col("subject") == F.col("_erase_hash"), "left_semi")
    return found.select("epoch", "file").distinct()


def _replace(spark: SparkSession, source: str, target: str) -> None:
    """Put a file in the place of another in one step."""
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    old, new = jvm.org.apache.hadoop.fs.Path(target), jvm.org.apache.hadoop.fs.Path(source)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        old.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    how = gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    how[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(new, old, how)


def _staged(spark: SparkSession, folder: str) -> dict[str, str]:
    """Original's name → the file that replaces it."""
    found = {}
    fs, p = governance._fs(spark, folder)
    for part in fs.listStatus(p):
        name = part.getPath().getName()
        if name.startswith("__file="):
            files = [f.getPath().toString() for f in fs.listStatus(part.getPath()) if f.getPath().getName().startswith("part-")]
            if len(files) != 1:
                raise RuntimeError(f"{name} was rewritten as {len(files)} files")
            found[name.removeprefix("__file=")] = files[0]
    return found


def erase(spark: SparkSession, spec: ingest.IngestSpec, hashes: Sequence[str | None] | DataFrame) -> Erased:
    """Take the subjects out of the table's files.  Rows without an id stay; a NULL request names nobody.

    The driver gets the paths of affected files (never rows), in jobs of ``FILES_PER_JOB``.  Load records and the
    subject index of the affected epochs follow.
    """
    target = spec.target.rstrip("/")
    found = affected_files(spark, target, hashes).orderBy("epoch", "file").collect()
    done = Erased(epochs=sorted({r["epoch"] for r in found}))
    schema = ingest.bronze_schema(spark, target)
    removed: dict[int, int] = {}
    epoch_of = {r["file"].rsplit("/", 1)[1]: r["epoch"] for r in found}
    for first in range(0, len(found), FILES_PER_JOB):
        part = {r["file"].rsplit("/", 1)[1]: r["file"] for r in found[first:first + FILES_PER_JOB]}
        rows = spark.read.schema(schema).parquet(*part.values()).withColumn("__file", F.col("_metadata.file_name"))
        gone = governance.subject_lookup(rows.select(spec.erase_col, "__file"), hashes, spec.erase_col)
        for r in gone.groupBy("__file").count().collect():
            removed[epoch_of[r["__file"]]] = removed.get(epoch_of[r["__file"]], 0) + r["count"]
        folder = f"{target}/_erasing/{uuid.uuid4().hex}"
        kept = governance.erase_subjects(rows, hashes, spec.erase_col)
        # One task writes one original's rows; several originals may share a task.
        (kept.repartition(max(1, len(part)), "__file").sortWithinPartitions("__file")
         .write.option("maxRecordsPerFile", 0).partitionBy("__file").parquet(folder))
        staged = _staged(spark, folder)
        for name, path in part.items():
            if name in staged:
                _replace(spark, staged[name], path)
                done.files.append(path)
            else:
                governance.remove(spark, path)
                done.deleted.append(path)
        governance.remove(spark, folder)
    done.rows = sum(removed.values())
    records = {r["epoch"]: r.asDict() for r in ingest.load_records(spark, target).filter(
        F.col("epoch").isin(done.epochs)).collect()} if done.epochs else {}
    for epoch in done.epochs:
        spark.catalog.refreshByPath(ingest.epoch_path(target, epoch))
        ingest.index_epoch(spark, target, epoch, schema, spec.erase_col)
        if epoch in records and removed.get(epoch):
            record = records[epoch]
            record["rows"] -= removed[epoch]
            record["erased"] += removed[epoch]
            ingest.record_load(spark, target, record)
    return done
