"""Privacy and compliance jobs on tables.

A table that is written whole each time keeps its loads as partitions, ``<root>/_loaded_at=<time>/_operation=<name>``.  The
time of a load is its version; the history is a grouped count over the partition columns (answered from footers), a
version is read from its own folder, and retention drops whole partitions.  The root should live on shared storage
(e.g. under ``spark.checkpoint.dir``).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalar as S

# Retention per layer in days (bronze 90, silver 30, gold 7).
RETENTION_DAYS = {"bronze": 90, "silver": 30, "gold": 7}
#: Lists of at most so many hashes (64 bytes each) are sent to every task, so that the table they apply to isn't shuffled.
BROADCAST = 10_000


# --- G1 / G2 ----------------------------------------------------------------

def request_table(spark: SparkSession, hashes: Sequence[str | None] | DataFrame) -> DataFrame:
    """``_erase_hash``: one lower-case hash per named subject.

    ``hashes`` is a list or a DataFrame with that column.  A NULL names nobody and is left out; hashes
    match whatever case they were written in.
    """
    if not isinstance(hashes, DataFrame):
        hashes = spark.createDataFrame([(h,) for h in hashes], "_erase_hash string")
    return (hashes.select(F.lower("_erase_hash").alias("_erase_hash"))
            .filter(F.col("_erase_hash").isNotNull()).distinct())


def _by_request(df: DataFrame, hashes, id_col: str, salt: str | None, how: str) -> DataFrame:
    req = request_table(df.sparkSession, hashes)
    if not isinstance(hashes, DataFrame) and len(hashes) <= BROADCAST:
        req = F.broadcast(req)
    return (df.withColumn("_h", S.hash_id(id_col, salt))
            .join(req, F.col("_h") == F.col("_erase_hash"), how).drop("_h"))


def subject_lookup(df: DataFrame, hashes: Sequence[str | None] | DataFrame, id_col: str = "user_id",
                   salt: str | None = None) -> DataFrame:
    """G1: rows of the given subjects, matched by the hash of the raw id."""
    return _by_request(df, hashes, id_col, salt, "left_semi")


def erase_subjects(df: DataFrame, hashes: Sequence[str | None] | DataFrame, id_col: str = "user_id",
                   salt: str | None = None) -> DataFrame:
    """Every row except the subjects' (rows with a NULL id are kept: they name nobody).

    One path for any number of requests: an anti join with the request table, which is broadcast when it is a short
    list (AQE would see that only after both sides were shuffled).
    """
    return _by_request(df, hashes, id_col, salt, "left_anti")


# --- F16 ------------------------------------------------------------------

def masked(df: DataFrame, col: str, masked_for: Column | bool, out: str | None = None) -> DataFrame:
    """Role-based view of ``col``: the tail mask where ``masked_for`` holds."""
    return df.withColumn(out or col, S.mask_tail(col, masked_for))


# --- G4 ---------------------------------------------------------------------

def assert_no_columns(df: DataFrame, forbidden: Sequence[str], layer: str) -> DataFrame:
    """Layer privacy: fail (at plan time) when a raw identifier reaches ``layer``."""
    leaked = [c for c in forbidden if c in df.columns]
    if leaked:
        raise ValueError(f"{layer} layer must not hold {leaked}")
    return df


# --- G5 ---------------------------------------------------------------------

def audit_log(events: DataFrame, prefix: str, since: str, *, prefix_on: str = "table", user: str = "user_id",
              time: str = "ts", action: str = "event_type", params: str = "props", schema: str = "k int",
              table: str = "k", extra: Sequence[str] = ("value",)) -> DataFrame:
    """Who did what after ``since``, newest first.

    ``params`` is the JSON text of a request with the given ``schema``; ``table`` is the (nested, dotted) field that
    names the table.  The prefix filters that name, or the action with ``prefix_on="action"``.
    """
    name = F.col(f"request_params.{table}")
    parsed = events.withColumn("request_params", F.from_json(params, schema))
    kept = F.col(action) if prefix_on == "action" else name.cast("string")
    return (parsed.filter(kept.startswith(prefix) & (F.col(time) > F.lit(since).cast("timestamp_ntz")))
            .select(F.col(user).alias("user"), F.col(time).alias("event_time"), F.col(action).alias("action_name"),
                    name.alias("table_accessed"), *extra)
            .orderBy(F.col("event_time").desc(), F.col("user").asc()))


# --- G6-G9: loads as partitions ---------------------------------------------

def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of this deployment, if it is there."""
    fs, p = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


_EPOCH = dt.datetime(1970, 1, 1)


def _utc(now: dt.datetime | None) -> dt.datetime:
    return now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def _version(time: dt.datetime) -> int:
    """A load's time in microseconds."""
    return (time - _EPOCH) // dt.timedelta(microseconds=1)


def _loads(spark: SparkSession, root: str) -> dict[int, str]:
    """Complete loads in order of time: version → folder."""
    fs, p = _fs(spark, root)
    found = {}
    for part in fs.listStatus(p) if fs.exists(p) else []:
        if part.getPath().getName().startswith("_loaded_at="):
            for load in fs.listStatus(part.getPath()):
                path = load.getPath().toString()
                if fs.exists(_fs(spark, f"{path}/_SUCCESS")[1]):
                    found[int(part.getPath().getName().removeprefix("_loaded_at="))] = path
    return dict(sorted(found.items()))


def latest_version(spark: SparkSession, root: str) -> int | None:
    """Newest complete load, None for a new table."""
    return max(_loads(spark, root), default=None)


def write_snapshot(df: DataFrame, root: str, operation: str = "WRITE", now: dt.datetime | None = None) -> int:
    """Write ``df`` as a load of its own; returns its version.

    A load is there once it is complete: readers pass over one that failed.
    """
    version = _version(_utc(now))
    df.write.mode("errorifexists").parquet(f"{root}/_loaded_at={version}/_operation={operation}")
    return version


def history(spark: SparkSession, root: str) -> DataFrame:
    """Version, time, operation and rows of every load that is there."""
    loads = _loads(spark, root)
    named = spark.createDataFrame([(v, _EPOCH + dt.timedelta(microseconds=v), p.rsplit("_operation=", 1)[1])
                                   for v, p in loads.items()], "version BIGINT, timestamp TIMESTAMP, operation STRING")
    if not loads:
        return named.withColumn("rows", F.lit(0).cast("bigint"))
    rows = spark.read.schema("_loaded_at BIGINT, _operation STRING").parquet(root)
    counts = rows.groupBy(F.col("_loaded_at").alias("version")).agg(F.count(F.lit(1)).alias("rows"))
    return named.join(counts, "version", "left").select(
        "version", "timestamp", "operation", F.coalesce("rows", F.lit(0).cast("bigint")).alias("rows"))


def read_version(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The table as of a version (latest by default), read from its own folder with its own columns.

    Raises for a version that was never written or that retention removed.
    """
    loads = _loads(spark, root)
    v = max(loads, default=None) if version is None else version
    if v not in loads:
        raise ValueError(f"no version {v} of {root}")
    return spark.read.parquet(loads[v])


def erase_and_commit(spark: SparkSession, root: str, hashes: Sequence[str],
                     id_col: str = "user_id") -> int:
    """G2 + G6: write the erased latest version as a load of its own.

    Older loads still hold the rows until ``vacuum`` drops them.
    """
    current = read_version(spark, root)
    return write_snapshot(erase_subjects(current, hashes, id_col), root, "DELETE")


def vacuum(spark: SparkSession, root: str, retain_days: int, now: dt.datetime | None = None) -> list[int]:
    """Drop the partitions of loads older than ``retain_days``, but for the newest load.  Returns their versions."""
    cutoff = _version(_utc(now) - dt.timedelta(days=retain_days))
    old = [v for v in list(_loads(spark, root))[:-1] if v < cutoff]
    for v in old:
        remove(spark, f"{root}/_loaded_at={v}")
    return old


def apply_retention(spark: SparkSession, tables: dict[str, tuple[str, str]],
                    now: dt.datetime | None = None) -> dict[str, list[int]]:
    """G9 per layer: ``{table: (layer, root)}`` → versions vacuumed, by each layer's days."""
    return {name: vacuum(spark, root, RETENTION_DAYS[layer], now)
            for name, (layer, root) in tables.items()}


# --- G10 ------------------------------------------------------------------

#: Aggregates that a share may hold.
SHARED_AGGREGATES = {"count": F.count, "count_distinct": F.count_distinct, "sum": F.sum, "avg": F.avg,
                     "min": F.min, "max": F.max}
IDENTIFIERS = ("user_id", "user_id_hashed", "review_id", "book_id", "review_text")


def share(df: DataFrame, group_cols: Sequence[str], aggregates: dict[str, tuple[str, str]],
          forbidden: Sequence[str] = IDENTIFIERS, min_rows: int = 1) -> DataFrame:
    """A governed share, built here: ``aggregates`` maps a result to (aggregate, column), per group.

    Row-level data can't pass: only ``SHARED_AGGREGATES`` are computed, identifiers may be counted but not grouped by
    or shown (min, max), and groups of fewer than ``min_rows`` rows are left out.
    """
    missing = [c for c in group_cols if c not in df.columns]
    if missing:
        raise ValueError(f"shared view lacks its grouping columns {missing}")
    shown = [*group_cols, *aggregates, *[c for f, c in aggregates.values() if f in ("min", "max", "sum", "avg")]]
    leaked = [c for c in shown if c in forbidden]
    unknown = [f for f, _ in aggregates.values() if f not in SHARED_AGGREGATES]
    if leaked or unknown or not group_cols:
        raise ValueError(f"not to be shared: {leaked or unknown or 'a table without groups'}")
    out = df.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("_rows"), *[
        SHARED_AGGREGATES[f](c).alias(name) for name, (f, c) in aggregates.items()])
    return out.filter(F.col("_rows") >= min_rows).drop("_rows")
