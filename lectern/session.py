"""Session helpers: a builder for local runs and the shared scratch folder."""

from __future__ import annotations

import contextlib
import os
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "lectern") -> SparkSession:
    """Session for tests and the bench: AQE on, UI off, UTC clock."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("LECTERN_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only when unset.

    On a cluster ``spark.checkpoint.dir`` names a shared store (HDFS, object
    store) and is used as is.  A session without it gets a fresh folder under
    ``spark.sql.warehouse.dir``, which driver and executors share as well; a
    machine-local temp folder is never used.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir()
    if not current:
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        current = f"{warehouse}/_scratch/{uuid.uuid4().hex}"
        spark.conf.set("spark.checkpoint.dir", current)
        spark.sparkContext.setCheckpointDir(current)
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(current)
    return current


#: This process's part of the scratch folder.
RUN = uuid.uuid4().hex


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh folder name under the shared checkpoint folder, in this run's part of it."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([base, "lectern", RUN, *parts, uuid.uuid4().hex])


def clear_scratch(spark: SparkSession) -> None:
    """Delete everything this run has staged; call it when no DataFrame that reads it is needed any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{ensure_checkpoint_dir(spark).rstrip('/')}/lectern/{RUN}")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


#: For a run of many jobs: shuffle files go as soon as their job has ended, and tables are written as zstd.
LEAN = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.parquet.compression.codec": "zstd"}


@contextlib.contextmanager
def lean_disk(spark: SparkSession):
    """``LEAN`` while the block runs, also in streams that it starts; then the session's own settings again.

    Spark deletes shuffle files when the driver happens to collect its garbage; by then a run of many jobs holds those of all.
    """
    before = {k: spark.conf.get(k, None) for k in LEAN}
    for k, v in LEAN.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def materialize(df, label: str = "stage"):
    """Write ``df`` once as Parquet under the shared checkpoint folder and read it back.

    Cuts the lineage (a lost executor re-reads files instead of recomputing
    the upstream joins) and lets several consumers of one intermediate table
    scan it with column pruning instead of re-running its plan.  Not a
    ``localCheckpoint``: the files live on the cluster's shared storage.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "stage", label)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)   # schema known: no footer inference


def run_concurrently(tasks: dict, max_workers: int = 4) -> dict:
    """Run independent driver-side job launches in parallel threads.

    Spark schedules jobs submitted from several threads side by side, so
    small independent writes (one per dataset or table) overlap instead of
    queueing; each result is the return value or the raised exception.
    """
    from concurrent.futures import ThreadPoolExecutor
    out: dict = {}
    with ThreadPoolExecutor(max_workers=max(1, min(max_workers, len(tasks)))) as pool:
        futures = {name: pool.submit(fn) for name, fn in tasks.items()}
        for name, fut in futures.items():
            try:
                out[name] = fut.result()
            except Exception as e:  # noqa: BLE001 - handed back to the caller
                out[name] = e
    return out
