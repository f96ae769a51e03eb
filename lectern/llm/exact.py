"""Op 5. Exact deduplication with disk-backed streaming state (DataFrame functions only).

The rows stream through a stateful aggregation keyed by the digest of the text.  Its state has no
expiry and lives in RocksDB on the executors' disks, with its changes in the shared checkpoint folder; per digest it
retains the stable identifier and the content locator (file and row) of the row that stays, and the
number of rows.  The query ends when all files are read (``availableNow``); the state is then read
back as a table, the index.

A digest that is hit more than once is a claim, not a proof: the texts of all its rows are fetched by
their locators and compared byte for byte (the smallest and the largest text of the group must be the
same).  Groups that fail are split by the whole text.

Scale: state holds one small entry per distinct text; copies collapse map-side before the shuffle, so
a text that makes up a third of the rows sends one entry per task.  Texts move once, keyed by
locator, which is even whatever the copies are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, names_free

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: State store settings: RocksDB on disk, its memory bounded for all stores of an executor (MB); no disk
#: space is set aside ahead of use (4 MB a store otherwise), and a commit writes changes, not whole files.
STATE = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB,
         "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
         "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "128",
         "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
         "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true"}
RESULTS = ("keep_id", "group_size", "kept", "text_sha256")


def sha256(text: Column) -> Column:
    """32 bytes of SHA-256 over the UTF-8 text."""
    return F.unhex(F.sha2(F.encode(text, "UTF-8"), 256))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folder: str | None = None,
                columns: list[str] | None = None, digest: Callable[[Column], Column] = sha256,
                files_per_batch: int | None = None) -> DataFrame:
    """All rows with ``keep_id, group_size, kept, text_sha256`` (input columns of these names are replaced).

    Texts are equal when their bytes are; null counts as empty.  Of equal texts the row with the
    largest id stays (null ids come below all others; among repeated rows with one id exactly one
    stays, by its place in the files).  ``folder``: the Parquet files of ``docs``, if it is a plain
    table; other DataFrames are written to the shared folder first.  ``columns``: those to return
    (default all).  ``files_per_batch`` bounds a micro-batch (default: all files in one).  An empty
    table gives an empty result.
    """
    spark, work = docs.sparkSession, Scratch(docs.sparkSession, "exact")
    if folder is None:
        docs, folder = work.write(docs, "input"), work.path("input")
    if not docs.columns or docs.isEmpty():
        return names_free(docs, *RESULTS).selectExpr(
            *(columns or ["*"]), f"{id_col} AS keep_id", "0L AS group_size", "true AS kept", "'' AS text_sha256")
    index = _index(spark, docs.schema, folder, work, id_col, text_col, digest, files_per_batch)

    text = F.coalesce(F.col(text_col), F.lit(""))
    place = [F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__row")]
    rows = spark.read.schema(docs.schema).parquet(folder).select("*", *place)
    marks = rows.select("__file", "__row", digest(text).alias("__digest")).join(index, "__digest")
    marks = work.write(marks.select(
        "__file", "__row", "__digest", F.col("__keep.id").alias("__keep_id"), "__n",
        ((F.col("__keep.file") == F.col("__file")) & (F.col("__keep.row") == F.col("__row"))).alias("__stays")), "marks")

    # Bytes of all rows behind a digest that was hit again, fetched by locator.
    columns = columns or docs.columns
    free = names_free(docs.select(*columns), *RESULTS).columns
    sha = F.lower(F.hex(F.col("__digest"))) if digest is sha256 else F.sha2(F.encode(text, "UTF-8"), 256)
    # The bytes to compare: already in the row if the text is returned, else taken along for hits alone.
    has_text = text_col in free
    hit_text = F.lit(None).cast("string") if has_text else F.when(F.col("__n") > 1, text)
    marked = work.write(rows.join(marks, ["__file", "__row"]).select(
        F.struct(*[F.col(c) for c in free]).alias("__row_of"), F.col(id_col).alias("__id"), sha.alias("__sha"),
        hit_text.alias("__text"), "__file", "__row", "__digest", "__keep_id", "__n", "__stays"), "marked")
    if has_text:
        marked = marked.withColumn("__text", F.coalesce(F.col("__row_of").getField(text_col), F.lit("")))
    hits = marked.filter(F.col("__n") > 1)
    unlike = hits.groupBy("__digest").agg(F.min("__text").alias("a"), F.max("__text").alias("b"))
    unlike = work.write(unlike.filter(F.col("a") != F.col("b")).select("__digest"), "unlike")
    work.drop("input")

    # Digests that two texts share: split by the text itself.
    good = marked.join(unlike, "__digest", "left_anti")
    bad = hits.join(unlike, "__digest", "left_semi")
    whole = bad.groupBy("__digest", "__text").agg(
        F.max(F.struct(F.col("__id").alias("id"), F.col("__file").alias("file"), F.col("__row").alias("row"))).alias("k"),
        F.count(F.lit(1)).alias("m"))
    bad = bad.join(whole, ["__digest", "__text"]).withColumns({
        "__keep_id": F.col("k.id"), "__n": F.col("m"),
        "__stays": (F.col("k.file") == F.col("__file")) & (F.col("k.row") == F.col("__row"))})
    result = ["__row_of", "__keep_id", "__n", "__stays", "__sha"]
    out = good.select(*result).unionByName(bad.select(*result))
    return out.select("__row_of.*", F.col("__keep_id").alias("keep_id"), F.col("__n").alias("group_size"),
                      F.col("__stays").alias("kept"), F.col("__sha").alias("text_sha256"))


def _index(spark, schema, folder: str, work: Scratch, id_col: str, text_col: str, digest, per_batch) -> DataFrame:
    """``__digest, __keep (id, file, row), __n``: the keyed state after all files were streamed."""
    before = {k: spark.conf.get(k, None) for k in STATE}
    for k, v in STATE.items():
        spark.conf.set(k, v)
    try:
        reader = spark.readStream.schema(schema)
        if per_batch:
            reader = reader.option("maxFilesPerTrigger", per_batch)
        # As a pattern, so that a table of a single file can be streamed too.
        rows = reader.parquet(f"{folder[:-1]}[{folder[-1]}]")
        keep = F.struct(F.col(id_col).alias("id"), F.col("_metadata.file_path").alias("file"),
                        F.col("_metadata.row_index").alias("row"))
        state = (rows.select(digest(F.coalesce(F.col(text_col), F.lit(""))).alias("__digest"), keep.alias("keep"))
                 .groupBy("__digest").agg(F.max("keep").alias("keep"), F.count(F.lit(1)).alias("n")))
        query = (state.writeStream.format("noop").outputMode("update").trigger(availableNow=True)
                 .option("checkpointLocation", work.path("state")).start())
        query.awaitTermination()
        kept = spark.read.format("statestore").load(work.path("state"))
        return work.write(kept.select("key.__digest", F.col("value.max").alias("__keep"),
                                      F.col("value.count").alias("__n")), "index")
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
