"""Helpers shared by the training-data operators."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: A word of every contract: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole documents table."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def words(text: Column) -> Column:
    """Number of words of a text; null counts as 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def fold(col: str, held: int, parts: int) -> Column:
    """True where crc32 of the id as text leaves ``held`` modulo ``parts`` (null id: as empty text)."""
    key = F.coalesce(F.col(col).cast("string"), F.lit(""))
    return (F.crc32(F.encode(key, "UTF-8")) % parts) == held


class Scratch:
    """Intermediate tables of one operator run, in the folder that the cluster shares.

    Every table is written whole and read back, which cuts the lineage: a lost executor re-reads
    files.  ``drop`` removes tables that no returned DataFrame reads any more.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.base = spark, scratch_path(spark, "llm", label)

    def path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").option("compression", "zstd").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        jvm = self.spark._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(self.path(name))
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column as one array, and the n + 1 offsets of its rows (null: empty)."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0]:offsets[-1]], offsets - offsets[0]


def _word_bytes() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    table[9:14] = 32
    return table


#: A-Z in lower case, ASCII white space as blanks; bytes of other characters as they are.
WORD_BYTES = _word_bytes()


def split_words(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of all texts (A-Z lower-cased, cut at ASCII white space) and the text that each is in."""
    data, ends = text_buffer(column)
    plain = pa.LargeStringArray.from_buffers(len(ends) - 1, pa.py_buffer(ends.astype(np.int64)),
                                             pa.py_buffer(WORD_BYTES[data]))
    lists = pc.split_pattern(plain, " ")
    words, parent = lists.flatten(), pc.list_parent_indices(lists).to_numpy()
    some = pc.greater(pc.binary_length(words), 0)
    return words.filter(some), parent[some.to_numpy(zero_copy_only=False)]


def sliced(batches: Iterator[pa.RecordBatch], text: str, most: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` text bytes (a longer text comes alone).

    At the end of a task freed memory is given back: the worker lives on, beside the JVM that needs it next.
    """
    for batch in batches:
        column = batch.column(text).cast(pa.large_string())
        if not len(column):
            continue
        ends = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
        first = 0
        while first < len(column):
            last = max(first + 1, int(np.searchsorted(ends, ends[first] + most, "right")) - 1)
            yield batch.slice(first, last - first)
            first = last
    release_memory()


def release_memory() -> None:
    """Give unused memory of this process back to the system."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # C libraries without malloc_trim
        ctypes.CDLL(None).malloc_trim(0)


def names_free(df: DataFrame, *made: str) -> DataFrame:
    """``df`` without columns that an operator is about to make (its own results win a clash)."""
    taken = {m.lower() for m in made}
    return df.drop(*[c for c in df.columns if c.lower() in taken])
