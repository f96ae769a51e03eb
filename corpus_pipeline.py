"""A training corpus from ``documents``: five stages, each one operator of ``lectern.llm``.

A stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet and read back as
the next one's ``docs``.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm import exact, langid, mixing, packing, simhash
from lectern.llm.common import Scratch, documents, words


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; those without a letter (or text) go.

    Where no row has a label, nothing can be learned and every text is ``und``: then documents with a letter stay.
    Repeated rows and shared ids are judged each by its text; an empty table stays empty.
    """
    found = langid.identify(docs, F.lit(True), keep_text=True)
    return found.filter((F.col("lang_pred") != "und") | langid.lettered("text")).select(*docs.columns)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of identical texts (the one with the largest id; a null id is the smallest).

    Null and empty texts are one group; of rows that share id and text one stays.
    """
    return exact.exact_dedup(docs).filter("kept").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that SimHash links (3-word shingles, at most 3 bits apart): the smallest id.

    Groups are told apart by fingerprints, so ids that are null or shared by groups cost no document.  Texts without words
    are one group.
    """
    return simhash.drop_near_duplicates(docs, shingle=3, radius=3).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a document is there as often as it is taken (up to 3 times, or not at all).

    A null source is a source of its own; a null text has no words and isn't taken for a target; rows that share an id
    share its draw and are told apart by size.
    """
    mixed = mixing.mix(docs, words(F.col("text"))).filter(F.col("copies") > 0)
    return mixed.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens, one row per piece of a document.

    A document that is there more than once is packed as often; a null or empty text is one piece, its end id; a text
    over 2048 tokens is cut, however long it is.
    """
    return packing.pack(docs.select("doc_id", "text"), capacity=2048)


STAGES = [("language_id", language_id), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup),
          ("mix_sources", mix_sources), ("pack_sequences", pack_sequences)]

#: Packing and the SimHash components have no SQL form; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    work, docs = Scratch(spark, "pipeline"), documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = work.write(docs, name)
            if k:
                work.drop(STAGES[k - 1][0])
    return docs
