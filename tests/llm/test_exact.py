from __future__ import annotations

import hashlib

from lectern.llm import exact
from pyspark.sql import functions as F

from .conftest import as_rows, prose, table

OUT = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def brute(rows):
    groups = {}
    for d, t in rows:
        groups.setdefault(t or "", []).append(d)
    out = []
    for t, ids in groups.items():
        top = max(ids, key=lambda d: (d is not None, d or 0))
        left = 1
        for d in ids:
            stays = d == top and left
            left -= bool(stays)
            out.append((d, top, len(ids), bool(stays), hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=repr)


def sample(rng):
    texts = [None, "", " ", "a", "A", "é" * 3000, prose(rng, 20_000)] + [prose(rng, 5) for _ in range(20)]
    rows = [(i, rng.choice(texts)) for i in range(150)]
    return rows + [(None, "a"), (None, "a"), (None, "only null id"), (7, "twice"), (7, "twice")]


def test_equals_brute_force_with_nulls_repeats_and_clashes(spark, rng):
    rows = sample(rng)
    df = spark.createDataFrame([(d, t, "mine") for d, t in rows], "doc_id long, text string, kept string")
    assert sorted(as_rows(exact.exact_dedup(df), *OUT), key=repr) == brute(rows)


def test_colliding_digests_are_split_by_their_bytes(spark, rng):
    rows = sample(rng)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    weak = lambda text: F.unhex(F.lpad(F.hex(F.length(text) % 3), 2, "0"))
    assert sorted(as_rows(exact.exact_dedup(df, digest=weak), *OUT), key=repr) == brute(rows)


def test_small_batches_read_the_same_index(spark, rng, tmp_path):
    rows = sample(rng)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df.repartition(6).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    got = exact.exact_dedup(df, folder=str(tmp_path / "t"), files_per_batch=2)
    assert sorted(as_rows(got, *OUT), key=repr) == brute(rows)


def test_a_hot_text_and_an_empty_table(spark):
    df = spark.range(300).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(
        F.col("id").cast("string")).alias("text"))
    got = exact.exact_dedup(df).filter("group_size > 1").select("keep_id", "group_size", "kept")
    assert got.filter("kept").collect()[0][:2] == (297, 100) and got.count() == 100
    empty = exact.exact_dedup(table(spark, []))
    assert empty.count() == 0 and set(OUT) <= set(empty.columns)


def test_no_python_in_the_plan(spark):
    plan = exact.exact_dedup(table(spark, [(1, "a", None, None)]))._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow"))
