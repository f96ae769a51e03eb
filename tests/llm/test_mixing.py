from __future__ import annotations

import pytest
from lectern.llm import mixing
from lectern.llm.common import words
from pyspark.sql import functions as F

from .conftest import as_rows


def brute_targets(sizes):
    """Share by weight; cap; share the excess again, until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    capped, total = {}, sum(sizes.values())
    while True:
        rest = {s: w for s, w in weight.items() if s not in capped}
        left = total - sum(capped.values())
        target = {s: left * w / sum(rest.values()) for s, w in rest.items()}
        above = [s for s in target if target[s] > 3 * sizes[s] + 1e-9]
        if not above:
            return capped | target
        capped |= {s: 3.0 * sizes[s] for s in above}


def frame(spark, rng, n=400):
    rows = []
    for i in range(n):
        source = rng.choices([None, "a", "b", "z", "é", "😀", "tiny"], [2, 30, 10, 5, 5, 2, 1])[0]
        rows.append((i if i % 50 else None, " ".join(["w"] * rng.choice([0, 1, 3, 20, 400])), source))
    rows += [(5, None, "a"), (5, None, "a"), (6, "", "empty source")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string"), rows


def test_targets_sizes_and_limits(spark, rng):
    df, rows = frame(spark, rng)
    got = mixing.mix(df.withColumn("target", F.lit("clash")), words(F.col("text")))
    out = as_rows(got, "source", "source_size", "target", "copies", "taken", "text")
    assert len(out) == len(rows) and "target" in got.columns
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    target = brute_targets(sizes)
    for source, size, goal, copies, taken, text in out:
        assert size == sizes[source] and goal == pytest.approx(target[source])
        assert 0 <= copies <= 3 and taken == copies * len((text or "").split())
    for s in sizes:
        assert abs(sum(o[4] for o in out if o[0] == s) - target[s]) <= 200  # half of the longest document


def test_bins_give_the_cut_of_a_full_sort(spark, rng, monkeypatch):
    df, _ = frame(spark, rng)
    whole = sorted(as_rows(mixing.mix(df, words(F.col("text"))), "doc_id", "source", "copies", "taken"), key=repr)
    monkeypatch.setattr(mixing, "BINS", 2)  # nearly all rows are left to the window
    assert whole == sorted(as_rows(mixing.mix(df, words(F.col("text"))), "doc_id", "source", "copies", "taken"), key=repr)
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)  # the salted join
    assert whole == sorted(as_rows(mixing.mix(df, words(F.col("text"))), "doc_id", "source", "copies", "taken"), key=repr)


def test_reruns_agree_and_partitions_do_not_matter(spark, rng):
    df, _ = frame(spark, rng)
    runs = [sorted(as_rows(mixing.mix(d, words(F.col("text"))), "doc_id", "source", "copies"), key=repr)
            for d in (df, df.repartition(7), df.coalesce(1))]
    assert runs[0] == runs[1] == runs[2]


def test_unequal_probabilities_favour_weight(spark):
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.lit("a b").alias("text"),
                                  F.when(F.col("id") % 2 == 0, 3.0).otherwise(1.0).alias("quality"))
    got = mixing.mix(df, words(F.col("text")), weight_col="quality", share=0.5)
    by = {r[0]: r[1] for r in got.groupBy("quality").agg(F.sum("copies")).collect()}
    assert by[3.0] + by[1.0] == 2000 and by[3.0] / by[1.0] == pytest.approx(3, rel=0.2)


def test_empty_table_and_no_words(spark, rng):
    df, _ = frame(spark, rng)
    assert mixing.mix(df.limit(0), words(F.col("text"))).count() == 0
    nothing = mixing.mix(df.withColumn("text", F.lit(None).cast("string")), words(F.col("text")))
    assert nothing.agg(F.sum("taken")).first()[0] == 0
