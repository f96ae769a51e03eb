from __future__ import annotations

from collections import Counter

import corpus_pipeline as C
from lectern.llm import mixing, queries
from lectern.llm.common import documents, words
from pyspark.sql import functions as F

from .conftest import prose
from .test_simhash import brute

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars", "extra"]


def write(spark, rng, path):
    body = [prose(rng, rng.choice([3, 60, 300])) for _ in range(60)]
    texts = body + rng.choices(body, k=20) + [None, "", "12 !!", " "]
    for t in body[:15]:
        w = t.split()
        w[len(w) // 2] = "other"
        texts.append(" ".join(w))
    rows = [(i, t, "en" if i % 2 else None, f"s{i % 3}" if i % 7 else None, len(t or ""), "x") for i, t in enumerate(texts)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, extra string"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{path}/documents.parquet")
    return rows


def test_stages_take_effect(spark, rng, tmp_path):
    rows = write(spark, rng, tmp_path)
    docs, kept = documents(spark, str(tmp_path)), {r[0]: r for r in rows}
    seen = []
    for k, (name, stage) in enumerate(C.STAGES):
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if k < 4:
            assert docs.columns == COLUMNS
        seen.append(docs)
    letters = {d for d, r in kept.items() if any(map(str.isalpha, r[1] or ""))}
    assert {r["doc_id"] for r in seen[0].collect()} == letters
    last = {}
    for d in sorted(letters):
        last[kept[d][1]] = d
    assert {r["doc_id"] for r in seen[1].collect()} == set(last.values())
    near = {c for *_, c in brute([(d, t) for t, d in last.items()])}
    assert {r["doc_id"] for r in seen[2].collect()} == near
    mix = mixing.mix(seen[2], words(F.col("text"))).collect()
    copies = Counter(r["doc_id"] for r in seen[3].collect())
    assert copies == Counter({r["doc_id"]: r["copies"] for r in mix if r["copies"]})
    pieces = Counter(r["doc_id"] for r in seen[4].filter("piece = 0").collect())
    assert pieces == copies
    ran = C.run(spark, str(tmp_path))
    assert sorted(r[:5] for r in ran.collect()) == sorted(r[:5] for r in seen[4].collect())


def test_all_queries_are_registered():
    numbers = sorted(int(k[2:].split("_")[0]) for k in queries.QUERIES)
    assert numbers == list(range(1, 14)) and set(queries.SQL) <= set(queries.QUERIES)
    assert [n for n, _ in C.STAGES] == ["language_id", "exact_dedup", "near_dedup", "mix_sources", "pack_sequences"]


def test_every_query_on_an_empty_table_and_on_null_rows(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for name, rows in (("empty", []), ("nulls", [(None, None, None, None, None)] * 2 + [(1, None, None, None, None)])):
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / name / "documents.parquet"))
        for key, query in {**queries.QUERIES, "pipeline": C.run}.items():
            got = query(spark, str(tmp_path / name)).count()
            assert got == (0 if key in ("pipeline", "op13_collocations") else len(rows)), (name, key)


def test_without_labels_every_document_with_a_letter_stays(spark):
    rows = [(1, "one text", None), (2, "日本", None), (3, "12 !", None), (4, None, None), (5, "", None), (1, "one text", None)]
    docs = spark.createDataFrame([(d, t, l, "s", 0) for d, t, l in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r["doc_id"] for r in C.language_id(spark, docs, "").collect()) == [1, 1, 2]
    labelled = docs.withColumn("lang", F.lit("en"))
    assert sorted(r["doc_id"] for r in C.language_id(spark, labelled, "").collect()) == [1, 1, 2]
