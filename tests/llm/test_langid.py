from __future__ import annotations

import numpy as np
from lectern.llm import langid
from lectern.llm.common import documents, fold
from pyspark.sql import functions as F

from .conftest import as_rows

SF = "/root/testdata/sf0.01"


def slow_phrases(text, reference):
    n = i = 0
    while i < len(text):
        k = 1
        while text[i:i + 1] in reference and i + k < len(text) and text[i:i + k + 1] in reference:
            k += 1
        n, i = n + 1, i + k
    return n


def test_cross_parsing_equals_brute_force(rng, monkeypatch):
    monkeypatch.setattr(langid, "BLOCK", 37)
    for _ in range(60):
        reference = bytes(rng.choices(b"abc ", k=rng.randint(1, 80)))
        texts = [bytes(rng.choices(b"abcd ", k=rng.choice([0, 1, 20, 150]))) for _ in range(5)]
        classes = langid.byte_classes([np.frombuffer(reference, np.uint8)])
        parser = langid.SuffixAutomaton(classes[np.frombuffer(reference, np.uint8)].tobytes()).parser()
        ends = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        got = langid.phrases(classes[np.frombuffer(b"".join(texts), np.uint8)], ends, parser)
        blocks = lambda t: [t[i:i + 37] for i in range(0, len(t), 37)]
        assert got.tolist() == [sum(slow_phrases(b, reference) for b in blocks(t)) for t in texts]


def test_normalised_text():
    raw = "ÀÉ!!  Ab\n1c×ß".encode()
    data, ends = langid.normalised(np.frombuffer(raw + b"  ", np.uint8), np.array([0, len(raw), len(raw) + 2]))
    assert data.tobytes() == "àé ab c×ß ".encode() and ends.tolist() == [0, len(data) - 1, len(data)]


def test_held_out_accuracy(spark):
    docs = documents(spark, SF).withColumn("held_out", fold("doc_id", 2, 4))
    got = langid.identify(docs, ~F.col("held_out"))
    held = got.filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert held > 0.97
    assert got.filter("score < 0 or score > 1").count() == 0


def test_prediction_ignores_labels_of_held_out_rows(spark):
    docs = documents(spark, SF).withColumn("held_out", fold("doc_id", 2, 4))
    swapped = docs.withColumns({"lang": F.when(F.col("held_out"), "zz").otherwise(F.col("lang")), "source": F.lit("s")})
    a, b = (sorted(as_rows(langid.identify(d, ~F.col("held_out")), "doc_id", "lang_pred", "score")) for d in (docs, swapped))
    assert a == b


def test_edge_cases(spark):
    rows = [(1, "the cat sat on the mat " * 5, "en", "c"), (2, "le chat est sur le tapis " * 5, "fr", "c"),
            (None, "the cat", None, "c"), (3, None, "en", "c"), (4, "", "en", "c"), (5, "12 !!", "en", "c"), (6, "日本", None, "c"),
            (7, "le chat " * 20_000, None, "c"), (7, "le chat " * 20_000, None, "c"), (8, "é", None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    got = langid.identify(df, F.lit(True), keep_text=True)
    pred = {(r["doc_id"], r["lang_pred"]) for r in got.collect()}
    assert got.count() == len(rows) and {"text", "score"} <= set(got.columns)
    assert {(None, "en"), (3, "und"), (4, "und"), (5, "und"), (7, "fr")} <= pred and (6, "und") not in pred
    assert {r["score"] for r in got.filter("lang_pred = 'und'").collect()} == {0.0}
    untaught = langid.identify(df, F.lit(False))
    assert {r["lang_pred"] for r in untaught.collect()} == {"und"}
    assert langid.identify(df.limit(0), F.lit(True)).count() == 0


def test_rows_that_share_an_id_teach_alike(spark):
    """With one id for all rows, every language is learned, from different rows."""
    docs = documents(spark, SF).withColumn("doc_id", F.lit(7))
    found = dict(langid.references(docs))
    assert set(found) == {"de", "en", "es", "fr"}
    assert all(16_000 < len(ref) < 34_000 for ref in found.values())
    assert langid.identify(docs, F.lit(True)).filter("lang = lang_pred").count() > 970


def test_a_reference_has_equal_shares_of_whole_texts(spark):
    long = "".join(chr(97 + i // 2600 % 26) for i in range(67_600))         # a..z, 2,600 of each
    rows = [(i, f"{i} " + long, "xx") for i in range(100)] + [(200, "kurz ä", "yy"), (201, None, "zz"), (202, "12", "zz")]
    found = dict(langid.references(spark.createDataFrame(rows, "doc_id long, text string, lang string")))
    assert set(found) == {"xx", "yy"} and found["yy"] == "kurz ä\n".encode()
    parts = found["xx"].decode().strip().split("\n")
    assert len(parts) == langid.SAMPLE_ROWS and {len(p) for p in parts} == {515}
    assert all({"a", "z"} <= set(p) and len(set(p) - set(" 0123456789")) >= 4 for p in parts)


def test_the_most_frequent_labels_are_learned(spark, monkeypatch):
    monkeypatch.setattr(langid, "MOST_LANGUAGES", 2)
    rows = [(i, f"text {lang}", lang) for i, lang in enumerate(["a"] * 3 + ["b"] * 2 + ["c"] * 2 + ["d"])]
    assert [n for n, _ in langid.references(spark.createDataFrame(rows, "doc_id long, text string, lang string"))] == ["a", "b"]
