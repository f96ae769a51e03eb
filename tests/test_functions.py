"""Scalar column functions (F1-F19, P1-P3): semantics and ANSI safety."""

from __future__ import annotations

from pathlib import Path

import hashlib
import math

import pytest
from pyspark.sql import functions as F

from lectern.config import DEFAULT, LEGACY3
from lectern.functions import scalar as S


def one(spark, expr, schema, rows):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_clean_numeric_bad_text_is_null(spark):
    out = one(spark, S.clean_numeric("v", "int"), "v string", [("12",), ("",), ("abc",), (None,)])
    assert out == [12, None, None, None]
    out = one(spark, S.clean_numeric("v", "double"), "v string", [("4.25",), ("x",)])
    assert out == [4.25, None]


def test_first_field_empty_and_null_arrays(spark):
    rows = [([{"author_id": "a"}, {"author_id": "b"}],), ([],), (None,)]
    out = one(spark, S.first_field("a", "author_id"), "a array<struct<author_id:string>>", rows)
    assert out == ["a", None, None]


@pytest.mark.parametrize("count,flag", [(9_999, "low_confidence"), (10_000, "medium_confidence"),
                                        (99_999, "medium_confidence"), (100_000, "high_confidence"),
                                        (None, "low_confidence")])
def test_quality_flag_thresholds(spark, count, flag):
    assert one(spark, S.quality_flag("c"), "c bigint", [(count,)]) == [flag]


def test_hash_id_matches_sha256(spark):
    out = one(spark, S.hash_id("u"), "u bigint", [(42,)])
    assert out == [hashlib.sha256(b"42").hexdigest()]
    salted = one(spark, S.hash_id("u", "pepper"), "u string", [("42",)])
    assert salted == [hashlib.sha256(b"pepper42").hexdigest()]


@pytest.mark.parametrize("rating,label", [(5, "positive"), (4, "positive"), (3, "neutral"),
                                          (2, "negative"), (1, "negative"), (0, "negative")])
def test_classify_rating(spark, rating, label):
    assert one(spark, S.classify_rating("r"), "r int", [(rating,)]) == [label]


def test_parse_date_bad_text_is_null(spark):
    rows = [("2017-01-02",), ("not a date",), ("n/a",), (None,)]
    out = one(spark, S.parse_date("d"), "d string", rows)
    assert [str(x) if x else None for x in out] == ["2017-01-02", None, None, None]
    assert one(spark, S.year_of(S.parse_date("d")), "d string", [("2017-01-02",)]) == [2017]


@pytest.mark.parametrize("pages,score,label", [
    (None, 0.5, "unknown"), (0, 0.2, "very_long"), (99, 0.2, "very_long"),
    (100, 0.6, "short"), (199, 0.6, "short"), (200, 1.0, "ideal"), (400, 1.0, "ideal"),
    (401, 0.8, "good"), (600, 0.8, "good"), (601, 0.4, "long"), (800, 0.4, "long"),
    (801, 0.2, "very_long")])
def test_length_bands_overlap_first_match(spark, pages, score, label):
    df = spark.createDataFrame([(pages,)], "p int")
    r = df.select(S.length_score("p").alias("s"), S.length_category("p").alias("c")).first()
    assert (r.s, r.c) == (score, label)


@pytest.mark.parametrize("pct,total,rating,expected", [
    (75.0, 4, 2.0, 0.75),          # real reviews win
    (0.0, 0, 4.0, 1.0),            # no reviews: proxy
    (0.0, 0, 3.0, 0.5),
    (0.0, 0, 2.9, 0.0),            # the 0.0 branch (absent from the oracle data)
    (None, None, 3.5, 0.5)])
def test_sentiment_score(spark, pct, total, rating, expected):
    df = spark.createDataFrame([(pct, total, rating)], "p double, t bigint, r double")
    assert df.select(S.sentiment_score("p", "t", "r")).first()[0] == expected


def test_sentiment_legacy_ignores_reviews(spark):
    df = spark.createDataFrame([(10.0, 5, 4.5)], "p double, t bigint, r double")
    assert df.select(S.sentiment_score("p", "t", "r", LEGACY3)).first()[0] == 1.0


def test_popularity_formula(spark):
    out = one(spark, S.popularity("n"), "n bigint", [(4_700_000,), (0,)])
    assert out[0] == pytest.approx(math.log(4_700_001) / math.log(5_000_001))
    assert out[1] == 0.0


def test_weighted_score_hand_computed(spark):
    # rating 4.45, 4.7M ratings, 80% positive, 320 pages
    df = spark.createDataFrame([(4.45, 4_700_000, 0.8, 1.0)], "r double, n bigint, s double, l double")
    got = df.select(S.weighted_score("r", "n", "s", "l", DEFAULT)).first()[0]
    want = round(4.45 / 5 * .35 + math.log(4_700_001) / math.log(5_000_001) * .25
                 + .8 * .25 + 1.0 * .15, 4)
    assert got == want


def test_round_half_up_on_decimal_text(spark):
    # 61.54 / 100 * 0.25 is stored just below 0.15385; Spark rounds the text.
    df = spark.createDataFrame([(61.54,)], "p double")
    assert df.select(F.round(F.col("p") / 100.0 * 0.25, 4)).first()[0] == 0.1539


def test_mask_tail_by_role(spark):
    df = spark.createDataFrame([("123-45-6789",)], "t string")
    assert df.select(S.mask_tail("t", True)).first()[0] == "***-**-6789"
    assert df.select(S.mask_tail("t", False)).first()[0] == "123-45-6789"
    role = F.lit("data_analysts") == "data_analysts"
    assert df.select(S.mask_tail("t", role)).first()[0] == "***-**-6789"


def test_thousands(spark):
    assert one(spark, S.thousands("n"), "n bigint", [(4_700_000,), (999,)]) == ["4,700,000", "999"]


def test_annotator_extraction(spark):
    rows = [(["pos", "neg"], {"confidence": "0.9"}), ([], {}), (None, None)]
    df = spark.createDataFrame(rows, "r array<string>, m map<string,string>")
    out = df.select(S.first_result("r"), S.map_value("m", "confidence")).collect()
    assert [tuple(x) for x in out] == [("pos", "0.9"), (None, None), (None, None)]


def test_strip_prefix(spark):
    assert one(spark, S.strip_prefix("g", "genre_"), "g string",
               [("genre_fiction",), ("fiction_genre_x",)]) == ["fiction", "fiction_genre_x"]


def test_scratch_falls_back_to_the_warehouse_and_is_cleared(spark, tmp_path):
    """Without spark.checkpoint.dir the scratch folder is in the warehouse, never in a machine's temp folder."""
    from types import SimpleNamespace

    from lectern import session

    class Conf(dict):
        def set(self, k, v):
            self[k] = v

    made = []
    context = SimpleNamespace(getCheckpointDir=lambda: None, setCheckpointDir=made.append)
    bare = SimpleNamespace(conf=Conf({"spark.sql.warehouse.dir": "hdfs://shared/warehouse"}), sparkContext=context)
    first = session.scratch_path(bare, "x")
    assert first.startswith("hdfs://shared/warehouse/_scratch/") and made == [bare.conf["spark.checkpoint.dir"]]
    assert session.scratch_path(bare, "x").startswith(made[0]) and session.scratch_path(bare, "x") != first
    given = SimpleNamespace(conf=Conf({"spark.checkpoint.dir": "hdfs://own"}), sparkContext=context)
    assert session.scratch_path(given).startswith("hdfs://own/lectern/")
    for source in Path(session.__file__).parent.rglob("*.py"):
        assert "tempfile" not in source.read_text()
    staged = session.materialize(spark.range(3), "t")
    folder = Path(staged.inputFiles()[0].removeprefix("file://"))
    assert folder.exists()
    session.clear_scratch(spark)
    assert not folder.exists()
