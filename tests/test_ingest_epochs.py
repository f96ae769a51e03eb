"""Epochs of the incremental ingest: parallel parse, file sizes, counts, rescue, rejects, re-runs."""

from __future__ import annotations

import gzip
import json
import os
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.sources import jsonl
from lectern.streaming import ingest as I

from .conftest import write_jsonl


def spec_of(tmp_path, **more) -> I.IngestSpec:
    return I.IngestSpec("x", str(tmp_path / "src"), str(tmp_path / "b"), str(tmp_path / "ck"), key="id", **more)


def noise(n: int, seed: int = 0) -> str:
    return random.Random(seed).randbytes(n // 2).hex()


def data_files(target) -> list[int]:
    return [os.path.getsize(p) for p in Path(target).rglob("_epoch=*/**/part-*.parquet")]


def test_one_gzip_file_is_parsed_by_many_tasks(spark, tmp_path):
    (tmp_path / "src").mkdir()
    with gzip.open(tmp_path / "src" / "one.json.gz", "wt") as f:
        for i in range(20_000):
            f.write(json.dumps({"id": i, "t": noise(200, i)}) + "\n")
    spec = spec_of(tmp_path, schema="id BIGINT, t STRING", file_bytes=512 << 10)
    assert I.ingest_incremental(spark, spec, "b1").rows_added == 20_000
    parts = I.read_bronze(spark, spec.target).select(F.col("_metadata.file_name").alias("f"), "_source_file").distinct().collect()
    assert len(parts) >= 4 and len({r["_source_file"] for r in parts}) == 1     # a file per parsing task
    whole = spec_of(tmp_path / "whole", schema="id BIGINT, t STRING", file_bytes=None)
    whole.source = spec.source
    I.ingest_incremental(spark, whole, "b1")
    assert len(data_files(whole.target)) == 1                                   # without the exchange: one task


def test_a_skewed_landing_gives_files_of_even_size(spark, tmp_path):
    src = tmp_path / "src"
    write_jsonl(src, "big.json", [{"id": i, "t": noise(400, i)} for i in range(8000)])
    for k in range(30):
        write_jsonl(src, f"small{k}.json", [{"id": 10_000 + k, "t": noise(400, k)}])
    spec = spec_of(tmp_path, schema="id BIGINT, t STRING", file_bytes=1 << 20)
    I.ingest_incremental(spark, spec, "b1")
    sizes = sorted(data_files(spec.target))
    assert 2 <= len(sizes) <= 8 and sizes[-1] < 2 * sizes[0]
    assert I.read_bronze(spark, spec.target).count() == 8030


def test_counts_come_from_the_write(spark, tmp_path):
    src = tmp_path / "src"
    write_jsonl(src, "a.json", [{"id": 1}, {"id": 2, "new": 1}], ["", "   ", "{cut", '{"id": "text"}'])
    spec = spec_of(tmp_path, schema="id BIGINT")
    res = I.ingest_incremental(spark, spec, "b1")
    assert (res.rows_added, res.corrupt, res.rescued, res.erased) == (4, 2, 2, 0)
    assert I.ingest_incremental(spark, spec, "b2").rows_added == 0
    write_jsonl(src, "b.json", [{"id": 3}])
    out = I.run_plan(spark, [spec], "b3")[0]
    assert (out.rows_added, out.total_rows) == (1, 5) == (1, I.read_bronze(spark, spec.target).count())


def test_totals_read_no_table_file(spark, tmp_path, monkeypatch):
    write_jsonl(tmp_path / "src", "a.json", [{"id": i} for i in range(7)])
    spec = spec_of(tmp_path, schema="id BIGINT")
    I.ingest_incremental(spark, spec, "b1")
    for p in Path(spec.target).rglob("_epoch=*/**/part-*"):
        p.unlink()                                           # the table's files are gone, its load records aren't
    assert I.run_plan(spark, [spec], "b2")[0].total_rows == 7
    assert I.bronze_schema(spark, spec.target)["id"].dataType == T.LongType()


def test_an_epoch_run_again_replaces_its_rows(spark, tmp_path):
    """A crash after the write and before the stream's commit: the same epoch comes again, under another batch id."""
    write_jsonl(tmp_path / "src", "a.json", [{"id": i} for i in range(5)])
    spec = spec_of(tmp_path, schema="id BIGINT")
    real, calls = I.record_load, []

    def crash(*args):
        calls.append(args)
        raise OSError("lost")
    I.record_load = crash
    try:
        with pytest.raises(Exception, match="lost"):
            I.ingest_incremental(spark, spec, "b1")
    finally:
        I.record_load = real
    assert calls and I.ingest_incremental(spark, spec, "b2").rows_added == 5
    rows = I.read_bronze(spark, spec.target).collect()
    assert sorted(r.id for r in rows) == list(range(5)) and {r["_batch_id"] for r in rows} == {"b2"}


def test_inference_reads_raw_files_once(spark, tmp_path):
    src = tmp_path / "src"
    write_jsonl(src, "a.json", [{"id": 1, "s": {"x": 1, "e": {}}, "l": [{"a": 1}, {"b": None}], "odd name": 1.5, "mix": 1},
                                {"id": 2, "mix": "text", "n": None}], ["[1, 2]", "17", "{cut"])
    lines = spark.read.text(str(src))
    schema = jsonl.infer_schema(lines, hints="extra DATE")
    assert {f.name: f.dataType.simpleString() for f in schema.fields} == {
        "id": "bigint", "s": "struct<e:string,x:bigint>", "l": "array<struct<a:bigint,b:string>>", "odd name": "double",
        "mix": "string", "n": "string", "extra": "date"}
    reads = []
    spec = spec_of(tmp_path)
    real = I.stream_lines

    def counted(spark_, spec_):
        acc = spark_.sparkContext.accumulator(0)
        reads.append(acc)
        seen = F.udf(lambda v: acc.add(1) or v, "string")
        return real(spark_, spec_).withColumn("value", seen("value"))
    I.stream_lines = counted
    try:
        assert I.ingest_incremental(spark, spec, "b1").rows_added == 5
    finally:
        I.stream_lines = real
    assert reads[0].value == 5                                # five lines, each read from its file once


@pytest.mark.parametrize("found, want", [
    ("OBJECT<a: BIGINT, `b: VOID`: VOID>", {"a": "bigint", "b: VOID": "string"}),
    ("OBJECT<VOID: DECIMAL(3,1), VARIANT: ARRAY<VARIANT>>", {"VOID": "double", "VARIANT": "array<string>"}),
    ("OBJECT<e: OBJECT<>, f: ARRAY<OBJECT<g: FLOAT>>>", {"e": "string", "f": "array<struct<g:double>>"}),
    ("OBJECT<>", {}), ("VARIANT", {}), (None, {}),
])
def test_variant_schemas(spark, found, want):
    assert {f.name: f.dataType.simpleString() for f in jsonl.variant_schema(found).fields} == want


SCHEMA = "id BIGINT, name STRING, p STRUCT<x: BIGINT, q: STRUCT<y: STRING>>, l ARRAY<STRUCT<a: BIGINT>>, m MAP<STRING, BIGINT>"


def beyond(value, dtype):
    """What a Python value holds beyond a type; the definition of the rescue column, written out."""
    if value is None:
        return None
    if isinstance(dtype, T.StructType):
        if not isinstance(value, dict):
            return value
        types = {f.name: f.dataType for f in dtype.fields}
        rest = {k: beyond(v, types[k]) if k in types else v for k, v in value.items()}
        return {k: v for k, v in rest.items() if v is not None} or None
    if isinstance(dtype, T.ArrayType):
        if not isinstance(value, list):
            return value
        rest = [beyond(v, dtype.elementType) for v in value]
        return rest if any(v is not None for v in rest) else None
    if isinstance(dtype, T.MapType):
        if not isinstance(value, dict):
            return value
        if all(beyond(v, dtype.valueType) is None for v in value.values()):
            return None
        return {k: v for k, v in value.items() if v is not None}     # one value of another type, and no map is parsed
    if isinstance(dtype, T.StringType):
        return None
    return None if isinstance(value, int) and not isinstance(value, bool) else value


def test_the_rescue_column_holds_what_the_schema_misses(spark, tmp_path):
    rng = random.Random(4)
    leaf = lambda: rng.choice([1, 2, None, "t", 1.5, True])
    some = lambda d: {k: v for k, v in d.items() if rng.random() < 0.6}
    rows = [{"id": i, **some({
        "name": rng.choice(["n", None]), "new": leaf(), "p": some({"x": leaf(), "q": some({"y": "s", "z": leaf()}), "w": [1]}),
        "l": [some({"a": leaf(), "b": leaf()}) for _ in range(rng.randint(0, 3))], "m": some({"k": leaf(), "j": 3})})}
        for i in range(300)]
    rows += [{"id": 300, "p": 5, "l": {"a": 1}, "m": [1]}, {"id": 301}]
    write_jsonl(tmp_path / "src", "a.json", rows)
    schema = jsonl.parse_ddl(spark, SCHEMA)
    spec = spec_of(tmp_path, schema=schema)
    I.ingest_incremental(spark, spec, "b1")
    got = I.read_bronze(spark, spec.target).select(F.to_json(jsonl.RESCUED).alias("rest"), F.col("id"),
                                                   F.col(jsonl.CORRUPT).alias("bad")).collect()
    assert len(got) == len(rows)
    for r in got:
        want = beyond(rows[r.id], schema)
        assert (json.loads(r.rest) if r.rest else None) == want, (rows[r.id], r.rest)


def test_lines_with_repeated_names_are_kept_as_text(spark, tmp_path):
    write_jsonl(tmp_path / "src", "a.json", [], ['{"id": 1, "id": 2}'])
    spec = spec_of(tmp_path, schema="id BIGINT")
    I.ingest_incremental(spark, spec, "b1")
    row = I.read_bronze(spark, spec.target).select(F.to_json(jsonl.RESCUED).alias("r"), jsonl.CORRUPT).first()
    assert json.loads(row.r) == '{"id": 1, "id": 2}' and row[jsonl.CORRUPT] is None


def test_rejects_by_file_and_reason(spark, tmp_path):
    src = tmp_path / "src"
    write_jsonl(src, "a.json", [{"id": 1}, {"id": 2, "new": 1}], ["{cut", "[1]", '{"id": "text"}', "plain"])
    write_jsonl(src, "b.json", [{"id": i} for i in range(9)])
    write_jsonl(src, "c.json", [{"id": i} for i in range(99)], ["{"])
    spec = spec_of(tmp_path, schema="id BIGINT")
    I.ingest_incremental(spark, spec, "b1")
    bronze = I.read_bronze(spark, spec.target)
    found = {(r.source_file.rsplit("/", 1)[1], r.reason): (r.lines, r.of_lines) for r in jsonl.rejects_by_reason(bronze).collect()}
    assert found == {("a.json", "not_json"): (3, 6), ("a.json", "wrong_type"): (1, 6), ("a.json", "unknown_field"): (1, 6),
                     ("c.json", "not_json"): (1, 100)}
    assert [f["source_file"].rsplit("/", 1)[1] for f in jsonl.reject_gate(bronze, max_share=0.01)] == ["a.json"]
    assert len(jsonl.reject_gate(bronze, max_share=0.001)) == 2 and jsonl.reject_gate(bronze, max_share=0.9) == []
    assert len(jsonl.reject_gate(bronze, max_share=1.0, max_drift=0.1)) == 1


def test_readers_take_the_schema_from_load_records(spark, tmp_path):
    src = tmp_path / "src"
    write_jsonl(src, "a.json", [{"id": 1, "p": {"x": 1}}])
    spec = spec_of(tmp_path)
    I.ingest_incremental(spark, spec, "b1")
    write_jsonl(src, "b.json", [{"id": 2, "p": {"y": "t"}, "later": [1]}])
    I.ingest_incremental(spark, spec, "b2")
    rows = {r.id: r for r in I.read_bronze(spark, spec.target).collect()}
    assert rows[1].later is None and rows[1].p.asDict() == {"x": 1, "y": None}
    assert rows[2].later == [1] and rows[2].p.asDict() == {"x": None, "y": "t"}
    assert {r["_epoch"] for r in rows.values()} == {0, 1}


def test_rejected_lines_stop_a_gated_run(spark, raw_catalogue, tmp_path):
    from lectern.operators import quality
    from lectern.plans import layers as L
    fine = [t for t in quality.declared_tests() if t.model != "stg_reviews" and not t.model.startswith("bronze")]
    strict = L.Layout(str(raw_catalogue), str(tmp_path / "lake"), exclude=jsonl.SAMPLE_SUFFIX, max_rejected=0.01)
    with pytest.raises(quality.DataTestError, match="books: 1 of 14 lines"):
        L.run_all(spark, strict, tests=fine)
    assert not Path(strict.silver("stg_books")).exists()
    lenient = L.Layout(str(raw_catalogue), str(tmp_path / "lake2"), exclude=jsonl.SAMPLE_SUFFIX, max_rejected=0.5)
    assert L.run_all(spark, lenient, tests=fine).rejected == []
