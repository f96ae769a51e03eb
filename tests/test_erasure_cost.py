"""What parsing and erasing do once per line and once per table, by their plans."""

from __future__ import annotations

import json

import pytest

from lectern.functions import scalar as S
from lectern.operators import governance
from lectern.sources import jsonl

LINES = [{"id": "a", "n": 1, "more": {"x": [1, None]}}, {"id": "b", "n": "text"}, {"id": None, "n": None},
         {"id": "c", "tags": [{"t": "u", "v": 2}, {"t": "w"}, 3]}, {"id": "d", "tags": [{"t": "u"}]}, [1], 5]
SCHEMA = "id STRING, n BIGINT, tags ARRAY<STRUCT<t: STRING>>"


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture
def parsed(spark):
    lines = spark.createDataFrame([(json.dumps(x), "f") for x in LINES] + [("{bad", "f"), ('{"id":"e","id":"f"}', "f")],
                                  "value string, _source_file string")
    return jsonl.parse_lines(lines, jsonl.parse_ddl(spark, SCHEMA))


def test_a_line_is_taken_apart_once(parsed):
    plan = _plan(parsed.select(jsonl.RESCUED))
    top = plan.count("try_cast(_v#")
    assert top == 1 and "schemaOfVariant" not in plan
    assert plan.count("as array<variant>") == 1


def test_what_the_schema_misses_is_kept(parsed):
    got = [None if r[0] is None else json.loads(str(r[0])) for r in parsed.selectExpr(f"to_json({jsonl.RESCUED})").collect()]
    assert got[:3] == [{"more": {"x": [1, None]}}, {"n": "text"}, None]
    assert got[4:8] == [None] * 4 and got[8] == '{"id":"e","id":"f"}'
    assert got[3] == {"tags": LINES[3]["tags"]}      # a value of another type among them: none of the field was read


def test_a_short_list_of_subjects_does_not_shuffle_the_table(spark):
    rows = spark.createDataFrame([(None,), *((str(i),) for i in range(50))], "user_id string").repartition(4)
    seven = spark.createDataFrame([("7",)], "u string").select(S.hash_id("u")).first()[0]
    for run, want in ((governance.erase_subjects, 50), (governance.subject_lookup, 1)):
        out = run(rows, [seven.upper(), None])
        assert "strategy=broadcast" in _plan(out)
        assert out.count() == want
        table = spark.createDataFrame([(seven,)], "_erase_hash string")
        assert "strategy=broadcast" not in _plan(run(rows, table)) and run(rows, table).count() == want
    assert governance.erase_subjects(rows, []).count() == 51
