import json

import pytest
from conftest import rows

from pyspark.sql import functions as F
from pyspark.sql import types as T

from starload.schemas import PROJECT_LANDING
from starload.sources.drift import UNKNOWN, evolved, read_json, read_records, unknown_fields

ELEMENT = T.StructType([T.StructField("a", T.LongType()), T.StructField("in", T.StructType([T.StructField("x", T.LongType())]))])
SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("parts", T.ArrayType(ELEMENT))])
LINES = [
    {"id": 1, "name": "a", "novo": "lost", "parts": [{"a": 1, "b": 2}, {"a": 2, "b": 3, "in": {"x": 1, "y": True}}]},
    {"id": 2, "name": "12", "novo": 3.5, "parts": None},
    {"id": 3, "odd.name `x`": {"k": [1]}, "parts": [], "gone": None},
    [{"id": 4, "name": "in a list", "novo": "n"}, {"id": 5}],
    {},
]


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "param=x").mkdir()
    text = "\n".join(json.dumps(line) for line in LINES) + "\n\n"
    (tmp_path / "param=x" / "a.json").write_text(text)
    return str(tmp_path)


def test_unknown_fields_are_counted_with_their_types(spark, folder):
    report = unknown_fields(read_records(spark, folder), SCHEMA)
    assert rows(report) == sorted(
        [
            ("novo", "VARIANT", 3, 3), ("parts[].b", "BIGINT", 2, 1), ("parts[].in.y", "BOOLEAN", 1, 1),
            ("`odd.name ``x```", "OBJECT<k: ARRAY<BIGINT>>", 1, 1), ("gone", "VOID", 1, 1),
        ]
    )
    assert unknown_fields(read_records(spark, folder).limit(0), SCHEMA).count() == 0


def test_a_schema_takes_them_in(spark, folder):
    wider = evolved(SCHEMA, unknown_fields(read_records(spark, folder), SCHEMA))
    assert wider.names == ["id", "name", "parts", "odd.name `x`", "gone", "novo"]
    assert wider["parts"].dataType.elementType.simpleString() == "struct<a:bigint,in:struct<x:bigint,y:boolean>,b:bigint>"
    assert unknown_fields(read_records(spark, folder), wider).count() == 0
    found = read_json(spark, folder, wider, "error", partition="param")
    assert rows(found.select("id", F.get("parts", 1)["in"]["y"], "param")) == [(None, None, "x"), (1, True, "x"), (2, None, "x"), (3, None, "x"), (4, None, "x"), (5, None, "x")]
    with pytest.raises(ValueError):
        evolved(SCHEMA, unknown_fields(read_records(spark, folder), SCHEMA), most=3)


def test_unknown_fields_are_kept_or_refused(spark, folder):
    kept = {r.id: r for r in read_json(spark, folder, SCHEMA, partition="param").collect()}
    assert len(kept) == 6 and kept[2].name == "12" and kept[5][UNKNOWN] == {}
    assert kept[1][UNKNOWN] == {"novo": '"lost"', "parts[0].b": "2", "parts[1].b": "3", "parts[1].in.y": "true"}
    assert kept[3][UNKNOWN] == {"`odd.name ``x```": '{"k":[1]}', "gone": "null"}
    with pytest.raises(Exception, match="unknown fields"):
        read_json(spark, folder, SCHEMA, "error").collect()
    with pytest.raises(ValueError):
        read_json(spark, folder, SCHEMA, "drop")


def test_files_of_several_lines_and_broken_ones(spark, tmp_path):
    (tmp_path / "2024.json").write_text(json.dumps([{"id": 1, "novo": 1}, {"id": 2}], indent=2))
    (tmp_path / "2025.json").write_text('{"id": oops')
    found = read_json(spark, str(tmp_path), SCHEMA, names="2024.json", multi_line=True)
    assert rows(found, "id") == [(1,), (2,)]
    with pytest.raises(Exception, match="MALFORMED|malformed|PARSE"):
        read_json(spark, str(tmp_path), SCHEMA, multi_line=True).collect()
    with pytest.raises(Exception, match="MALFORMED|malformed|PARSE"):
        unknown_fields(read_records(spark, str(tmp_path), multi_line=True), SCHEMA).collect()


def test_project_records_and_the_plan(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"idUnico": "A", "eixos": [{"id": 1, "descricao": "d", "peso": 2}], "tomadores": "no list"}))
    report = unknown_fields(read_records(spark, str(tmp_path)), PROJECT_LANDING)
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and plan.count("Exchange") == 1
    assert rows(report) == [("eixos[].peso", "BIGINT", 1, 1)]


def test_names_of_any_kind_and_elements_that_are_none(spark, tmp_path):
    lines = [
        {"id": 1, "parts": [None, 5, "x", {"a": 1, "in": [1]}, {"a": {"k": 1}, "in": {"x": 1, "a.b": [], "it's": 2}}], "q?": 1, "a]b": {"c": None}},
        {"id": 2, "parts": {"b": 1}, "name": {"first": "known fields are not looked into"}, "say \"it\"": True, "": 0, "é": "e"},
        {"id": 3, "parts": [{"b": 1}, {"b": None}, {"b": 2.5}]},
        5, None, "text", [None, {"id": 4, "é": "f", "parts": [{"c": [{"d": 1}]}]}],
    ]
    (tmp_path / "a.json").write_text("\n".join(json.dumps(line) for line in lines))
    flat = T.StructType([SCHEMA["id"], SCHEMA["name"], T.StructField("parts", T.ArrayType(T.StructType([ELEMENT["a"]])))])
    top = [("`a]b`", "OBJECT<c: VOID>", 1, 1), ("`q?`", "BIGINT", 1, 1), ("`say \"it\"`", "BOOLEAN", 1, 1), ("``", "BIGINT", 1, 1), ("`é`", "STRING", 2, 2)]
    elements = [("parts[].b", "DECIMAL(21,1)", 3, 1), ("parts[].c", "ARRAY<OBJECT<d: BIGINT>>", 1, 1)]
    records = read_records(spark, str(tmp_path))
    nested = [("parts[].in.`a.b`", "ARRAY<VOID>", 1, 1), ("parts[].in.`it's`", "BIGINT", 1, 1)]
    assert sorted(map(tuple, unknown_fields(records, SCHEMA).collect())) == sorted(top + elements + nested)
    whole = sorted(r.path for r in unknown_fields(records, flat).collect())
    assert whole == sorted([r[0] for r in top + elements] + ["parts[].in"])


def test_texts_are_parsed_once_and_unknown_fields_found_once(spark, folder):
    plan = unknown_fields(read_records(spark, folder), PROJECT_LANDING)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("parseJson") == 1 and plan.count("Generate") == 1 and "size(" not in plan
