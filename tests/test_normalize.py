import datetime as dt
import json

import pytest
from conftest import rows

from pyspark.sql import functions as F

from starload.functions.columns import array_columns, parse_date, string_columns
from starload.operators.normalize import CHILDREN, drop_arrays, explode_child, normalize
from starload.schemas import PARENT_TABLE, PROJECT_LANDING
from starload.sources.files import file_lineage, file_lineage_fixed, read_all_json, read_chosen_json, read_required_json

RECORDS = [
    {"idUnico": "A", "dataCadastro": "2024-09-18", "eixos": [{"id": 1, "descricao": "x"}, {"id": 2, "descricao": None}],
     "tipos": [], "fontesDeRecurso": [{"origem": "Federal", "valorInvestimentoPrevisto": 1.5}],
     "geometrias": [{"dataCriacao": "2024-01-02", "dataMetadado": "2024-13-01", "datum": "d"}]},
    {"idUnico": "B", "dataCadastro": "2024-13-01", "eixos": [], "dataSituacao": ""},
    {"idUnico": "C", "dataCadastro": "2024-01-01T10:00:00", "eixos": None},
    {"idUnico": "D"},
]


@pytest.fixture
def folder(tmp_path):
    one_line = json.dumps(RECORDS[:2])
    (tmp_path / "2024-09-18.json").write_text(one_line)
    (tmp_path / "2024-09-19.json").write_text("\n".join(json.dumps(r) for r in RECORDS[2:]))
    (tmp_path / "2024-09-20.json").write_text("[]")
    (tmp_path / "indented.json").write_text(json.dumps(RECORDS, indent=4))
    return str(tmp_path)


def test_reads_chosen_files_and_skips_missing_ones(spark, folder):
    days = ["2024-09-18", "2024-09-19", "2024-09-20", "2024-09-21"]
    df = read_chosen_json(spark, folder, days, PROJECT_LANDING)
    assert df.schema == PROJECT_LANDING
    assert rows(df, "idUnico") == [("A",), ("B",), ("C",), ("D",)]


def test_no_file_gives_an_empty_table(spark, folder):
    assert read_chosen_json(spark, folder, ["1999-01-01"], PROJECT_LANDING).count() == 0
    assert read_chosen_json(spark, folder, [], PROJECT_LANDING).schema == PROJECT_LANDING
    empty = read_chosen_json(spark, folder, ["2024-09-20"], PROJECT_LANDING)
    assert all(df.isEmpty() for df in normalize(empty).values())


def test_a_parameter_is_no_pattern(spark, folder):
    assert read_chosen_json(spark, folder, ["2024-09-*", "{indented}"], PROJECT_LANDING).isEmpty()


def test_required_file_must_exist(spark, folder):
    assert read_required_json(spark, f"{folder}/2024-09-18.json", PROJECT_LANDING).count() == 2
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_required_json(spark, f"{folder}/2030.json", PROJECT_LANDING).count()


def test_indented_file_fails_loudly_without_multi_line(spark, folder):
    with pytest.raises(Exception, match="corrupt landing record"):
        read_required_json(spark, f"{folder}/indented.json", PROJECT_LANDING).collect()
    df = read_required_json(spark, f"{folder}/indented.json", PROJECT_LANDING, multi_line=True)
    assert df.count() == 4


def test_reads_every_file(spark, folder):
    assert read_all_json(spark, folder, PROJECT_LANDING, multi_line=True).filter("idUnico = 'A'").count() == 2


def test_lineage(spark, folder):
    df = read_chosen_json(spark, folder, ["2024-09-18", "2024-09-19"], PROJECT_LANDING)
    named = df.select("idUnico", file_lineage(), file_lineage_fixed(-15, 10), file_lineage_fixed(-9, 4))
    assert rows(named)[0] == ("A", "2024-09-18", "2024-09-18", "9-18")
    assert rows(named)[3][1] == "2024-09-19"


def test_children_and_parent(spark, folder):
    df = read_chosen_json(spark, folder, ["2024-09-18", "2024-09-19"], PROJECT_LANDING)
    tables = normalize(df.withColumn("nomeArquivo", file_lineage()))
    assert set(tables) == {child.table for child in CHILDREN} | {PARENT_TABLE}
    day = dt.date(2024, 9, 18)
    assert rows(tables["stg_projeto_investimento_eixos"]) == [("A", day, 1, "x"), ("A", day, 2, None)]
    assert tables["stg_projeto_investimento_tipos"].isEmpty()
    geometry = rows(tables["stg_projeto_investimento_geometria"], "datacriacao", "datametadado", "datum")
    assert geometry == [(dt.date(2024, 1, 2), None, "d")]
    parent = tables[PARENT_TABLE]
    assert not array_columns(parent) and "nomearquivo" in parent.columns
    assert rows(parent, "idunico", "datacadastro") == [("A", day), ("B", None), ("C", None), ("D", None)]
    assert "nomearquivo" not in tables["stg_projeto_investimento_eixos"].columns


def test_strict_dates_raise(spark, folder):
    df = read_chosen_json(spark, folder, ["2024-09-18"], PROJECT_LANDING)
    with pytest.raises(Exception, match="CANNOT_PARSE|could not be parsed|Text"):
        normalize(df, strict_dates=True)[PARENT_TABLE].collect()


def test_absent_array(spark):
    df = spark.createDataFrame([("A", "2024-01-01")], "idUnico string, dataCadastro string")
    keys = ["idUnico", "dataCadastro"]
    child = explode_child(df, "tomadores", keys, PROJECT_LANDING)
    assert child.columns == [*keys, "codigo", "nome"] and child.isEmpty()
    with pytest.raises(ValueError):
        explode_child(df, "tomadores", keys)


def test_columns_by_type(spark):
    df = spark.createDataFrame([("a", 1, ["x"])], "s string, n int, l array<string>")
    assert array_columns(df) == ["l"] and string_columns(df) == ["s"]
    assert drop_arrays(df).columns == ["s", "n"]


@pytest.mark.parametrize("policy", ["CORRECTED", "EXCEPTION", "LEGACY"])
def test_what_cannot_be_a_date_does_not_reach_the_parser(spark, policy):
    data = [("2024-02-29",), ("2024-02-29T10:00:00",), ("2024-02-29 ",), ("24-2-9",), ("",), (None,), ("+12024-02-29",), ("-0004-02-29",)]
    texts = spark.createDataFrame(data, "n string").select("n", parse_date(F.col("n")).cast("string").alias("d"))
    spark.conf.set("spark.sql.legacy.timeParserPolicy", policy)
    try:
        found = {r.n: r.d for r in texts.collect()}
    finally:
        spark.conf.unset("spark.sql.legacy.timeParserPolicy")
    signed = {found.pop("+12024-02-29"), found.pop("-0004-02-29")}
    assert {text for text, date in found.items() if date} == {"2024-02-29"} and found["2024-02-29"] == "2024-02-29"
    assert policy != "CORRECTED" or signed == {"+12024-02-29", "-0004-02-29"}
