"""What the queries of whole loads land, and what they leave on disk."""

import datetime as dt
from pathlib import Path

import pytest

from pyspark.sql import functions as F

from starload.plans import warehouse as warehouses
from starload.plans.warehouse import Warehouse, run_by_date
from starload.queries import files, loads
from starload.queries.registry import QUERIES
from starload.sources.landing import land_json

DAY = dt.datetime(2000, 5, 1)


@pytest.fixture
def folder(spark, tmp_path):
    """Two orders with three line items, one of them twice, and two events, one without a time."""
    orders = [(1, 7, "P", 10.0, DAY, "1-URGENT"), (2, 8, "O", 20.0, DAY, "5-LOW")]
    lines = [(1, 1, 3, 4, 1, 5.0, 6.0, 0.1, 0.05, "R", "F", DAY)] * 2 + [(2, 2, 3, 4, 1, 5.0, 6.0, 0.0, 0.0, "N", "O", DAY)]
    events = [(1, DAY, 1, "view", 2.5, "{}"), (2, None, 2, "click", 1.0, "{}")]
    tables = {
        "orders": (orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"),
        "lineitem": (
            [(row[0], *row[2:]) for row in lines],
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
            "l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
        ),
        "events": (events, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"),
    }
    for name, (data, schema) in tables.items():
        spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/in/{name}.parquet")
    return f"{tmp_path}/in"


@pytest.fixture
def root(tmp_path, monkeypatch):
    monkeypatch.setattr(loads, "scratch_dir", lambda spark, label: f"{tmp_path}/{label}")
    return tmp_path


def test_execution_rows_are_landed_as_json_too(spark, folder, root, monkeypatch):
    landed = []

    def spy(df, path, *args, **options):
        landed.append(path)
        land_json(df, path, *args, **options)

    monkeypatch.setattr(files, "land_json", spy)
    built = {row.name: row for row in QUERIES["warehouse_end_to_end"](spark, folder).collect()}
    assert [Path(path).name for path in landed] == ["projects", "execution"]
    assert built["fact_projeto_investimento"].n == 2 and built["dim_projeto_investimento"].n == 2
    fact = loads.Warehouse(spark, f"{root}/warehouse", grain="year").current("fact_projeto_investimento")
    # an event whose file year is not known is booked as well
    assert sorted(row.valor_execucao for row in fact.collect()) == [1.0, 2.5]


def test_landed_execution_rows_keep_their_values_and_their_year(spark, folder, tmp_path):
    names = ["idProjetoInvestimento", "valorEmpenho", "numeroNotaEmpenhoGerada", "nomearquivo"]
    found = files.landed_execution(spark, folder, f"{tmp_path}/booked")
    assert sorted(map(tuple, found.select(names).collect())) == [("1", 2.5, "1", "2000"), ("2", 1.0, "2", None)]
    assert found.filter(F.col("descricaoEmpenho").isNotNull()).count() == 0


def test_landed_copies_go_once_staging_is_written(spark, folder, root):
    QUERIES["warehouse_end_to_end"](spark, folder).collect()
    left = {path.name for path in (root / "warehouse").iterdir()}
    assert "landed" not in left and "stg_projeto_investimento" in left
    assert not [path for path in (root / "warehouse" / "landing").iterdir()]


def test_a_reload_by_state_keeps_no_copy_of_the_first_extraction(spark, folder, root):
    rows = {row.name: row.n for row in QUERIES["warehouse_by_attr"](spark, folder).collect()}
    left = {path.name for path in (root / "warehouse_by_attr").iterdir()}
    assert not left & {"run", "run1"} and rows["stg_projeto_investimento"] == 3


def _run(warehouse, spark, *records, run=None):
    from test_warehouse import TODAY, execution, nested

    return run_by_date(warehouse, nested(spark, *records), execution(spark, ("A", 5.5)), TODAY, 90, run=run)


def _state(built):
    return {name: sorted(map(str, df.collect())) for name, df in built.items()}


def test_a_first_load_is_written_once_and_without_copies(spark, tmp_path, monkeypatch):
    from test_warehouse import project

    searched = []
    remove_copies = warehouses.remove_copies

    def spy(*args, **options):
        searched.append(args[1])
        return remove_copies(*args, **options)

    monkeypatch.setattr(warehouses, "remove_copies", spy)
    warehouse = Warehouse(spark, str(tmp_path / "dw"))
    copies = [project("A"), project("A", "2024-02-05", nome="Other"), project("A"), project(None), project(None)]
    built = _run(warehouse, spark, *copies)
    assert not searched
    first = _state(built)
    assert len(first["stg_projeto_investimento"]) == 3 and len(first["stg_projeto_investimento_eixos"]) == 3
    # geometries have no key, every one stays
    assert len(first["stg_projeto_investimento_geometria"]) == 5 and len(first["fact_projeto_investimento"]) == 1
    _run(warehouse, spark, project("B"))
    assert len(searched) == 9


def test_a_first_load_that_died_goes_on_as_a_reload(spark, tmp_path, monkeypatch):
    from test_warehouse import project

    records = [project("A"), project("A", "2024-02-05", nome="Other"), project("A"), project("B", "2024-01-05")]
    whole = _state(_run(Warehouse(spark, str(tmp_path / "whole")), spark, *records))
    warehouse = Warehouse(spark, str(tmp_path / "died"))
    with monkeypatch.context() as patch:
        patch.setattr(Warehouse, "reload_execution", lambda *_, **__: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            _run(warehouse, spark, *records, run="named")
    assert _state(_run(warehouse, spark, *records, run="named")) == whole
