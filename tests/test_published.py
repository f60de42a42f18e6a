import pytest
from conftest import rows

from pyspark.sql import functions as F

from starload.plans.published import Published

SCHEMA = "id long, v string, part string"


@pytest.fixture
def table(spark, tmp_path):
    found = Published(spark, "published_rows", str(tmp_path / "t"), "part")
    yield found
    spark.sql("DROP VIEW IF EXISTS published_rows")
    for number in found._tables():
        spark.sql(f"DROP TABLE published_rows_p{number}")


def df(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


FIRST = [(1, "a", "2023"), (2, "b", "2024"), (3, "c", "it's %")]


def test_slices_are_replaced_emptied_and_shared(spark, table, tmp_path):
    assert rows(table.replace_all(df(spark, *FIRST))) == FIRST
    files = {str(p): p.stat().st_mtime_ns for p in (tmp_path / "t").rglob("*.parquet")}
    after = table.replace_slices(df(spark, (9, "z", "2024"), (8, "y", "2025")), ["2023", "2024", "2099"])
    assert rows(after) == [(3, "c", "it's %"), (8, "y", "2025"), (9, "z", "2024")]
    assert all((tmp_path / p).stat().st_mtime_ns == t for p, t in files.items())
    places = table._places(2)
    assert places["'it\\'s %'"] == table._places(1)["'it\\'s %'"] and len(places) == 3
    assert rows(table.replace_slices(df(spark), ["2024"])) == [(3, "c", "it's %"), (8, "y", "2025")]
    with pytest.raises(ValueError):
        table.replace_slices(df(spark, (1, "a", None)))


def test_a_reader_sees_one_state_until_the_switch(spark, table, monkeypatch):
    table.replace_all(df(spark, *FIRST))
    switch, seen = table._switch, []

    def watched(name, number):
        seen.append(rows(table.read()))
        switch(name, number)

    monkeypatch.setattr(table, "_switch", watched)
    reader = table.read()
    table.replace_slices(df(spark, (9, "z", "2023"), (8, "y", "2024")))
    assert seen == [FIRST] and rows(reader) == FIRST
    assert rows(table.read()) == [(3, "c", "it's %"), (8, "y", "2024"), (9, "z", "2023")]

    def died(*_):
        raise RuntimeError("killed")

    monkeypatch.setattr(table, "_switch", died)
    with pytest.raises(RuntimeError):
        table.replace_slices(df(spark, (7, "x", "2023")))
    assert rows(table.read()) == [(3, "c", "it's %"), (8, "y", "2024"), (9, "z", "2023")]
    monkeypatch.setattr(table, "_switch", switch)
    with pytest.raises(Exception):
        table.replace_slices(df(spark, (7, "x", "2023")).withColumn("v", F.raise_error(F.lit("broken"))))
    assert rows(table.replace_slices(df(spark, (7, "x", "2023"))), "id") == [(3,), (7,), (8,)]


def test_rows_of_a_condition_and_what_is_forgotten(spark, table, tmp_path):
    table.replace_all(df(spark, *FIRST, (4, None, "2023"), (5, "a", "2022")))
    after = table.replace_where(df(spark, (6, "new", "2025")), F.col("v") == "a")
    assert rows(after, "id") == [(2,), (3,), (4,), (6,)]
    after = table.replace_where(df(spark, (7, "new", "2025")).withColumn("more", F.lit(1)), F.col("id") == 6)
    assert rows(after, "id", "more") == [(2, None), (3, None), (4, None), (7, 1)]
    before = rows(after)
    table.forget(keep=1)
    assert table._tables() == [3] and rows(table.read()) == before
    used = set(table._places(3).values())
    left = {f"file:{p}" for p in (tmp_path / "t").glob("slices-*/part=*")}
    assert {place.replace("file://", "file:") for place in used} == left


def test_partitions_are_pruned(spark, table):
    table.replace_all(df(spark, *FIRST))
    plan = table.read().filter("part = '2024'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan and table.read().filter("part = '2024'").count() == 1
