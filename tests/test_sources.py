import datetime as dt
import sys

import pytest
from conftest import rows

from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starload.operators.audit import audit_requests, landable
from starload.sources.files import read_csv_text, write_parquet
from starload.sources.jdbc import JdbcTarget, Split, scan_options
from starload.sources.files import set_aside_corrupt
from starload.sources.landing import land_json, read_landed
from starload.sources.paged import Limits, page_records, read_pages, request_plan, request_url
from starload.functions.spines import date_spine, literal_spine, year_spine
from starload.functions.suffix import create_suffix_function, suffix_udf, with_suffix

# the fetchers below travel by value, workers cannot import this file
cloudpickle.register_pickle_by_value(sys.modules[__name__])

RECORD = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])
FAST = dict(back_off=0.0)


class Script:
    """Answers per parameter: a list of statuses and record counts, then the end of the data."""

    def __init__(self, pages: dict, end=(200, [])):
        self.pages, self.end = pages, end

    def __call__(self, param, page, size):
        total = self.pages.get(param, 0)
        first = page * size
        if first >= total:
            return self.end
        return 200, [{"id": i, "name": f"{param}{i}"} for i in range(first, min(first + size, total))]


class Flaky:
    """Fails ``failures`` times before every page; keeps its state in the reading process."""

    def __init__(self, failures: int, pages: int):
        self.failures, self.pages, self.left = failures, pages, failures

    def __call__(self, param, page, size):
        if self.left:
            self.left -= 1
            return 503, None
        self.left = self.failures
        return 200, [{"id": page, "name": param}] if page < self.pages else []


@pytest.mark.parametrize("readers", [1, 3])
def test_every_page_once(spark, readers):
    limits = Limits(executions=-1)
    requests = read_pages(spark, ["a", "b", "none"], Script({"a": 25, "b": 10}), 10, readers, limits=limits, **FAST)
    records = page_records(requests, RECORD)
    assert sorted(r.id for r in records.filter("param = 'a'").collect()) == list(range(25))
    assert records.filter("param = 'b'").count() == 10
    assert requests.filter("is_end").count() == 3 * readers
    assert requests.filter("param = 'a' and size(records) > 0").count() == 3


def test_end_by_status_does_not_stop_on_an_empty_page(spark):
    stopped = read_pages(spark, ["a"], Script({"a": 5}, end=(404, None)), 10, stop_on="not_found", **FAST)
    assert rows(stopped, "page", "status", "is_end") == [(0, 200, False), (1, 404, True)]
    limited = {"stop_on": "not_found", "limits": Limits(executions=4), **FAST}
    endless = read_pages(spark, ["a"], Script({"a": 5}), 10, on_limit="mark", **limited)
    assert endless.count() == 4 and endless.filter("is_end").isEmpty()
    assert rows(endless.filter("gave_up"), "page") == [(3,)]
    with pytest.raises(Exception, match="gave up on 'a' at page 3"):
        read_pages(spark, ["a"], Script({"a": 5}), 10, **limited).collect()


def test_no_limit_on_pages_by_default(spark):
    requests = read_pages(spark, ["a"], Script({"a": 300}), 1, **FAST)
    assert requests.count() == 301 and requests.filter("is_end").count() == 1


def test_failures_retry_the_page_and_respect_limits(spark):
    retried = read_pages(spark, ["a"], Flaky(2, 2), 1, limits=Limits(consecutive_errors=3), **FAST)
    assert rows(retried.orderBy("seq"), "seq", "page", "status") == [
        (0, 0, 503), (1, 0, 503), (2, 0, 200), (3, 1, 503), (4, 1, 503), (5, 1, 200), (6, 2, 503), (7, 2, 503),
        (8, 2, 200),
    ]
    gave_up = read_pages(spark, ["a"], Flaky(9, 2), 1, on_limit="mark", **FAST)
    assert gave_up.count() == 5 and gave_up.filter("status = 200").isEmpty()
    with pytest.raises(ValueError):
        read_pages(spark, ["a"], Flaky(0, 1), readers=2, limits=Limits(errors=3))
    with pytest.raises(ValueError):
        read_pages(spark, ["a"], Flaky(0, 1), stop_on="other")
    with pytest.raises(ValueError):
        read_pages(spark, ["a"], Flaky(0, 1), on_limit="other")


def test_only_successful_parameters_land(spark):
    limits = Limits(consecutive_errors=2)
    requests = read_pages(spark, ["good", "bad"], _half_bad, 1, limits=limits, on_limit="mark", **FAST)
    audited = audit_requests(
        requests, "param", "seq", F.col("status") == 200, F.col("is_end"), F.floor(F.col("seq") / 2),
        Limits(consecutive_errors=2),
    )
    assert rows(audited) == [
        ("bad", 1, 3, 2, 2, "consecutive errors exceeded"), ("good", 3, 3, 0, 0, "success"),
    ]
    assert {r.param for r in landable(page_records(requests, RECORD), audited).collect()} == {"good"}


def _half_bad(param, page, size):
    if param == "bad" and page > 0:
        return 500, None
    return 200, [{"id": page, "name": param}] if page < 3 else []


@pytest.mark.parametrize("width", [1, 2, 5, 100])
def test_audit_runs_across_chunks(spark, width):
    logs = {"a": "oeeo.", "b": "eeeee", "c": "oooo", "d": "eoeeeoee.", "e": "."}
    data = [(p, i, mark) for p, log in logs.items() for i, mark in enumerate(log)]
    log = spark.createDataFrame(data, "p string, seq long, mark string")
    audited = audit_requests(
        log, "p", "seq", F.col("mark") == "o", F.col("mark") == ".", F.floor(F.col("seq") / width),
        Limits(errors=-1, consecutive_errors=5, executions=4),
    )
    assert rows(audited) == [
        ("a", 2, 4, 2, 2, "success"),
        ("b", 0, 5, 5, 5, "consecutive errors exceeded"),
        ("c", 4, 4, 0, 0, "executions exceeded"),
        ("d", 2, 8, 6, 3, "success"),
        ("e", 0, 0, 0, 0, "success"),
    ]


def test_audit_asks_every_reader_for_its_end(spark):
    logs = {("a", 0): "oo.", ("a", 1): "ee", ("b", 0): "oe.", ("b", 1): "eo."}
    data = [(*whose, i, mark) for whose, log in logs.items() for i, mark in enumerate(log)]
    log = spark.createDataFrame(data, "p string, r int, seq long, mark string")
    audited = audit_requests(
        log, "p", "seq", F.col("mark") == "o", F.col("mark") == ".", F.col("seq"), Limits(consecutive_errors=2), reader="r"
    )
    assert rows(audited) == [("a", 2, 4, 2, 2, "consecutive errors exceeded"), ("b", 2, 4, 2, 1, "success")]


def test_an_empty_extraction_empties_its_parameter(spark, tmp_path):
    folder = str(tmp_path / "landing")
    schema = "id long, name string, param string"
    land_json(spark.createDataFrame([(1, "x", "p/1"), (2, "y", "q")], schema), folder)
    land_json(spark.createDataFrame([(3, "z", "q")], schema), folder, params=["p/1", "q", "never"])
    assert rows(read_landed(spark, folder, RECORD)) == [(3, "z", "q")]


class Counted(Script):
    """Leaves a file for every request made, in whatever process."""

    def __init__(self, folder, pages):
        super().__init__(pages)
        self.folder = folder

    def __call__(self, param, page, size):
        import pathlib
        import uuid

        pathlib.Path(self.folder, uuid.uuid4().hex).touch()
        return super().__call__(param, page, size)


def test_every_page_is_fetched_once_and_empty_extractions_are_seen(spark, tmp_path):
    """Two parameters of five pages and one without a record: 13 requests, the ends of each included."""
    (tmp_path / "calls").mkdir()
    folder = str(tmp_path / "landing")
    land_json(spark.createDataFrame([(1, "old", "none"), (2, "old", "kept")], "id long, name string, param string"), folder)
    requests = read_pages(spark, ["a", "b", "none"], Counted(str(tmp_path / "calls"), {"a": 50, "b": 45}), 10, **FAST)
    land_json(page_records(requests, RECORD), folder, params=["a", "b", "none"])
    assert len(list((tmp_path / "calls").iterdir())) == 6 + 6 + 1
    landed = read_landed(spark, folder, RECORD)
    assert rows(landed.groupBy("param").count()) == [("a", 50), ("b", 45), ("kept", 1)]


def test_partitions_of_odd_names_are_emptied(spark, tmp_path):
    folder, schema = str(tmp_path / "landing"), "id long, name string, param string"
    odd = ["a b", "c%d", "e=f", "g:h"]
    land_json(spark.createDataFrame([(i, "x", p) for i, p in enumerate(odd)], schema), folder)
    land_json(spark.createDataFrame([(9, "y", "c%d")], schema), folder, params=odd)
    assert rows(read_landed(spark, folder, RECORD)) == [(9, "y", "c%d")]


def test_broken_records_can_be_set_aside(spark, tmp_path):
    (tmp_path / "in.json").write_text('{"id": 1, "name": "a"}\n{"id": oops\n{"id": 2, "name": "b"}\n')
    kept = set_aside_corrupt(spark, str(tmp_path / "in.json"), RECORD, str(tmp_path / "aside"))
    assert rows(kept) == [(1, "a"), (2, "b")]
    aside = [r.value for r in spark.read.text(str(tmp_path / "aside")).collect()]
    assert len(aside) == 1 and "oops" in aside[0]


def test_landing_replaces_only_its_parameters(spark, tmp_path):
    folder = str(tmp_path / "landing")
    land_json(spark.createDataFrame([(1, "x", "p"), (2, "y", "q")], "id long, name string, param string"), folder)
    land_json(spark.createDataFrame([(3, "z", "q")], "id long, name string, param string"), folder)
    assert rows(read_landed(spark, folder, RECORD)) == [(1, "x", "p"), (3, "z", "q")]
    some = read_landed(spark, folder, RECORD, ["q", "absent"])
    assert rows(some) == [(3, "z", "q")]


def test_urls(spark):
    df = spark.range(1).select(
        request_url("http://h", "/e", {"a": "1", "b": F.col("id") + 5}).alias("plain"),
        request_url("http://h", "/e", {"a": "x y"}, escape=True).alias("escaped"),
        request_url("http://h", "/e", {}).alias("bare"),
    )
    assert rows(df) == [("http://h/e?a=1&b=5", "http://h/e?a=x+y", "http://h/e")]
    plan = request_plan(literal_spine(spark, ["PR"]), "http://h", "/e", "uf", F.lit(2))
    assert request_plan(literal_spine(spark, ["PR"]), "h", "e", "uf", F.lit(25_001)).select("page").distinct().count() == 25_001
    assert rows(plan, "url")[1] == ("http://h/e?pagina=1&tamanhoDaPagina=100&uf=PR",)


def test_spines(spark):
    assert rows(date_spine(spark, dt.date(2024, 3, 1), 2)) == [("2024-02-28",), ("2024-02-29",)]
    assert date_spine(spark, dt.date(2024, 3, 1), 0).isEmpty()
    assert rows(year_spine(spark, 2022, 2024)) == [(2022,), (2023,), (2024,)]
    assert year_spine(spark, 2024, 2023).isEmpty()


def test_csv_and_parquet(spark, tmp_path):
    spark.range(3).write.option("header", True).csv(str(tmp_path / "c"))
    df = read_csv_text(spark, str(tmp_path / "c"))
    assert dict(df.dtypes) == {"id": "string"}
    for _ in range(2):
        write_parquet(df, str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p")).count() == 3


def test_jdbc_options():
    target = JdbcTarget("jdbc:x", "d", {"user": "u"})
    assert scan_options(target, "select 1")["query"] == "select 1"
    split = scan_options(target, "select 1", Split("id", "0", "9", 3))
    assert split["dbtable"] == "(select 1) scan_source" and split["numPartitions"] == "3" and "query" not in split


def test_suffix(spark):
    sql = create_suffix_function(spark)
    df = spark.createDataFrame([("Social",), ("Roads",), ("",), ("é",)], "d string")
    every = [with_suffix(F.col("d"), ["Social"], "abc"), suffix_udf(["Social"], "abc")("d"), F.expr(f"{sql}(d, array('Social'), 'abc')")]
    assert rows(df.select(*every)) == sorted([(x, x, x) for x in ("Roadsabc", "Social", "abc", "éabc")])
    assert rows(df.select(suffix_udf([], "x")("d"))) == [("Roadsx",), ("Socialx",), ("x",), ("éx",)]
    plan = df.select(every[2])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    null = spark.createDataFrame([(None,)], "d string")
    assert rows(null.select(every[0], every[2])) == [(None, None)]
    with pytest.raises(Exception, match="NoneType"):
        null.select(suffix_udf(["x"], "abc")("d")).collect()


def test_the_udf_is_called_for_arrays_of_rows(spark, tmp_path):
    """As many calls as Arrow batches, not as rows."""
    plan = spark.range(10).select(suffix_udf(["1"], "abc")(F.col("id").cast("string")))._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "BatchEvalPython" not in plan


def test_rows_are_dealt_out_before_records_are_made(spark, tmp_path):
    """What moves between tasks are the rows that records are made of; the folders are sorted for as rows, too."""
    rows_of = spark.range(0, 1000, 1, 4).select("id", F.concat(F.lit("20"), (F.col("id") % 3).cast("string")).alias("param"))
    moved = []

    def make(dealt):
        moved.append(dealt)
        return dealt.select("id", F.sequence(F.lit(1), F.lit(200)).alias("many"), "param")

    land_json(rows_of, str(tmp_path / "j"), compression="gzip", make=make)
    assert moved[0].columns == ["id", "param"]
    plan = moved[0]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.startswith("Sort [param") and "RebalancePartitions [param" in plan
    back = read_landed(spark, str(tmp_path / "j"), T.StructType.fromDDL("id bigint, many array<int>"))
    assert back.filter("size(many) = 200 and param = concat('20', id % 3)").agg(F.count_distinct("id")).first()[0] == back.count() == 1000
