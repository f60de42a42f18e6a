import datetime as dt

import pytest
from conftest import rows

from pyspark.sql import functions as F

from starload.session import adaptive
from starload.functions.spines import legacy_delete_window, trailing_window
from starload.operators.dedupe import keep_first
from starload.operators.reload import (
    delete_by_parent, delete_where, delete_window, doomed_keys, overwrite_partitions, reload_by_parent, reload_window,
)
from starload.plans.snapshots import (
    complete_versions, drop_old_versions, read_snapshot, remove_copies, replace_window, with_period, write_snapshot,
)

TODAY = dt.date(2024, 3, 10)
DAYS = [dt.date(2024, 3, 10), dt.date(2024, 3, 9), dt.date(2024, 3, 3), dt.date(2024, 3, 2), dt.date(2024, 2, 1), None]


def dated(spark, tag="old", days=DAYS):
    return spark.createDataFrame([(i, tag, d) for i, d in enumerate(days)], "i int, tag string, day date")


def test_windows(spark):
    kept = rows(delete_window(dated(spark), "day", trailing_window(TODAY, 7)), "i")
    assert kept == [(0,), (3,), (4,), (5,)]
    assert rows(delete_window(dated(spark), "day", legacy_delete_window(TODAY, 7)), "i") == [(3,), (4,), (5,)]


def test_unknown_condition_keeps_the_row(spark):
    df = spark.createDataFrame([("PR",), ("SC",), (None,)], "uf string")
    assert rows(delete_where(df, F.col("uf").isin("PR"))) == [(None,), ("SC",)]


def test_children_go_with_their_parent(spark):
    parent = spark.createDataFrame([("a", "PR"), ("b", "SC"), ("c", None), ("a", "SC")], "k string, uf string")
    child = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), ("d", 4), (None, 5)], "k string, v int")
    condition = F.col("uf") == "PR"
    assert rows(delete_by_parent(child, parent, "k", condition), "v") == [(2,), (3,), (4,), (5,)]
    fresh = spark.createDataFrame([("a", 9)], "k string, v int")
    fresh_parent = spark.createDataFrame([("a", "PR")], "k string, uf string")
    children, parents = reload_by_parent({"c": child}, parent, {"c": fresh}, fresh_parent, "k", condition)
    assert rows(children["c"], "v") == [(2,), (3,), (4,), (5,), (9,)]
    assert rows(parents) == [("a", "PR"), ("a", "SC"), ("b", "SC"), ("c", None)]


def test_reload_window(spark):
    fresh = dated(spark, "new", [dt.date(2024, 3, 9)])
    result = reload_window(dated(spark), fresh, "day", trailing_window(TODAY, 7))
    assert rows(result, "tag", "day").count(("new", dt.date(2024, 3, 9))) == 1 and result.count() == 5


def test_partitions_not_named_stay(spark, tmp_path):
    path = str(tmp_path / "t")
    overwrite_partitions(spark.createDataFrame([(1, "2023"), (2, "2024")], "v int, f string"), path, "f")
    overwrite_partitions(spark.createDataFrame([(3, "2024")], "v int, f string"), path, "f")
    assert rows(spark.read.schema("v int, f string").parquet(path)) == [(1, "2023"), (3, "2024")]
    # an extraction of both years that found only rows of one empties the other
    overwrite_partitions(spark.createDataFrame([(4, "2024")], "v int, f string"), path, "f", ["2023", "2024"])
    assert rows(spark.read.schema("v int, f string").parquet(path)) == [(4, "2024")]


@pytest.mark.parametrize("grain", ["year", "month", "day"])
def test_window_is_replaced_in_place(spark, tmp_path, grain):
    root = str(tmp_path / grain)
    write_snapshot(with_period(dated(spark), "day", grain), root, "periodo")
    window = trailing_window(TODAY, 7)
    fresh_days = [dt.date(2024, 3, 9), None, dt.date(2020, 1, 1)]
    replace_window(dated(spark, "new", fresh_days), root, "day", window, grain)
    assert complete_versions(spark, root) == [1]
    expected = [r for r in rows(delete_window(dated(spark), "day", window))] + rows(dated(spark, "new", fresh_days))
    key = lambda r: [(v is not None, str(v)) for v in r]
    assert rows(read_snapshot(spark, root)) == sorted(expected, key=key)
    # repeating the reload multiplies nothing, not even rows without a date
    replace_window(dated(spark, "new", fresh_days), root, "day", window, grain)
    assert rows(read_snapshot(spark, root)) == sorted(expected, key=key)
    # an extraction that returned nothing empties the window
    replace_window(dated(spark, "new", []), root, "day", window, grain)
    left = [r for r in expected if r[2] != dt.date(2024, 3, 9)]
    assert rows(read_snapshot(spark, root)) == sorted(left, key=key)


def test_copies_are_removed_in_place(spark, tmp_path):
    root = str(tmp_path / "t")
    day = dt.date
    data = [
        ("a", 1, day(2023, 1, 1)), ("a", 2, day(2024, 1, 1)), ("b", 1, day(2024, 1, 1)), ("b", 1, day(2024, 1, 1)),
        ("c", 1, day(2022, 1, 1)), (None, 1, day(2022, 1, 1)), (None, 1, day(2022, 1, 1)), ("d", 1, None), ("d", 1, None),
        ("e", 0, day(2021, 1, 1)), ("e", 5, day(2020, 1, 1)),
    ]
    df = spark.createDataFrame(data, "k string, v int, day date")
    write_snapshot(with_period(df, "day", "year"), root, "periodo")
    untouched = (tmp_path / "t" / "v=1" / "periodo=2022").stat().st_mtime_ns
    assert set(remove_copies(spark, root, "periodo", ["k"])) == {2020, 2021, 2023, 2024, None}
    assert rows(read_snapshot(spark, root)) == rows(keep_first(df, ["k"]))
    assert (tmp_path / "t" / "v=1" / "periodo=2022").stat().st_mtime_ns == untouched
    assert not (tmp_path / "t" / "v=1" / "periodo=2020").exists()
    assert remove_copies(spark, root, "periodo", ["k"]) == []
    again = str(tmp_path / "again")
    write_snapshot(with_period(df, "day", "year"), again, "periodo")
    # copies are looked for among the given keys only
    assert remove_copies(spark, again, "periodo", ["k"], df.filter("k = 'b'").select("k")) == [2024]
    filed = df.drop("day").withColumn("f", F.when(F.col("k") == "b", "2024").otherwise("2023"))
    write_snapshot(filed, f"{root}x", "f")
    assert sorted(remove_copies(spark, f"{root}x", "f")) == ["2023", "2024"]
    assert rows(read_snapshot(spark, f"{root}x"), "k", "v", "f") == rows(filed.distinct(), "k", "v", "f")


def test_rows_of_other_keys_are_dropped_before_the_shuffle(spark, tmp_path):
    """The keys of the parents to delete become a Bloom filter over the scan of the children."""
    threshold, size = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"
    before = {key: spark.conf.get(key) for key in (threshold, size)}
    spark.range(20_000).selectExpr("cast(id as string) as k", "cast(id % 9 as int) as periodo").write.partitionBy("periodo").parquet(str(tmp_path / "c"))
    spark.range(20_000).selectExpr("cast(id as string) as k", "if(id % 1000 = 0, 'PR', 'SC') as uf").write.parquet(str(tmp_path / "p"))
    try:
        for key, value in ((threshold, "-1"), (size, "0")):
            spark.conf.set(key, value)
        child, parent = spark.read.parquet(str(tmp_path / "c")), spark.read.parquet(str(tmp_path / "p"))
        held = child.join(doomed_keys(parent, "k", F.col("uf").isin("PR", "XX")), "k", "left_semi")
        assert held.count() == 20
        plan = held._jdf.queryExecution().executedPlan().toString()
        assert "might_contain" in plan and "bloom_filter_agg" in plan and "In(uf, [PR,XX])" in plan
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_unfinished_version_is_not_read(spark, tmp_path):
    root = str(tmp_path / "t")
    assert read_snapshot(spark, root) is None
    write_snapshot(spark.range(2), root)
    spark.range(9).write.parquet(f"{root}/v=2")
    (tmp_path / "t" / "v=2" / "_SUCCESS").unlink()
    assert read_snapshot(spark, root).count() == 2
    assert write_snapshot(spark.range(3), root).count() == 3
    assert complete_versions(spark, root) == [1, 2]
    drop_old_versions(spark, root, keep=1)
    assert complete_versions(spark, root) == [2] and read_snapshot(spark, root).count() == 3


def test_shuffle_files_go_with_their_query(spark):
    """A query that is asked for again still has its rows; files of a done query are not left until the driver collects its garbage."""
    assert adaptive(spark).conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "true"
    counted = spark.range(1000).repartition(3, "id").groupBy((F.col("id") % 10).alias("k")).count()
    assert rows(counted) == rows(counted) == [(k, 100) for k in range(10)]
