from conftest import rows

from pyspark.sql import functions as F

from starload.operators.dedupe import distinct_where, distinct_years, keep_first, repeated_keys

DATA = [("a", 1, 5), ("a", 1, 3), ("a", None, 1), ("a", None, 1), ("b", 2, 9), ("b", 2, None)]


def table(spark):
    return spark.createDataFrame(DATA, "k string, n int, v int")


def test_first_by_tiebreak_and_null_keys_stay(spark):
    assert rows(keep_first(table(spark), ["k", "n"])) == [("a", None, 1), ("a", None, 1), ("a", 1, 3), ("b", 2, None)]


def test_null_keys_can_count_as_equal(spark):
    assert rows(keep_first(table(spark), ["k", "n"], null_equal=True)) == [("a", None, 1), ("a", 1, 3), ("b", 2, None)]


def test_survivor_does_not_depend_on_partitioning(spark):
    first = rows(keep_first(table(spark).repartition(4), ["k"]))
    assert first == rows(keep_first(table(spark).coalesce(1), ["k"])) == [("a", None, 1), ("b", 2, None)]


def test_table_of_keys_alone(spark):
    assert rows(keep_first(table(spark).select("k"), ["k"])) == [("a",), ("b",)]


def test_repeats_are_cut_before_the_shuffle(spark):
    plan = keep_first(table(spark), ["k", "n"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and plan.count("Exchange") == 1


def test_floating_key_and_partial_tiebreak(spark):
    df = spark.createDataFrame([(-0.0, 2, "b"), (0.0, 2, "a"), (1.0, 1, "z")], "k double, t int, v string")
    assert rows(keep_first(df.filter("v != 'a'"), ["k"], ["t"]))[0] == (-0.0, 2, "b")
    assert rows(keep_first(df, ["k"], ["t"]), "v") == [("a",), ("z",)]
    assert str(keep_first(df.filter("v = 'b'"), ["k"]).first().k) == "-0.0"


def test_a_floating_key_alone_is_not_sorted(spark):
    df = spark.createDataFrame([("a", -0.0), ("a", -0.0), ("b", 1.0), ("b", None), ("b", None)], "k string, n double")
    found = keep_first(df, ["k", "n"])
    assert rows(found) == [("a", -0.0), ("b", None), ("b", None), ("b", 1.0)] and str(found.filter("k = 'a'").first().n) == "-0.0"
    assert "SortAggregate" not in found._jdf.queryExecution().executedPlan().toString()


def test_hot_key(spark):
    hot = spark.range(3000).select(F.when(F.col("id") < 1000, 0).otherwise(F.col("id")).alias("k"), "id")
    assert keep_first(hot, ["k"]).count() == 2001


def test_distinct_within_years(spark):
    data = [("x", "2023"), ("x", "2023"), ("y", "2024"), ("y", "2024"), ("z", None), ("z", None)]
    df = spark.createDataFrame(data, "v string, f string")
    expected = [("x", "2023"), ("y", "2024"), ("y", "2024"), ("z", None), ("z", None)]
    assert rows(distinct_years(df, [2023], "f")) == sorted(expected, key=lambda r: (r[0], r[1] is not None))
    assert distinct_where(df, F.lit(True)).count() == 3


def test_repeated_keys(spark):
    assert rows(repeated_keys(table(spark), ["k", "n"], "v")) == [("a", None, 2, 1), ("a", 1, 2, 3), ("b", 2, 2, 9)]
