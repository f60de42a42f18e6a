import hashlib

from conftest import rows

from pyspark.sql import functions as F

from starload.operators.numbering import (
    assign_surrogates, even_batches, exact_batches, number_rows, random_batches,
)


def test_numbers_are_contiguous_and_independent_of_partitioning(spark):
    df = spark.range(500).select(F.col("id").cast("string").alias("k"))
    one = dict(rows(number_rows(df.coalesce(1), ["k"], "n")))
    other = dict(rows(number_rows(df.repartition(7), ["k"], "n", hex_digits=1)))
    expected = sorted((str(i) for i in range(500)), key=lambda k: hashlib.md5(k.encode()).hexdigest())
    assert one == other == {k: i + 1 for i, k in enumerate(expected)}


def test_surrogates_continue_after_the_greatest(spark):
    members = spark.createDataFrame([("x", 1), ("y", 2)], "nk string, v int")
    current = spark.createDataFrame([(7, "a", 0)], "sk int, nk string, v int")
    result = assign_surrogates(members, "nk", "sk", current)
    assert dict(result.dtypes)["sk"] == "int"
    assert {r[0] for r in rows(result)} == {8, 9}
    assert {r[0] for r in rows(assign_surrogates(members, "nk", "sk", current.limit(0)))} == {1, 2}


def test_exact_batches(spark):
    sizes = exact_batches(spark.range(1003), ["id"], 100).groupBy("batch").count()
    assert rows(sizes.filter("batch < 11").select("count").distinct()) == [(100,)]
    assert rows(sizes.filter("batch = 11"), "count") == [(3,)]


def test_even_batches(spark):
    sizes = even_batches(spark.range(1000), ["id"], 100).groupBy("batch").count()
    assert sizes.count() == 10 and sizes.agg(F.sum("count")).first()[0] == 1000


def test_random_batches(spark):
    pieces = random_batches(spark.range(1000), 500, 1000, seed=1)
    assert len(pieces) == 2 and sum(p.count() for p in pieces) == 1000
    assert random_batches(spark.range(0), 500, 0) == []
