import pytest
import zlib
from awkward import documents, pairs, with_extras
from pyspark.sql import functions as F

from starload.llm.mixing import MOST_RATE, drawn, mixed, poisson_terms, source_rates, uniform
from starload.llm.shards import Shard, grow, layout, sharded, with_shard, with_slots


def test_movement_stays_in_the_changed_subtree(spark):
    ids = spark.range(20_000).withColumnRenamed("id", "doc_id")
    tree = [Shard("x", "r1", 0), Shard("x", "r1", 1), Shard("x", "r2", 2, 2.0), Shard("y", "r1", 3, 4.0)]
    before = with_shard(ids, tree)
    share = {r.shard: r["count"] / 20_000 for r in before.groupBy("shard").count().collect()}
    assert all(abs(share[s.shard] - s.weight / 8) < 0.02 for s in tree)
    heavier = with_shard(ids, [*tree[:2], Shard("x", "r2", 2, 3.0), tree[3]]).withColumnRenamed("shard", "after")
    moved = before.join(heavier, "doc_id").filter("shard <> after")
    # within x only into the rack that grew; between regions only into x
    assert moved.filter("shard = 3 and after = 3 or shard <> 3 and after <> 2").isEmpty() and not moved.isEmpty()
    more = with_shard(ids, grow(tree)).withColumnRenamed("shard", "after")
    moved = before.join(more, "doc_id").filter("shard <> after")
    assert {r.after for r in moved.select("after").distinct().collect()} == {4}
    with pytest.raises(ValueError):
        with_shard(ids, [Shard("x", "r", 0), Shard("x", "r", 0)])


def test_sharded_law_and_slots(spark):
    df = documents(spark)
    result = sharded(with_extras(df), 40)
    assert result.count() == df.count()
    sizes = {(r.doc_id, r.text): (len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode())) for r in df.collect()}
    assert {(r["size"], r.text_crc32) for r in result.collect()} == set(sizes.values())
    assert result.filter("grown_shard <> shard and grown_shard <> 40").isEmpty()
    assert result.groupBy("doc_id").agg(F.countDistinct("shard").alias("n")).filter("n > 1").isEmpty()
    assert sharded(df.limit(0)).count() == 0
    many = with_slots(with_shard(spark.range(5000).withColumnRenamed("id", "doc_id"), layout(7)), ["doc_id"], parts=16)
    for shard in range(7):
        slots = sorted(r.slot for r in many.filter(F.col("shard") == shard).collect())
        assert slots == list(range(len(slots)))


def test_no_python_on_the_way(spark):
    plan = sharded(documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_counts_invert_the_poisson_distribution(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 5)).alias("source"))
    rates = {r.source: r.rate for r in source_rates(docs, {"hot": 2.0, "s1": 0.0}).collect()}
    assert rates["s1"] == 0 and abs(sum(rates[s] * n for s, n in docs.groupBy("source").count().collect()) - 3000) < 1e-6
    draws = docs.select("doc_id", "source", uniform(7, F.col("doc_id"), F.crc32(F.col("text").cast("binary")), F.lit(1)).alias("u")).collect()
    expected = {}
    for r in draws:
        count = sum(p < r.u for p in poisson_terms(rates[r.source]))
        if count:
            expected[r.doc_id] = count
    got = mixed(docs, {"hot": 2.0, "s1": 0.0})
    assert {r.doc_id: r.n for r in got.groupBy("doc_id").agg(F.count("*").alias("n")).collect()} == expected
    assert got.groupBy("doc_id").agg(F.countDistinct("copy").alias("k"), F.count("*").alias("n")).filter("k <> n").isEmpty()
    total = sum(expected.values())
    assert abs(total - 3000) < 250 and abs(sum(expected.get(i, 0) for i in range(0, 3000, 3)) / total - 2 / 6) < 0.04


def test_rates_above_one_draw(spark):
    docs = spark.createDataFrame([(i, "t", "small" if i == 0 else "large") for i in range(2000)], "doc_id long, text string, source string")
    found = mixed(docs, {}).groupBy("source").count().collect()
    assert {r.source: abs(r["count"] - 1000) < 150 for r in found} == {"small": True, "large": True}
    assert abs(poisson_terms(3.0)[0] - 0.049787068) < 1e-8 and poisson_terms(MOST_RATE)[-1] > 1 - 1e-9
    with pytest.raises(ValueError):
        source_rates(docs, {"small": -1.0})


def test_mixing_awkward_rows(spark):
    df = documents(spark)
    clash = with_extras(df)
    result = mixed(clash, {"a": 1.0}, factor=3.0)
    assert set(clash.columns) <= set(result.columns) and result.schema["copy"].dataType.simpleString() == "int"
    rows = drawn(clash, {"a": 1.0}, factor=3.0)
    assert rows.select("row.copy").distinct().collect()[0][0] == "own copy"
    # repeated rows draw alike
    assert rows.filter("row.doc_id = 1").groupBy("copy").count().filter("count <> 2").isEmpty()
    assert mixed(df.limit(0), {}).count() == 0 and mixed(df, {"a": 0.0}, default=0.0).count() == 0
    assert pairs(mixed(df, {}), "doc_id", "copy") == pairs(mixed(df.repartition(5), {}), "doc_id", "copy")
