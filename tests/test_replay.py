import random

from conftest import rows

from starload.operators.changes import change_feed, classify, mirror, upsert
from starload.operators.replay import forget, insert_feed, numbered_feed, replay, replayable, visible
from starload.plans.bucketed import attach, drop_old_versions, merge_bucketed, read_bucketed, versions, write_bucketed

KEYS = ["k"]
SCHEMA = "k int, v string, w double"


def history(spark, seed, length=5):
    """Versions of a table and the feeds between them."""
    rng = random.Random(seed)
    tables, feeds = [], []
    for seq in range(length):
        data = [(k, rng.choice(["a", "b", None]), rng.choice([0.0, 1.5])) for k in range(30) if rng.random() < 0.6]
        tables.append(spark.createDataFrame(data, SCHEMA))
        if seq:
            feeds.append(numbered_feed(change_feed(classify(tables[-2], tables[-1], KEYS), KEYS, delete=True), seq))
    return tables, feeds


def test_any_order_and_any_number_of_times(spark):
    for seed in range(2):
        tables, feeds = history(spark, seed)
        rng = random.Random(seed)
        in_order = replayable(tables[0])
        for feed in feeds:
            in_order = replay(in_order, [feed], KEYS)
        mixed = rng.sample(feeds, len(feeds)) + rng.choices(feeds, k=2)
        out_of_order = replay(replay(replayable(tables[0]), mixed[:2], KEYS), mixed[2:], KEYS)
        assert rows(visible(in_order)) == rows(tables[-1]) == rows(visible(out_of_order))
        assert rows(in_order) == rows(out_of_order) == rows(replay(in_order, feeds, KEYS))


def test_once_and_again_equals_upsert_and_mirror(spark):
    (old, new), _ = history(spark, 7, 2)
    classified = classify(old, new, KEYS)
    for delete, expected in ((False, upsert(old, new, KEYS)), (True, mirror(old, new, KEYS))):
        feed = numbered_feed(change_feed(classified, KEYS, delete=delete), 1)
        once = replay(replayable(old), [feed], KEYS)
        assert rows(visible(once)) == rows(expected) == rows(visible(replay(once, [feed], KEYS)))


def test_null_keys_ties_empty_feeds_and_forgetting(spark):
    table = spark.createDataFrame([(1, "a", 0.0), (None, "n", 0.0), (None, "n", 0.0)], SCHEMA)
    more = insert_feed(spark.createDataFrame([(None, "n", 0.0), (None, "m", 0.0), (2, "x", 0.0), (2, "y", 0.0)], SCHEMA), 1)
    state = replay(replay(replayable(table), [more], KEYS), [more.limit(0), more], KEYS)
    assert rows(visible(state)) == sorted([(1, "a", 0.0), (None, "m", 0.0), (None, "n", 0.0), (2, "y", 0.0)], key=lambda r: (r[0] is not None, str(r)))
    gone = numbered_feed(spark.createDataFrame([("DELETE", 1, None, None), ("DELETE", 9, None, None)], f"_op string, {SCHEMA}"), 2)
    state = replay(state, [gone], KEYS)
    assert rows(visible(state).filter("k is not null")) == [(2, "y", 0.0)]
    assert state.filter("_gone").count() == 2 and forget(state, 2).count() == 5 and forget(state, 3).count() == 3
    late = insert_feed(spark.createDataFrame([(1, "late", 0.0)], SCHEMA), 1)
    assert rows(visible(replay(state, [late], KEYS)).filter("k = 1")) == []
    assert replay(replayable(table.limit(0)), [], KEYS).count() == 0


def test_a_key_with_most_changes_is_combined_before_the_shuffle(spark):
    feed = insert_feed(spark.range(1000).selectExpr("7 as k", "cast(id as string) as v", "0.0D as w"), 1)
    plan = replay(replayable(spark.createDataFrame([(1, "a", 0.0)], SCHEMA)), [feed], KEYS)._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Window" not in plan and "Join" not in plan


def test_merges_do_not_move_the_stored_side(spark, tmp_path):
    old, new = spark.range(0, 1000).selectExpr("id as k", "'old' as v"), spark.range(500, 1500).selectExpr("id as k", "'new' as v")
    root, threshold = str(tmp_path), "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    try:
        spark.conf.set(threshold, "-1")
        stored = write_bucketed(old, "merged", KEYS, root)
        merged = upsert(stored, new, KEYS)
        plan = merged._jdf.queryExecution().executedPlan().toString()
        # one exchange, over the new rows; neither the check of the stored keys nor the join needs one over the stored
        assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
        assert merge_bucketed(new, "merged", KEYS, root).filter("v = 'new'").count() == 1000
        again = merge_bucketed(spark.range(3).selectExpr("id as k", "'third' as v"), "merged", KEYS, root, delete=True)
        assert rows(again) == [(0, "third"), (1, "third"), (2, "third")]
        assert versions(spark, "merged") == [1, 2, 3] and read_bucketed(spark, "merged").count() == 3
        # another session finds the buckets in the files
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        known = attach(spark, "known", 1, "k bigint, v string", KEYS, buckets, f"{root}/merged_v2")
        plan = upsert(known, new, KEYS)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and known.count() == 1500
        drop_old_versions(spark, "merged", 1)
        assert versions(spark, "merged") == [3]
    finally:
        spark.conf.set(threshold, before)
        for table in ("merged_v1", "merged_v2", "merged_v3", "known_v1"):
            spark.sql(f"DROP TABLE IF EXISTS {table}")
