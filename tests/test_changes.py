import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from starload.operators.changes import (
    apply_changes, change_counts, change_feed, classify, mirror, rows_to_delete, rows_to_insert, rows_to_update,
    upsert, upsert_sql,
)

SCHEMA = "k int, a string, b int"
OLD = [(1, "x", 1), (2, "x", None), (3, None, 3), (4, "gone", 4), (5, None, None), (None, "old", 0)]
NEW = [(1, "x", 1), (2, "x", 2), (3, "y", 3), (5, None, None), (6, "in", 6), (None, "new", 0)]


def pair(spark, old=OLD, new=NEW):
    return spark.createDataFrame(old, SCHEMA), spark.createDataFrame(new, SCHEMA)


def test_three_differences(spark):
    old, new = pair(spark)
    assert rows(rows_to_update(old, new, ["k"])) == [(2, "x", 2), (3, "y", 3)]
    assert rows(rows_to_insert(old, new, ["k"])) == [(None, "new", 0), (6, "in", 6)]
    assert rows(rows_to_delete(old, new, ["k"])) == [(None, "old", 0), (4, "gone", 4)]


def test_key_only_table_has_no_updates(spark):
    old, new = (df.select("k") for df in pair(spark))
    assert rows(rows_to_update(old, new, ["k"])) == []
    assert rows(upsert(old, new, ["k"])) == [(None,), (None,), (1,), (2,), (3,), (4,), (5,), (6,)]


def test_one_join_gives_the_same_as_three(spark):
    old, new = pair(spark)
    counts = dict(rows(change_counts(classify(old, new, ["k"]))))
    assert counts == {"INSERT": 2, "UPDATE": 2, "DELETE": 1, "SAME": 3}
    assert dict(rows(change_counts(classify(old, new, ["k"], null_keys="reject"))))["INSERT"] == 1
    with pytest.raises(Exception, match="null key"):
        classify(old, new, ["k"], null_keys="error").collect()
    assert rows_to_insert(old, new, ["k"]).count() == counts["INSERT"]
    with pytest.raises(ValueError):
        classify(old, new, ["k"], null_keys="other")


def test_single_join_in_plan(spark):
    plan = classify(*pair(spark), ["k"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join FullOuter") == 1 and plan.count("Join ") == 1


def test_switches(spark):
    old, new = pair(spark)
    kept = [(None, "old", 0), (1, "x", 1), (2, "x", None), (3, None, 3), (4, "gone", 4), (5, None, None)]
    assert rows(upsert(old, new, ["k"], insert=False, update=False)) == kept
    assert (6, "in", 6) in rows(upsert(old, new, ["k"], update=False))
    assert (4, "gone", 4) in rows(upsert(old, new, ["k"]))
    assert (4, "gone", 4) not in rows(mirror(old, new, ["k"]))


def test_old_only_columns_keep_their_value(spark):
    old = spark.createDataFrame([(10, 1, "x"), (11, 2, "y")], "sk int, k int, a string")
    new = spark.createDataFrame([(1, "z"), (3, "n")], "k int, a string")
    assert rows(upsert(old, new, ["k"]), "sk", "k", "a") == [(None, 3, "n"), (10, 1, "z"), (11, 2, "y")]


def test_unknown_column_is_refused(spark):
    old, new = pair(spark)
    with pytest.raises(ValueError, match="extra"):
        classify(old, new.withColumn("extra", new.k), ["k"])


def test_feed_has_keys_only_for_deletes(spark):
    feed = change_feed(classify(*pair(spark), ["k"]), ["k"], delete=True)
    assert rows(feed) == [
        ("DELETE", 4, None, None), ("INSERT", None, "new", 0), ("INSERT", 6, "in", 6), ("UPDATE", 2, "x", 2), ("UPDATE", 3, "y", 3),
    ]
    assert change_feed(classify(*pair(spark), ["k"]), ["k"], insert=False, update=False).isEmpty()


def test_repeated_key_is_an_error_unless_trusted(spark):
    old, new = pair(spark, new=[(1, "a", 1), (1, "b", 1)])
    with pytest.raises(Exception, match="the new version holds a key more than once"):
        upsert(old, new, ["k"]).collect()
    with pytest.raises(Exception, match="the old version holds a key more than once"):
        change_counts(classify(new, old, ["k"])).collect()
    assert upsert(old, new, ["k"], check_keys=False).count() == 7
    # the check needs no shuffle beyond those of the join
    plan = upsert(*pair(spark), ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
    assert rows(rows_to_update(new, old.filter("k = 1"), ["k"])) == [(1, "x", 1)]


def test_sql_pair(spark):
    old, new = pair(spark)
    old.createOrReplaceTempView("t_old")
    new.createOrReplaceTempView("t_new")
    result = upsert_sql(spark, "select * from t_old", "select k, a, b from t_new", ["k"], delete=True)
    assert rows(result) == [(None, "new", 0), (None, "old", 0), (1, "x", 1), (2, "x", 2), (3, "y", 3), (5, None, None), (6, "in", 6)]


_values = st.tuples(st.one_of(st.none(), st.sampled_from("ab")), st.one_of(st.none(), st.integers(0, 2)))
_tables = st.dictionaries(st.integers(0, 6), _values, max_size=6)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(old=_tables, new=_tables)
def test_properties(spark, old, new):
    """A mirror equals the new version, an upsert the merge of both; applying it again changes nothing."""
    before, after = pair(spark, [(k, *v) for k, v in old.items()], [(k, *v) for k, v in new.items()])
    assert rows(mirror(before, after, ["k"])) == rows(after)
    merged = upsert(before, after, ["k"])
    assert {r[0]: tuple(r[1:]) for r in rows(merged)} == {**old, **new}
    again = classify(merged, after, ["k"])
    assert not {"INSERT", "UPDATE"} & {op for op, _ in rows(change_counts(again))}
    assert rows(apply_changes(again, ["k"])) == rows(merged)
