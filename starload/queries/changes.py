"""Change detection between two versions of a per-order summary of the line items.

The old version knows the lines shipped before 2000, the new one those shipped since
1997, so orders appear, vanish, change and stay. The last return date is often null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.functions.columns import money_sum
from starload.operators.changes import (
    change_counts, change_feed, classify, difference, mirror, rows_to_delete, rows_to_insert, rows_to_update, upsert, upsert_sql,
)
from starload.operators.numbering import even_batches, exact_batches
from starload.operators.replay import numbered_feed, replay, replayable, visible
from starload.plans.bucketed import merge_bucketed, write_bucketed
from starload.queries.registry import query, table
from starload.session import scratch_dir

KEYS = ["l_orderkey"]


def _summary(lines: DataFrame) -> DataFrame:
    returned = F.when(F.col("l_returnflag") == "R", F.col("l_shipdate").cast("date"))
    return lines.groupBy("l_orderkey").agg(
        F.count("*").alias("n_lines"),
        money_sum(F.col("l_extendedprice")).alias("revenue"),
        F.max(F.col("l_shipdate").cast("date")).alias("last_ship"),
        F.max(returned).alias("last_return"),
    )


def versions(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    lines = table(spark, folder, "lineitem")
    shipped = F.col("l_shipdate")
    return _summary(lines.filter(shipped < "2000-01-01")), _summary(lines.filter(shipped >= "1997-01-01"))


def _version_sql(condition: str) -> str:
    return f"""
        select l_orderkey, count(*) as n_lines,
          cast(sum(cast(l_extendedprice as decimal(38,6))) as double) as revenue,
          cast(max(l_shipdate) as date) as last_ship,
          cast(max(case when l_returnflag = 'R' then l_shipdate end) as date) as last_return
        from lineitem where {condition} group by l_orderkey"""


OLD_SQL = _version_sql("l_shipdate < timestamp '2000-01-01'")
NEW_SQL = _version_sql("l_shipdate >= timestamp '1997-01-01'")
WITH = f"with old as ({OLD_SQL}), new as ({NEW_SQL})"
_VALUES = ["n_lines", "revenue", "last_ship", "last_return"]
_CHANGED = " or ".join(f"new.{c} is distinct from old.{c}" for c in _VALUES)
_ANTI_NEW = "not exists (select 1 from new where new.l_orderkey = old.l_orderkey)"
_ANTI_OLD = "not exists (select 1 from old where new.l_orderkey = old.l_orderkey)"
_UPDATES_SQL = f"select new.* from new join old on new.l_orderkey = old.l_orderkey where {_CHANGED}"


@query("diff_update", f"{WITH} {_UPDATES_SQL}")
def _update(spark, folder):
    return rows_to_update(*versions(spark, folder), KEYS)


@query("diff_insert", f"{WITH} select * from new where {_ANTI_OLD}")
def _insert(spark, folder):
    return rows_to_insert(*versions(spark, folder), KEYS)


@query("diff_delete", f"{WITH} select * from old where {_ANTI_NEW}")
def _delete(spark, folder):
    return rows_to_delete(*versions(spark, folder), KEYS)


@query(
    "diff_key_only",
    f"""{WITH} select 'INSERT' as _op, count(*) as n from new where {_ANTI_OLD}
    union all select 'DELETE', count(*) from old where {_ANTI_NEW}
    union all select 'SAME', count(*) from new join old on new.l_orderkey = old.l_orderkey""",
)
def _key_only(spark, folder):
    old, new = versions(spark, folder)
    return change_counts(classify(old.select(KEYS), new.select(KEYS), KEYS))


_UPSERT_SQL = f"""{WITH} select * from new
    union all select * from old where {_ANTI_NEW}"""


@query("upsert", _UPSERT_SQL)
def _upsert(spark, folder):
    return upsert(*versions(spark, folder), KEYS)


_NULL_KEYS = "select cast(null as bigint) as l_orderkey, n_lines, revenue, last_ship, last_return from new where l_orderkey % 50 = 0"


@query("upsert_null_keys", f"{_UPSERT_SQL} union all {_NULL_KEYS}")
def _upsert_null_keys(spark, folder):
    """New rows without a key match nothing and are inserted."""
    old, new = versions(spark, folder)
    lost = new.filter("l_orderkey % 50 = 0").withColumn("l_orderkey", F.lit(None).cast("bigint"))
    return upsert(old, new.unionByName(lost), KEYS)


@query("mirror", f"{WITH} select * from new")
def _mirror(spark, folder):
    return mirror(*versions(spark, folder), KEYS)


@query("upsert_sql_pair", _UPSERT_SQL)
def _sql_pair(spark, folder):
    table(spark, folder, "lineitem").createOrReplaceTempView("starload_lineitem")
    pair = [sql.replace("from lineitem", "from starload_lineitem") for sql in (OLD_SQL, NEW_SQL)]
    return upsert_sql(spark, *pair, KEYS)


@query(
    "change_counts",
    f"""{WITH} select 'INSERT' as _op, count(*) as n from new where {_ANTI_OLD}
    union all select 'DELETE', count(*) from old where {_ANTI_NEW}
    union all select 'UPDATE', count(*) from new join old on new.l_orderkey = old.l_orderkey where {_CHANGED}
    union all select 'SAME', count(*) from new join old on new.l_orderkey = old.l_orderkey
      where not ({_CHANGED})""",
)
def _counts(spark, folder):
    return change_counts(classify(*versions(spark, folder), KEYS))


@query(
    "change_feed",
    f"""{WITH} select 'INSERT' as _op, * from new where {_ANTI_OLD}
    union all select 'UPDATE', u.* from ({_UPDATES_SQL}) u
    union all select 'DELETE', l_orderkey, null, null, null, null from old where {_ANTI_NEW}""",
)
def _feed(spark, folder):
    return change_feed(classify(*versions(spark, folder), KEYS), KEYS, delete=True)


@query("feed_replay", _UPSERT_SQL)
def _feed_replay(spark, folder):
    """The feed of an upsert, applied to the old version twice."""
    old, new = versions(spark, folder)
    feed = numbered_feed(change_feed(classify(old, new, KEYS), KEYS), 1)
    return visible(replay(replay(replayable(old), [feed], KEYS), [feed], KEYS))


_LAST_SQL = _version_sql("l_shipdate >= timestamp '1998-06-01' and l_linenumber < 5")


@query("feed_replay_late", _LAST_SQL)
def _feed_replay_late(spark, folder):
    """Three versions, two feeds with deletes; the later feed arrives first, the earlier one late and twice."""
    old, new = versions(spark, folder)
    last = _summary(table(spark, folder, "lineitem").filter("l_shipdate >= timestamp '1998-06-01' and l_linenumber < 5"))
    first, second = (
        numbered_feed(change_feed(classify(a, b, KEYS), KEYS, delete=True), seq) for seq, a, b in ((1, old, new), (2, new, last))
    )
    state = replay(replayable(old), [second], KEYS)
    return visible(replay(replay(state, [first], KEYS), [first, second], KEYS))


@query("upsert_bucketed", f"{_UPSERT_SQL}")
def _upsert_bucketed(spark, folder):
    """The old version as a stored table bucketed by its key; the merge shuffles the new one alone."""
    root = scratch_dir(spark, "upsert_bucketed")
    name = f"upsert_{root.rsplit('-', 1)[-1]}"
    old, new = versions(spark, folder)
    write_bucketed(old, name, KEYS, root)
    return merge_bucketed(new, name, KEYS, root)


@query(
    "batches",
    f"""select cast((place - 1) // 500 + 1 as integer) as batch, count(*) as n,
        min(o_orderkey) as first_key, max(o_orderkey) as last_key
    from (select o_orderkey, row_number() over (order by md5(cast(o_orderkey as varchar))) as place from orders) o
    group by 1""",
)
def _batches(spark, folder):
    numbered = exact_batches(table(spark, folder, "orders").select("o_orderkey"), ["o_orderkey"], 500)
    return numbered.groupBy("batch").agg(
        F.count("*").alias("n"), F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("last_key")
    )


@query(
    "batches_even",
    """select cast(cast('0x' || substr(md5(cast(o_orderkey as varchar)), 1, 15) as bigint)
          % (select cast(ceil(count(*) / 500) as bigint) from orders) + 1 as integer) as batch,
        count(*) as n, min(o_orderkey) as first_key, max(o_orderkey) as last_key
    from orders group by 1""",
)
def _even(spark, folder):
    numbered = even_batches(table(spark, folder, "orders").select("o_orderkey"), ["o_orderkey"], 500)
    return numbered.groupBy("batch").agg(
        F.count("*").alias("n"), F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("last_key")
    )


@query(
    "set_difference",
    """select o_custkey, o_orderstatus from orders where o_orderdate >= timestamp '1998-01-01'
    except select o_custkey, o_orderstatus from orders where o_orderdate < timestamp '1998-01-01'""",
)
def _difference(spark, folder):
    orders = table(spark, folder, "orders")
    pairs = ["o_custkey", "o_orderstatus"]
    late = orders.filter(F.col("o_orderdate") >= "1998-01-01").select(pairs)
    return difference(late, orders.filter(F.col("o_orderdate") < "1998-01-01").select(pairs))


@query("limit_rows", "select l_orderkey, l_linenumber, l_extendedprice from lineitem order by all limit 500")
def _limit(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return lines.orderBy("l_orderkey", "l_linenumber", "l_extendedprice").limit(500)
