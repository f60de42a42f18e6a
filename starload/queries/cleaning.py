"""De-duplication, deletes, reloads and parameter spines over the driver tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.functions.columns import money_sum
from starload.functions.spines import (
    date_spine, legacy_delete_window, literal_spine, trailing_window, year_spine,
)
from starload.operators.dedupe import distinct_years, keep_first, repeated_keys
from starload.operators.reload import (
    delete_by_parent, delete_where, delete_window, overwrite_partitions, reload_by_parent, reload_window,
)
from starload.plans.published import Published
from starload.queries.registry import query, table
from starload.session import scratch_dir

_LINE = ["l_orderkey", "l_linenumber"]
_LINE_REST = [
    "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "shipped",
]
_LINES_SQL = """select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
    l_discount, l_tax, l_returnflag, l_linestatus, cast(l_shipdate as date) as shipped from lineitem"""
_ORDER_SQL = ", ".join(f"{name} nulls first" for name in _LINE_REST)


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    return lines.withColumn("shipped", F.col("l_shipdate").cast("date")).drop("l_shipdate")


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    return orders.withColumn("ordered", F.col("o_orderdate").cast("date")).drop("o_orderdate")


_ORDERS_SQL = """select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority,
    cast(o_orderdate as date) as ordered from orders"""


@query(
    "dedupe_first",
    f"""select * exclude (copy) from (select *, row_number() over (
        partition by l_orderkey, l_linenumber order by {_ORDER_SQL}) as copy from ({_LINES_SQL}) l) r
    where copy = 1""",
)
def _dedupe_first(spark, folder):
    return keep_first(_lines(spark, folder), _LINE, _LINE_REST)


_NULLED_SQL = f"""select * replace (nullif(l_linenumber, 7) as l_linenumber) from ({_LINES_SQL}) l"""


def _nulled(spark, folder):
    return _lines(spark, folder).withColumn("l_linenumber", F.nullif("l_linenumber", F.lit(7)))


@query(
    "dedupe_null_keys",
    f"""select * exclude (copy) from (select *, row_number() over (
        partition by l_orderkey, l_linenumber order by {_ORDER_SQL}) as copy from ({_NULLED_SQL}) l) r
    where copy = 1 or l_linenumber is null""",
)
def _dedupe_null_keys(spark, folder):
    return keep_first(_nulled(spark, folder), _LINE, _LINE_REST)


@query(
    "dedupe_null_equal",
    f"""select * exclude (copy) from (select *, row_number() over (
        partition by l_orderkey, l_linenumber order by {_ORDER_SQL}) as copy from ({_NULLED_SQL}) l) r
    where copy = 1""",
)
def _dedupe_null_equal(spark, folder):
    return keep_first(_nulled(spark, folder), _LINE, _LINE_REST, null_equal=True)


@query(
    "duplicate_keys",
    """select l_orderkey, l_linenumber, count(*) as copies, min(l_partkey) as first_id
    from lineitem group by 1, 2 having count(*) > 1""",
)
def _duplicate_keys(spark, folder):
    return repeated_keys(table(spark, folder, "lineitem"), _LINE, row_id="l_partkey")


_EVENTS_SQL = "select user_id, event_type, cast(ts as date) as day from events"


def _days(spark, folder):
    return table(spark, folder, "events").select("user_id", "event_type", F.col("ts").cast("date").alias("day"))


@query("distinct_all", f"select distinct * from ({_EVENTS_SQL}) e")
def _distinct_all(spark, folder):
    return _days(spark, folder).distinct()


_FILED_SQL = "select o_custkey, o_orderstatus, cast(year(o_orderdate) as varchar) as nomearquivo from orders"


def _filed(spark, folder):
    year = F.year("o_orderdate").cast("string").alias("nomearquivo")
    return table(spark, folder, "orders").select("o_custkey", "o_orderstatus", year)


@query(
    "distinct_partition",
    f"""with filed as ({_FILED_SQL})
    select distinct * from filed where cast(nomearquivo as integer) in (1996, 1997)
    union all select * from filed where cast(nomearquivo as integer) not in (1996, 1997)""",
)
def _distinct_partition(spark, folder):
    return distinct_years(_filed(spark, folder), [1996, 1997], "nomearquivo")


# Deletes --------------------------------------------------------------------------------------------------

AS_OF, DAYS = date(2001, 1, 1), 365
_IN_WINDOW = "ordered between date '2000-01-02' and date '2000-12-31'"


@query("delete_window", f"select * from ({_ORDERS_SQL}) o where not coalesce({_IN_WINDOW}, false)")
def _delete_window(spark, folder):
    return delete_window(_orders(spark, folder), "ordered", trailing_window(AS_OF, DAYS))


@query(
    "delete_children_by_parent",
    f"""select l.* from ({_LINES_SQL}) l
    where not exists (select 1 from orders where o_orderkey = l_orderkey and o_orderstatus in ('F', 'P'))""",
)
def _delete_children(spark, folder):
    parents = table(spark, folder, "orders").withColumnRenamed("o_orderkey", "l_orderkey")
    chosen = F.col("o_orderstatus").isin("F", "P")
    lines = _lines(spark, folder)
    return delete_by_parent(lines, parents, "l_orderkey", chosen).select(lines.columns)


_STATE_SQL = f"select * replace (nullif(o_orderstatus, 'P') as o_orderstatus) from ({_ORDERS_SQL}) o"


@query("delete_in_list", f"select * from ({_STATE_SQL}) o where not coalesce(o_orderstatus in ('F'), false)")
def _delete_in_list(spark, folder):
    stated = _orders(spark, folder).withColumn("o_orderstatus", F.nullif("o_orderstatus", F.lit("P")))
    return delete_where(stated, F.col("o_orderstatus").isin("F"))


# Reloads --------------------------------------------------------------------------------------------------


def _raised(orders: DataFrame) -> DataFrame:
    """Orders as a new extraction would return them, with another price."""
    return orders.withColumn("o_totalprice", F.rint("o_totalprice") + 1)


@query(
    "reload_by_date",
    f"""select * from ({_ORDERS_SQL}) o where not coalesce({_IN_WINDOW}, false)
    union all select * replace (round_even(o_totalprice, 0) + 1 as o_totalprice)
    from ({_ORDERS_SQL}) o where {_IN_WINDOW}""",
)
def _reload_by_date(spark, folder):
    orders, window = _orders(spark, folder), trailing_window(AS_OF, DAYS)
    fresh = _raised(orders.filter(window.contains(F.col("ordered"))))
    return reload_window(orders, fresh, "ordered", window)


@query(
    "reload_legacy_window",
    f"""select * from ({_ORDERS_SQL}) o where not coalesce(
      ordered between date '2000-01-02' and date '2001-01-01', false)
    union all select * replace (round_even(o_totalprice, 0) + 1 as o_totalprice)
    from ({_ORDERS_SQL}) o where {_IN_WINDOW}""",
)
def _reload_legacy(spark, folder):
    orders = _orders(spark, folder)
    fresh = _raised(orders.filter(trailing_window(AS_OF, DAYS).contains(F.col("ordered"))))
    return reload_window(orders, fresh, "ordered", legacy_delete_window(AS_OF, DAYS))


@query(
    "reload_by_attr",
    f"""with fresh as (select o_orderkey from orders where o_orderstatus = 'P'),
    kept as (select l.* from ({_LINES_SQL}) l where not exists (select 1 from fresh where o_orderkey = l_orderkey))
    select * from kept
    union all select l.* replace (cast(1 as double) as l_quantity)
    from ({_LINES_SQL}) l join fresh on o_orderkey = l_orderkey""",
)
def _reload_by_attr(spark, folder):
    parents = _orders(spark, folder).withColumnRenamed("o_orderkey", "l_orderkey")
    lines, chosen = _lines(spark, folder), F.col("o_orderstatus") == "P"
    fresh_parents = _raised(parents.filter(chosen))
    fresh = lines.join(fresh_parents.select("l_orderkey"), "l_orderkey", "left_semi").withColumn(
        "l_quantity", F.lit(1.0)
    )
    children, _ = reload_by_parent(
        {"lines": lines}, parents, {"lines": fresh.select(lines.columns)}, fresh_parents, "l_orderkey", chosen
    )
    return children["lines"].select(lines.columns)


@query(
    "reload_by_year",
    """select o_orderkey, case when year(o_orderdate) in (1998, 1999) then o_totalprice + 1 else o_totalprice end
      as o_totalprice, cast(year(o_orderdate) as integer) as nomearquivo from orders where year(o_orderdate) <> 2000""",
)
def _reload_by_year(spark, folder):
    filed = table(spark, folder, "orders").select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("nomearquivo"))
    path = scratch_dir(spark, "reload_by_year")
    overwrite_partitions(filed, path, "nomearquivo")
    fresh = filed.filter(F.col("nomearquivo").isin(1998, 1999)).withColumn("o_totalprice", F.col("o_totalprice") + 1)
    # the new extraction of 2000 is empty, so nothing of that year stays
    overwrite_partitions(fresh, path, "nomearquivo", [1998, 1999, 2000])
    return spark.read.schema(filed.schema).parquet(path)


@query(
    "reload_published",
    """select o_orderkey, case when year(o_orderdate) in (1998, 1999) then o_totalprice + 1 else o_totalprice end
      as o_totalprice, cast(year(o_orderdate) as integer) as nomearquivo
    from orders where year(o_orderdate) <> 2000 and not (o_orderstatus = 'P' and year(o_orderdate) not in (1998, 1999))
    union all select -o_orderkey, o_totalprice, cast(year(o_orderdate) as integer) from orders where o_orderstatus = 'P'""",
)
def _reload_published(spark, folder):
    """Two reloads behind a view: by file year, one of them empty, then by a condition on the rows."""
    orders = table(spark, folder, "orders")
    filed = orders.select("o_orderkey", "o_totalprice", "o_orderstatus", F.year("o_orderdate").alias("nomearquivo"))
    root = scratch_dir(spark, "published")
    published = Published(spark, f"published_{root.rsplit('-', 1)[-1]}", root, "nomearquivo")
    published.replace_all(filed)
    fresh = filed.filter(F.col("nomearquivo").isin(1998, 1999)).withColumn("o_totalprice", F.col("o_totalprice") + 1)
    published.replace_slices(fresh.withColumn("o_orderstatus", F.lit("R")), [1998, 1999, 2000])
    again = filed.filter("o_orderstatus = 'P'").withColumn("o_orderkey", -F.col("o_orderkey"))
    return published.replace_where(again, F.col("o_orderstatus") == "P").drop("o_orderstatus")


# Spines ---------------------------------------------------------------------------------------------------

@query(
    "date_spine",
    """with days as (select strftime(d, '%Y-%m-%d') as param
      from generate_series(timestamp '2000-12-02', timestamp '2000-12-31', interval 1 day) s(d))
    select param, count(o_orderkey) as n, cast(coalesce(sum(cast(o_totalprice as decimal(38,6))), 0) as double) as total
    from days left join orders on strftime(o_orderdate, '%Y-%m-%d') = param group by param""",
)
def _date_spine(spark, folder):
    orders = table(spark, folder, "orders").withColumn("param", F.col("o_orderdate").cast("date").cast("string"))
    return _per_param(date_spine(spark, AS_OF, 30), orders)


def _per_param(spine: DataFrame, orders: DataFrame) -> DataFrame:
    """Rows and money per parameter, for parameters without rows too."""
    counted = orders.groupBy("param").agg(F.count("*").alias("n"), money_sum(F.col("o_totalprice")).alias("total"))
    return spine.join(counted, "param", "left").fillna({"n": 0, "total": 0.0})


@query(
    "year_spine",
    """with years as (select cast(y as integer) as param from generate_series(1994, 2003) s(y))
    select param, count(o_orderkey) as n, cast(coalesce(sum(cast(o_totalprice as decimal(38,6))), 0) as double) as total
    from years left join orders on year(o_orderdate) = param group by param""",
)
def _year_spine(spark, folder):
    orders = table(spark, folder, "orders").withColumn("param", F.year("o_orderdate"))
    return _per_param(year_spine(spark, 1994, 2003), orders)


@query(
    "literal_spine",
    """with states(param) as (values ('F'), ('O'), ('X'))
    select param, count(o_orderkey) as n, cast(coalesce(sum(cast(o_totalprice as decimal(38,6))), 0) as double) as total
    from states left join orders on o_orderstatus = param group by param""",
)
def _literal_spine(spark, folder):
    orders = table(spark, folder, "orders").withColumn("param", F.col("o_orderstatus"))
    return _per_param(literal_spine(spark, ["F", "O", "X"]), orders)
