"""Dimensions, facts, checks and whole loads over the driver tables."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.functions.columns import MONEY
from starload.functions.suffix import create_suffix_function, suffix_udf, with_suffix
from starload.operators.quality import (
    key_violations, max_lengths, null_counts, orphans, rejected_dates, too_long,
)
from starload.plans.dimensions import BY_TABLE, Dimension, load_dimension, members
from starload.plans.constraints import PRIMARY_KEYS
from starload.plans.facts import BRIDGES, FUNDING, FUNDING_FACT, MAIN_FACT, bridge_fact, funding_fact, project_fact
from starload.plans.snapshots import write_snapshot
from starload.plans.warehouse import STAGING_KEYS, Warehouse, load_report, load_staging, run_by_date, run_by_state
from starload.queries.cleaning import AS_OF, DAYS
from starload.queries.files import landed, landed_execution
from starload.queries.projects import (
    FACT_SQL, LINES_OF_ORDERS, STAGING_SQL, clean_sql, dimension_sql, execution, landing, staging_columns, stored, with_relations,
)
from starload.queries.registry import query, table
from starload.schemas import EXECUTION_TABLE, PARENT_TABLE
from starload.session import scratch_dir
from starload.sources.folders import remove

# Dimension shapes --------------------------------------------------------------------------------------------

_CUSTOMER = Dimension("dim_customer", "customer", "sk_customer", "nk_customer", "c_custkey", {"descricao": "c_name"})
_SEGMENT = Dimension("dim_segment", "customer", "sk_segment", "nk_segment", "label", {"descricao": "label"}, True)
_ORDER = Dimension(
    "dim_order", "orders", "sk_order", "nk_order", "o_orderkey",
    {"customer": "o_custkey", "status": "o_orderstatus", "price": "o_totalprice", "priority": "o_orderpriority"},
)


def _labels(spark: SparkSession, folder: str) -> DataFrame:
    """Market segments in two letter cases."""
    segment = F.col("c_mktsegment")
    return table(spark, folder, "customer").select(
        F.when(F.col("c_acctbal") < 5000, F.lower(segment)).otherwise(segment).alias("label")
    )


@query("dim_code_label", "select distinct cast(c_custkey as varchar) as nk_customer, c_name as descricao from customer")
def _code_label(spark, folder):
    return members(_CUSTOMER, table(spark, folder, "customer"))


@query(
    "dim_upper_label",
    """select distinct upper(c_mktsegment) as nk_segment,
      case when c_acctbal < 5000 then lower(c_mktsegment) else c_mktsegment end as descricao from customer""",
)
def _upper_label(spark, folder):
    return members(_SEGMENT, _labels(spark, folder), duplicate_nk="keep")


@query(
    "dim_upper_label_pick",
    """select upper(c_mktsegment) as nk_segment,
      min(case when c_acctbal < 5000 then lower(c_mktsegment) else c_mktsegment end) as descricao
    from customer group by 1""",
)
def _upper_label_pick(spark, folder):
    return members(_SEGMENT, _labels(spark, folder), duplicate_nk="pick")


@query(
    "dim_wide",
    """select distinct cast(o_orderkey as varchar) as nk_order, o_custkey as customer, o_orderstatus as status,
      o_totalprice as price, o_orderpriority as priority from orders""",
)
def _wide(spark, folder):
    return members(_ORDER, table(spark, folder, "orders"))


@query(
    "dim_surrogate",
    """with first as (select cast(o_orderkey as varchar) as nk, o_orderdate < timestamp '2000-01-01' as early, orders.*
      from orders)
    select cast(case when early then row_number() over (partition by early order by md5(nk))
        else (select count(*) from first where early)
          + row_number() over (partition by early order by md5(nk)) end as integer) as sk_order,
      nk as nk_order, o_custkey as customer, o_orderstatus as status, o_totalprice as price,
      o_orderpriority as priority
    from first""",
)
def _surrogate(spark, folder):
    """Two loads: orders before 2000, then all; the keys of the first load do not change."""
    orders = table(spark, folder, "orders")
    first = load_dimension(_ORDER, members(_ORDER, orders.filter(F.col("o_orderdate") < "2000-01-01")))
    stored = write_snapshot(first, scratch_dir(spark, "dim_surrogate"))
    return load_dimension(_ORDER, members(_ORDER, orders), stored)


# Facts over flat staging: one project per order, children from its line items ---------------------------------

_SUB_TYPES, _EXECUTORS = f"{PARENT_TABLE}_sub_tipos", f"{PARENT_TABLE}_executores"
_FUNDING = f"{PARENT_TABLE}_fontes_de_recurso"


def _day(name: str):
    return F.col(name).cast("date")


def flat_staging(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    orders, lines = table(spark, folder, "orders"), table(spark, folder, "lineitem")
    project = F.col("l_orderkey").cast("string").alias("idunico")
    shipped = lines.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship")
    )
    parents = orders.join(shipped, "o_orderkey", "left").select(
        F.col("o_orderkey").cast("string").alias("idunico"),
        _day("o_orderdate").alias("datainicialprevista"),
        _day("last_ship").alias("datafinalprevista"),
        _day("first_ship").alias("datainicialefetiva"),
        _day("last_ship").alias("datafinalefetiva"),
        F.when(F.col("o_orderstatus") == "P", " ")
        .otherwise(F.concat(F.lit(" "), F.col("o_custkey").cast("string"), F.lit(" ")))
        .alias("qdtempregosgerados"),
        F.col("o_custkey").cast("string").alias("populacaobeneficiada"),
    )
    return {
        PARENT_TABLE: parents,
        _FUNDING: lines.select(
            project,
            F.when(F.col("l_returnflag") == "R", F.lower("l_linestatus")).otherwise(F.col("l_linestatus"))
            .alias("origem"),
            # amounts of four decimals
            (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("valorinvestimentoprevisto"),
        ),
        _SUB_TYPES: lines.select(project, F.col("l_partkey").alias("id"), _name("Part ", "l_partkey")),
        _EXECUTORS: lines.select(project, F.col("l_suppkey").alias("codigo"), _name("Supplier ", "l_suppkey", "nome")),
        EXECUTION_TABLE: table(spark, folder, "events").select(
            F.col("event_id").cast("string").alias("idProjetoInvestimento"), F.col("value").alias("valorEmpenho")
        ),
    }


def _name(prefix: str, code: str, alias: str = "descricao"):
    return F.concat(F.lit(prefix), F.col(code).cast("string")).alias(alias)


_PROJECT_KEYS = Dimension(
    "dim_projeto_investimento", PARENT_TABLE, "sk_projeto_investimento", "nk_projeto_investimento", "idunico",
    {"data_projeto": "datainicialprevista"},
)


def flat_tables(spark: SparkSession, folder: str, *names: str) -> dict[str, DataFrame]:
    tables = flat_staging(spark, folder)
    keys = table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("idunico"), _day("o_orderdate").alias("datainicialprevista")
    )
    tables[_PROJECT_KEYS.table] = load_dimension(_PROJECT_KEYS, members(_PROJECT_KEYS, keys))
    for name in names:
        dimension = BY_TABLE[name]
        source = tables[dimension.source]
        tables[name] = stored(dimension, source) if dimension is FUNDING else load_dimension(dimension, members(dimension, source, "pick"))
    return tables


_PROJECTS_SQL = """projects as (select cast(o_orderkey as varchar) as idunico, o_orderkey, o_custkey, o_orderstatus,
      cast(o_orderdate as date) as ordered,
      cast(row_number() over (order by md5(cast(o_orderkey as varchar))) as integer) as sk from orders)"""


@query(
    "fact_main",
    f"""with {_PROJECTS_SQL},
    lines as (select l_orderkey, cast(min(l_shipdate) as date) as first_ship, cast(max(l_shipdate) as date) as last_ship,
      cast(sum(cast(l_extendedprice * (1 - l_discount) as decimal(38,6))) as double) as planned from lineitem group by 1),
    spent as (select event_id, cast(sum(cast(value as decimal(38,6))) as double) as executed from events group by 1)
    select sk as sk_projeto_investimento, cast(last_ship - ordered as integer) as prazo_previsto,
      cast(last_ship - first_ship as integer) as prazo_efetivo,
      cast(case when o_orderstatus <> 'P' then o_custkey end as integer) as qtd_empregos_gerados,
      cast(o_custkey as integer) as pop_beneficiada, planned as valor_investimento_previsto,
      coalesce(executed, 0) as valor_execucao
    from projects left join lines on l_orderkey = o_orderkey left join spent on event_id = o_orderkey""",
)
def _fact_main(spark, folder):
    return project_fact(flat_tables(spark, folder))


@query(
    "fact_measure_bridge",
    f"""with {_PROJECTS_SQL},
    sources as (select origem, cast(row_number() over (order by md5(origem)) as integer) as sk
      from (select distinct upper(l_linestatus) as origem from lineitem) s)
    select projects.sk as sk_projeto_investimento, sources.sk as sk_fonte_recurso,
      l_extendedprice * (1 - l_discount) as valor_investimento_previsto
    from lineitem join projects on o_orderkey = l_orderkey join sources on origem = upper(l_linestatus)""",
)
def _fact_measure_bridge(spark, folder):
    return funding_fact(flat_tables(spark, folder, "dim_fonte_recurso"))


def _bridge(name: str):
    return next(bridge for bridge in BRIDGES if bridge.dimension == name)


def _pairs_sql(column: str, sk: str) -> str:
    return f"""with {_PROJECTS_SQL},
    codes as (select code, cast(row_number() over (order by md5(cast(code as varchar))) as integer) as sk
      from (select distinct {column} as code from lineitem) c)
    select distinct projects.sk as sk_projeto_investimento, codes.sk as {sk}
    from lineitem join projects on o_orderkey = l_orderkey join codes on code = {column}"""


@query("bridge_part", _pairs_sql("l_partkey", "sk_sub_tipo"))
def _bridge_part(spark, folder):
    return bridge_fact(_bridge("dim_sub_tipo"), flat_tables(spark, folder, "dim_sub_tipo"))


@query("bridge_supplier", _pairs_sql("l_suppkey", "sk_executor"))
def _bridge_supplier(spark, folder):
    return bridge_fact(_bridge("dim_executor"), flat_tables(spark, folder, "dim_executor"))


# Checks -------------------------------------------------------------------------------------------------------

@query(
    "pk_violations",
    "select l_orderkey, l_linenumber, count(*) as copies from lineitem group by 1, 2 having count(*) > 1",
)
def _pk(spark, folder):
    return key_violations(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "fk_orphans",
    """select l_orderkey, count(*) as rows from lineitem
    where not exists (select 1 from orders where o_orderkey = l_orderkey and o_orderdate < timestamp '2000-01-01')
    group by 1""",
)
def _fk(spark, folder):
    early = table(spark, folder, "orders").filter(F.col("o_orderdate") < "2000-01-01")
    return orphans(table(spark, folder, "lineitem"), early, "l_orderkey", "o_orderkey")


@query(
    "null_counts",
    """select 'price' as "column", count(*) filter (l_tax = 0) as nulls from lineitem
    union all select 'shipped', count(*) filter (l_returnflag = 'R') from lineitem
    union all select 'l_orderkey', 0 from lineitem where false
    union all select 'l_orderkey', count(*) filter (l_orderkey is null) from lineitem""",
)
def _nulls(spark, folder):
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey",
        F.when(F.col("l_tax") != 0, F.col("l_extendedprice")).alias("price"),
        F.when(F.col("l_returnflag") != "R", F.col("l_shipdate")).alias("shipped"),
    )
    return null_counts(lines)


@query(
    "too_long",
    """select 'o_orderpriority' as "column", count(*) filter (length(o_orderpriority) > 6) as too_long from orders
    union all select 'o_orderstatus', count(*) filter (length(o_orderstatus) > 1) from orders""",
)
def _too_long(spark, folder):
    return too_long(table(spark, folder, "orders"), {"o_orderpriority": 6, "o_orderstatus": 1})


@query(
    "max_lengths",
    """select 'text' as "column", cast(max(length(text)) as integer) as max_length from documents
    union all select 'lang', cast(max(length(lang)) as integer) from documents
    union all select 'source', cast(max(length(source)) as integer) from documents""",
)
def _max_lengths(spark, folder):
    return max_lengths(table(spark, folder, "documents"))


@query(
    "rejected_dates",
    """select 'dataInicialEfetiva' as "column", count(*) filter (l_returnflag = 'N') as rejected from lineitem
    union all select 'dataFinalEfetiva', count(*) filter (l_returnflag = 'R') from lineitem
    union all select 'dataCadastro', count(*) filter (false) from lineitem""",
)
def _rejected(spark, folder):
    return rejected_dates(landing(spark, folder), ["dataInicialEfetiva", "dataFinalEfetiva", "dataCadastro"])


@query(
    "udf_suffix",
    """select c_custkey, label as by_udf, label as by_expression, label as by_sql from (
      select c_custkey, case when c_mktsegment in ('BUILDING', 'MACHINERY') then c_mktsegment
        else c_mktsegment || 'abc' end as label from customer) c where label <> 'BUILDING'""",
)
def _udf(spark, folder):
    keep, label = ["BUILDING", "MACHINERY"], F.col("c_mktsegment")
    both = table(spark, folder, "customer").select(
        "c_custkey",
        suffix_udf(keep, "abc")(label).alias("by_udf"),
        with_suffix(label, keep, "abc").alias("by_expression"),
        F.expr(f"{create_suffix_function(spark)}(c_mktsegment, array('BUILDING', 'MACHINERY'), 'abc')").alias("by_sql"),
    )
    return both.filter("by_expression != 'BUILDING'")


# Whole loads ----------------------------------------------------------------------------------------------------

_ALL_STAGING = [*STAGING_KEYS, EXECUTION_TABLE]
_ALL_DIMENSIONS = [d.table for d in BY_TABLE.values()]
# every table of a warehouse in one row: how many rows, the sum over its keys, the sum over a digest of each whole row
_KEYS_OF = {name: PRIMARY_KEYS[name] for name in [*_ALL_DIMENSIONS, *FACT_SQL]}
_AMOUNTS = ("valor_investimento_previsto", "valor_execucao")
# The measures of the two facts that have any.
_REST = {
    **{d.table: [d.nk, *d.columns] for d in BY_TABLE.values()},
    MAIN_FACT: ["prazo_previsto", "prazo_efetivo", "qtd_empregos_gerados", "pop_beneficiada", *_AMOUNTS],
    FUNDING_FACT: ["valor_investimento_previsto"],
}


def _text(column: str, text: str) -> str:
    """A column as text, alike in both engines; amounts to a millionth, which no null equals."""
    return f"coalesce(cast({f'cast({column} as {MONEY})' if column in _AMOUNTS else column} as {text}), '~')"


def _row_text(name: str, text: str) -> str:
    return f"concat_ws('|', {', '.join(_text(column, text) for column in [*_KEYS_OF[name], *_REST.get(name, [])])})"


def _summary_sql(name: str, source: str) -> str:
    keys = " + ".join(f"{k + 1} * cast({key} as bigint)" for k, key in enumerate(_KEYS_OF[name]))
    content = f"cast('0x' || substr(md5({_row_text(name, 'varchar')}), 1, 8) as bigint)"
    return f"select '{name}' as name, count(*) as n, cast(sum({keys}) as bigint) as keys, cast(sum({content}) as bigint) as content from {source}"


def _summary(built: dict[str, DataFrame], names: list[str]) -> DataFrame:
    parts = []
    for name in names:
        keys = reduce(add, [(k + 1) * F.col(key).cast("bigint") for k, key in enumerate(_KEYS_OF[name])])
        content = F.conv(F.substring(F.md5(F.expr(_row_text(name, "string"))), 1, 8), 16, 10).cast("bigint")
        parts.append(built[name].agg(F.lit(name).alias("name"), F.count("*").alias("n"), F.sum(keys).alias("keys"), F.sum(content).alias("content")))
    return reduce(DataFrame.unionAll, parts)


def _summaries_sql(names: list[str], staged: dict[str, str] | None = None) -> str:
    """The summaries over all staging and dimensions; ``staged`` replaces the SQL of staging tables."""
    # a load adds up the funding rows of one key
    summed = f"""select sk_projeto_investimento, sk_fonte_recurso, sum(cast(valor_investimento_previsto as decimal(38,6)))
      as valor_investimento_previsto from ({FACT_SQL[FUNDING_FACT]}) f group by 1, 2"""
    facts = ", ".join(f"{name} as ({sql})" for name, sql in {**FACT_SQL, FUNDING_FACT: summed}.items())
    body = " union all ".join(_summary_sql(name, name) for name in names)
    sql = with_relations(_ALL_STAGING, _ALL_DIMENSIONS, f", {facts} {body}")
    for name, other in (staged or {}).items():
        sql = sql.replace(clean_sql(name), other)
    return sql


@query("warehouse_end_to_end", _summaries_sql(list(_KEYS_OF)))
def _end_to_end(spark, folder):
    """JSON landing to staging, then all twelve dimensions and eight facts, summed up."""
    root = scratch_dir(spark, "warehouse")
    projects, booked = f"{root}/landing/projects", f"{root}/landing/execution"
    staging = load_staging(landed(spark, folder, projects).withColumnRenamed("param", "nomeArquivo"), root)
    # the landing files are the query's own; their columnar copy has been written
    remove(spark, projects)
    staging[EXECUTION_TABLE] = landed_execution(spark, folder, booked)
    warehouse = Warehouse(spark, root, grain="year")
    built = warehouse.refresh(staging, duplicate_nk="pick", spent=[f"{root}/landed", booked], on_duplicate="sum")
    return _summary(built, list(_KEYS_OF))


_MOVED_SQL = clean_sql(PARENT_TABLE).replace(
    "o_orderpriority as descricao",
    """case when o_orderdate >= timestamp '2000-01-02' and o_orderdate < timestamp '2001-01-01'
        then lower(o_orderpriority) else o_orderpriority end as descricao""",
)


@query(
    "warehouse_by_date",
    f"""with {PARENT_TABLE} as ({_MOVED_SQL}), dim as ({dimension_sql(BY_TABLE["dim_projeto_investimento"])})
    select sk_projeto_investimento, nk_projeto_investimento, data_projeto, descricao_projeto from dim""",
)
def _by_date(spark, folder):
    """A first load, then a reload of the trailing window with other descriptions; surrogates stay."""
    warehouse = Warehouse(spark, scratch_dir(spark, "warehouse_by_date"), grain="year")
    records = landing(spark, folder)
    project = BY_TABLE["dim_projeto_investimento"]
    only = {PARENT_TABLE}

    def refresh(nested: DataFrame, run: str) -> DataFrame:
        fresh = load_staging(nested, f"{warehouse.root}/{run}", only=only)
        staged = warehouse.reload_by_date(fresh, AS_OF, DAYS)
        # what was clean before is not written again
        staged = warehouse.clean(staged) if warehouse.current(project.table) is None else warehouse.clean_in_place(fresh)
        found = members(project, staged[PARENT_TABLE], duplicate_nk="error")
        return warehouse.replace(project.table, load_dimension(project, found, warehouse.current(project.table)))

    refresh(records, "run1")
    window = F.col("dataCadastro").between("2000-01-02", "2000-12-31")
    again = refresh(records.filter(window).withColumn("descricao", F.lower("descricao")), "run2")
    return again.select("sk_projeto_investimento", "nk_projeto_investimento", "data_projeto", "descricao_projeto")


@query(
    "run_by_date_twice",
    _summaries_sql(list(_KEYS_OF), {PARENT_TABLE: _MOVED_SQL})
    + f""" union all select '{PARENT_TABLE}', count(*), count(*) filter (descricao = lower(descricao)), null from {PARENT_TABLE}""",
)
def _run_by_date_twice(spark, folder):
    """The whole run, and again over the trailing window, whose descriptions have changed; all twenty tables and the parents."""
    warehouse = Warehouse(spark, scratch_dir(spark, "run_by_date_twice"), grain="year")
    records, policy = landing(spark, folder), {"duplicate_nk": "pick", "on_duplicate": "sum"}
    run_by_date(warehouse, records, execution(spark, folder), AS_OF, DAYS, **policy)
    fresh = records.filter(F.col("dataCadastro").between("2000-01-02", "2000-12-31"))
    fresh = fresh.withColumn("descricao", F.lower("descricao"))
    built = run_by_date(warehouse, fresh, execution(spark, folder), AS_OF, DAYS, **policy)
    lower = F.count_if(F.col("descricao") == F.lower("descricao"))
    staged = built[PARENT_TABLE].agg(F.lit(PARENT_TABLE).alias("name"), F.count("*").alias("n"), lower.alias("keys"), F.lit(None).cast("bigint").alias("content"))
    return _summary(built, list(_KEYS_OF)).unionAll(staged)


@query(
    "load_report",
    """select 'no date' as "check", 'dataInicialEfetiva' as name, count(*) filter (l_returnflag = 'N') as rows from lineitem
    union all select 'no date', 'dataFinalEfetiva', count(*) filter (l_returnflag = 'R') from lineitem
    union all select 'no date', unnest(['dataCadastro', 'dataInicialPrevista', 'dataFinalPrevista', 'dataSituacao']), 0
    union all select 'no natural key', 'dim_uf', count(*) filter (l_tax = 0) from lineitem
    union all select 'no natural key', unnest([%s]), 0"""
    % ", ".join(f"'{name}'" for name in _ALL_DIMENSIONS if name != "dim_uf"),
)
def _load_report(spark, folder):
    """What a load of the landing records leaves out, counted as they are landed."""
    return load_report(landing(spark, folder), scratch_dir(spark, "load_report"))


def _staged_text(name: str, text: str) -> str:
    columns = [f"cast({c} as {MONEY})" if c == "valorinvestimentoprevisto" else c for c in staging_columns(name)]
    return "concat_ws('|', " + ", ".join(f"coalesce(cast({c} as {text}), '~')" for c in columns) + ")"


def _by_attr_sql(name: str) -> str:
    """A staging table after the reload of one state: rows of other projects, and what the new extraction holds."""
    chosen = "from (select * from lineitem where l_tax <> 0) l join (select * from orders where o_orderstatus = 'P') o on l_orderkey = o_orderkey"
    fresh = STAGING_SQL[name].replace(LINES_OF_ORDERS, chosen)
    # of the parents the rows of the state itself go, of the children those of projects with such a row
    kept = "s.uf is distinct from 'P'" if name == PARENT_TABLE else "not exists (select 1 from parent where parent.idunico = s.idunico and uf = 'P')"
    columns = ", ".join(staging_columns(name))
    content = f"cast('0x' || substr(md5({_staged_text(name, 'varchar')}), 1, 8) as bigint)"
    return f"""select '{name}' as name, count(*) as n, cast(sum({content}) as bigint) as content
      from (select {columns} from ({STAGING_SQL[name]}) s where {kept} union all select {columns} from ({fresh}) f) rows"""


@query("warehouse_by_attr", f"with parent as ({STAGING_SQL[PARENT_TABLE]}) " + " union all ".join(_by_attr_sql(name) for name in STAGING_SQL))
def _by_attr(spark, folder):
    """Projects of one state are replaced by a new extraction; all their children go with them. Every staging table, summed up."""
    warehouse = Warehouse(spark, scratch_dir(spark, "warehouse_by_attr"), grain="year")
    records = landing(spark, folder)
    warehouse.replace_all(load_staging(records, f"{warehouse.root}/run1"))
    remove(spark, f"{warehouse.root}/run1")
    after = run_by_state(warehouse, records.filter("uf = 'P'"), ["P"])
    parts = []
    for name in STAGING_SQL:
        content = F.conv(F.substring(F.md5(F.expr(_staged_text(name, "string"))), 1, 8), 16, 10).cast("bigint")
        parts.append(after[name].agg(F.lit(name).alias("name"), F.count("*").alias("n"), F.sum(content).alias("content")))
    return reduce(DataFrame.unionAll, parts)
