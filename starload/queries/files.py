"""Sources and sinks over the driver tables: landing files, lineage, pages, request logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starload.functions.columns import parse_date
from starload.operators.audit import audit_requests
from starload.operators.normalize import drop_arrays, explode_child
from starload.queries.projects import LINES_OF_ORDERS as _FROM, as_records, execution, landing, lines_of_orders
from starload.queries.registry import query, table
from starload.schemas import EXECUTION_LANDING, LINEAGE, PROJECT_LANDING
from starload.session import scratch_dir
from starload.sources.drift import evolved, read_json, read_records, unknown_fields
from starload.sources.files import (
    file_lineage, file_lineage_fixed, read_all_json, read_chosen_json, read_csv_text, read_required_json, write_parquet,
)
from starload.sources.folders import matching, place
from starload.sources.landing import land_json, read_landed
from starload.sources.paged import Limits, request_plan

# Landing files -------------------------------------------------------------------------------------------

_ORDER_FIELDS = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_custkey", T.LongType()),
        T.StructField("o_orderstatus", T.StringType()),
        T.StructField("o_totalprice", T.DoubleType()),
    ]
)


def _json_files(spark: SparkSession, folder: str, label: str) -> str:
    """Orders as one ``<year>.json`` for each year, and a file of no records."""
    orders = table(spark, folder, "orders").withColumn("param", F.year("o_orderdate").cast("string"))
    path = scratch_dir(spark, label)
    orders.select(*_ORDER_FIELDS.names, "param").repartition("param").write.partitionBy("param").json(f"{path}/parts")
    orders.limit(1).select(F.lit("[]")).coalesce(1).write.text(f"{path}/parts/param=2031")
    for part in matching(spark, f"{path}/parts/param=*/part-*"):
        fs, target = place(spark, f"{path}/{part.getParent().getName().removeprefix('param=')}.json")
        fs.rename(part, target)
    return path


_FILES_SQL = "select o_orderkey, o_custkey, o_orderstatus, o_totalprice, cast(year(o_orderdate) as varchar) as param from orders"


@query("scan_file_list", f"{_FILES_SQL} where year(o_orderdate) in (1996, 1998, 2000)")
def _scan_file_list(spark, folder):
    """Some of the landed years; 2030 was never landed and is skipped, 2031 has no records."""
    chosen = read_chosen_json(spark, _json_files(spark, folder, "scan_file_list"), [1996, 1998, 2000, 2030, 2031], _ORDER_FIELDS)
    return chosen.withColumn("param", file_lineage())


@query("scan_required_file", f"{_FILES_SQL} where year(o_orderdate) = 1997")
def _scan_required_file(spark, folder):
    path = f"{_json_files(spark, folder, 'scan_required_file')}/1997.json"
    return read_required_json(spark, path, _ORDER_FIELDS).withColumn("param", file_lineage())


@query("scan_all_files", _FILES_SQL)
def _scan_all_files(spark, folder):
    return read_all_json(spark, _json_files(spark, folder, "scan_all_files"), _ORDER_FIELDS).withColumn("param", file_lineage())


@query("scan_empty_file", f"{_FILES_SQL} where false")
def _scan_empty_file(spark, folder):
    """A landing file without a record gives no row, and keeps the schema."""
    empty = read_chosen_json(spark, _json_files(spark, folder, "scan_empty_file"), [2031], _ORDER_FIELDS)
    return empty.withColumn("param", file_lineage())


@query(
    "landing_replace",
    """select event_id, user_id, event_type as param,
      case when event_type in ('click', 'error') then value + 1 else value end as value from events
    where event_type <> 'signup'""",
)
def _landing_replace(spark, folder):
    events = table(spark, folder, "events").select(
        "event_id", "user_id", "value", F.col("event_type").alias("param")
    )
    path = scratch_dir(spark, "landing_replace")
    land_json(events, path)
    again = events.filter(F.col("param").isin("click", "error")).withColumn("value", F.col("value") + 1)
    # the new extraction of signup succeeded without a record
    land_json(again, path, params=["click", "error", "signup"])
    return read_landed(spark, path, T.StructType.fromDDL("event_id bigint, user_id bigint, value double"))


@query("lineage_regex", "select o_orderkey, 'orders' as nomearquivo from orders")
def _lineage(spark, folder):
    return table(spark, folder, "orders").select("o_orderkey", file_lineage("parquet").alias("nomearquivo"))


@query("lineage_substring", "select o_orderkey, 'orders' as nomearquivo from orders")
def _lineage_fixed(spark, folder):
    return table(spark, folder, "orders").select("o_orderkey", file_lineage_fixed(-14, 6).alias("nomearquivo"))


@query(
    "csv_to_parquet",
    """select cast(c_custkey as varchar) as c_custkey, c_name, cast(c_nationkey as varchar) as c_nationkey,
      cast(c_acctbal as varchar) as c_acctbal, c_mktsegment from customer""",
)
def _csv_to_parquet(spark, folder):
    path = scratch_dir(spark, "csv_to_parquet")
    table(spark, folder, "customer").write.option("header", True).csv(f"{path}/csv")
    write_parquet(read_csv_text(spark, f"{path}/csv"), f"{path}/parquet")
    return spark.read.parquet(f"{path}/parquet")


# Nested records, written as JSON and read back with the explicit schema --------------------------------------

def _by_year(spark: SparkSession, folder: str) -> DataFrame:
    """Line items with their order and its year; the records made of them are many times as wide."""
    return lines_of_orders(spark, folder).withColumn("param", F.year("o_orderdate").cast("string"))


def landed(spark: SparkSession, folder: str, path: str | None = None) -> DataFrame:
    """Landing records after a round trip through JSON files, one folder per registration year."""
    path = path or scratch_dir(spark, "landed")
    land_json(_by_year(spark, folder), path, compression="gzip", make=lambda rows: as_records(rows, "param"))
    return read_landed(spark, path, PROJECT_LANDING)


def landed_execution(spark: SparkSession, folder: str, path: str) -> DataFrame:
    """Execution rows after a round trip through JSON files, one folder per file year, which is their lineage."""
    land_json(execution(spark, folder), path, LINEAGE, compression="gzip")
    return read_landed(spark, path, EXECUTION_LANDING, param=LINEAGE)


# Fields of newer records that the schema does not know ---------------------------------------------------------

def _newer(spark: SparkSession, folder: str) -> str:
    """Landing files whose records have fields of their own: some a text, some an object, all one more in every axis."""

    def newer(rows: DataFrame) -> DataFrame:
        return as_records(rows, "param").withColumns({
            "novo": F.when(F.col("descricao").startswith("1"), F.col("descricao")),
            "contrato": F.when(F.col("isModeladaPorBim"), F.struct(F.lit(True).alias("ativo"), F.col("populacaoBeneficiada").cast("bigint").alias("numero"))),
            "eixos": F.transform("eixos", lambda e: e.withField("peso", 2 * e["id"])),
        })

    path = scratch_dir(spark, "newer")
    land_json(_by_year(spark, folder), path, compression="gzip", make=newer)
    return path


_NEWER_SQL = """select json_merge_patch(json_object('idUnico', l_orderkey),
      case when o_orderpriority like '1%' then json_object('novo', o_orderpriority) else json('{}') end,
      case when l_tax > 0.04 then json_object('contrato', json_object('ativo', true, 'numero', l_partkey)) else json('{}') end,
      json_object('eixos', [json_object('id', l_linenumber, 'descricao', 'Axis', 'peso', 2 * l_linenumber)])) as j
    from lineitem join orders on l_orderkey = o_orderkey"""


@query(
    "schema_drift",
    f"""with records as ({_NEWER_SQL}),
    fields as (
      select k as path, json_type(j, '$.' || k) as t from (select j, unnest(json_keys(j)) as k from records) top
      union all
      select 'eixos[].' || k, json_type(j, '$.eixos[0].' || k) from (select j, unnest(json_keys(j, '$.eixos[0]')) as k from records) axes)
    select path, case any_value(t) when 'VARCHAR' then 'STRING' when 'OBJECT' then 'OBJECT<ativo: BOOLEAN, numero: BIGINT>' else 'BIGINT' end as kind,
      count(*) as occurrences, count(*) as records
    from fields where path not in ('idUnico', 'eixos', 'eixos[].id', 'eixos[].descricao') group by path""",
)
def _schema_drift(spark, folder):
    return unknown_fields(read_records(spark, _newer(spark, folder), partition="param"), PROJECT_LANDING)


@query(
    "landing_evolved",
    f"""with records as ({_NEWER_SQL})
    select j->>'$.idUnico' as idUnico, j->>'$.novo' as novo, cast(j->'$.contrato.numero' as bigint) as numero,
      cast(j->'$.eixos[0].peso' as bigint) as peso from records""",
)
def _landing_evolved(spark, folder):
    """The same files read with the schema that their report leads to, which leaves nothing unknown."""
    path = _newer(spark, folder)
    schema = evolved(PROJECT_LANDING, unknown_fields(read_records(spark, path, partition="param"), PROJECT_LANDING))
    records = read_json(spark, path, schema, "error", partition="param")
    return records.select("idUnico", "novo", "contrato.numero", F.get("eixos", 0)["peso"].alias("peso"))


_RAW_KEYS = "cast(l_orderkey as varchar) as idUnico, strftime(o_orderdate, '%Y-%m-%d') as dataCadastro"


@query(
    "explode_child",
    f"""select {_RAW_KEYS}, o_orderpriority as origem, l_extendedprice as valorInvestimentoPrevisto {_FROM}
    union all select {_RAW_KEYS}, lower(o_orderpriority), case when l_tax <> 0 then l_quantity end {_FROM}""",
)
def _explode_child(spark, folder):
    return explode_child(landed(spark, folder), "fontesDeRecurso", ["idUnico", "dataCadastro"])


@query(
    "explode_star",
    f"""select {_RAW_KEYS}, l_suppkey as id, 'Type ' || l_suppkey as descricao,
      cast(l_linenumber as bigint) as idEixo {_FROM}""",
)
def _explode_star(spark, folder):
    return landing(spark, folder).select("idUnico", "dataCadastro", F.explode("tipos").alias("e")).select(
        "idUnico", "dataCadastro", "e.*"
    )


@query(
    "explode_absent_array",
    f"""select {_RAW_KEYS}, cast(l_linenumber as bigint) as codigo, 'Line ' || l_linenumber as nome {_FROM}
    where false""",
)
def _explode_absent(spark, folder):
    records = landing(spark, folder).drop("repassadores")
    return explode_child(records, "repassadores", ["idUnico", "dataCadastro"], PROJECT_LANDING)


@query(
    "lateral_view",
    f"""select cast(l_orderkey as varchar) as idUnico, l_partkey as id, 'Part ' || l_partkey as descricao,
      l_suppkey as idTipo {_FROM}
    union all select cast(l_orderkey as varchar), l_partkey, 'Part ' || l_partkey,
      cast(l_linenumber as bigint) {_FROM}""",
)
def _lateral_view(spark, folder):
    landing(spark, folder).createOrReplaceTempView("starload_landing")
    return spark.sql("select idUnico, e.* from starload_landing lateral view explode(subTipos) t as e")


_DAY, _SHIP = "strftime(o_orderdate, '%Y-%m-%d')", "strftime(l_shipdate, '%Y-%m-%d')"
_NO_TEXT = "cast(null as varchar)"


@query(
    "drop_arrays",
    f"""select {_RAW_KEYS}, 'Order ' || l_orderkey as nome, cast(o_custkey as varchar) as cep, {_NO_TEXT} as endereco,
      o_orderpriority as descricao, l_returnflag as funcaoSocial, {_NO_TEXT} as metaGlobal,
      {_DAY} as dataInicialPrevista, {_SHIP} as dataFinalPrevista,
      case when l_returnflag = 'N' then '' else {_DAY} end as dataInicialEfetiva,
      case when l_returnflag = 'R' then {_SHIP} || 'T10:00:00' else {_SHIP} end as dataFinalEfetiva,
      l_linestatus as especie, o_orderpriority as natureza, {_NO_TEXT} as naturezaOutras,
      case when l_returnflag = 'A' then lower(o_orderstatus) else o_orderstatus end as situacao,
      {_NO_TEXT} as descPlanoNacionalPoliticaVinculado, case when l_tax <> 0 then o_orderstatus end as uf,
      case when l_discount = 0 then ' ' else ' ' || cast(l_quantity as integer) || ' ' end as qdtEmpregosGerados,
      {_NO_TEXT} as descPopulacaoBeneficiada, cast(l_partkey as varchar) as populacaoBeneficiada,
      {_NO_TEXT} as observacoesPertinentes, l_tax > 0.04 as isModeladaPorBim, {_SHIP} as dataSituacao {_FROM}""",
)
def _drop_arrays(spark, folder):
    return drop_arrays(landing(spark, folder))


_TEXT_DATE = """case when o_orderstatus = 'F' then strftime(o_orderdate, '%Y-%m-%d')
    when o_orderstatus = 'O' then strftime(o_orderdate, '%Y-13-%d') else '' end"""


@query("parse_dates", f"select o_orderkey, cast(try_strptime({_TEXT_DATE}, '%Y-%m-%d') as date) as parsed from orders")
def _parse_dates(spark, folder):
    day = F.col("o_orderdate").cast("date").cast("string")
    text = (
        F.when(F.col("o_orderstatus") == "F", day)
        .when(F.col("o_orderstatus") == "O", F.concat(F.substring(day, 1, 4), F.lit("-13-"), F.substring(day, 9, 2)))
        .otherwise("")
    )
    return table(spark, folder, "orders").select("o_orderkey", parse_date(text).alias("parsed"))


# Extraction -------------------------------------------------------------------------------------------

@query(
    "request_plan",
    """with sizes as (select strftime(o_orderdate, '%Y-%m-%d') as param, count(*) as n from orders group by 1)
    select param, cast(p as integer) as page,
      'https://example.org/projects?pagina=' || p || '&tamanhoDaPagina=2&dataCadastro=' || param as url
    from (select param, unnest(generate_series(0, cast(ceil(n / 2) as bigint))) as p from sizes) pages""",
)
def _request_plan(spark, folder):
    """Requests that fetch every order by date: its full pages and the empty one that ends them."""
    day = F.col("o_orderdate").cast("date").cast("string")
    sizes = table(spark, folder, "orders").groupBy(day.alias("param")).agg(F.count("*").alias("n"))
    pages = (F.ceil(F.col("n") / 2) + 1).cast("int")
    spine = sizes.select("param", pages.alias("pages"))
    return request_plan(spine, "https://example.org", "/projects", "dataCadastro", F.col("pages"), page_size=2)


@query(
    "request_audit",
    """with log as (select user_id, event_id % 2 as reader, ts, event_type <> 'error' as ok,
      event_type = 'purchase' as is_end from events),
    placed as (select *, sum(case when ok then 1 else 0 end) over (partition by user_id, reader order by ts) as run from log),
    runs as (select user_id, reader, run, count(*) as n from placed where not ok group by 1, 2, 3),
    longest as (select user_id, max(n) as longest from runs group by 1),
    readers as (select user_id, reader, arg_max(is_end, ts) as finished from log group by 1, 2),
    ends as (select user_id, bool_and(finished) as finished from readers group by 1),
    counted as (select user_id, count(*) filter (ok and not is_end) as pages,
      count(*) filter (not is_end) as executions, count(*) filter (not ok) as errors from log group by 1)
    select user_id, pages, executions, errors, coalesce(longest, 0) as max_consecutive_errors,
      case when finished then 'success' when coalesce(longest, 0) >= 3 then 'consecutive errors exceeded'
        when errors >= 18 then 'total errors exceeded' when executions >= 60 then 'executions exceeded'
        else 'incomplete' end as outcome
    from counted left join longest using (user_id) join ends using (user_id)""",
)
def _request_audit(spark, folder):
    """Events as a request log: one log per user, fetched by two readers; an error is a failed request, a purchase an end."""
    return audit_requests(
        table(spark, folder, "events").withColumn("reader", F.col("event_id") % 2),
        "user_id",
        "ts",
        succeeded=F.col("event_type") != "error",
        is_end=F.col("event_type") == "purchase",
        chunk=F.datediff(F.col("ts"), F.lit("1970-01-01")) * 24 + F.hour("ts"),
        limits=Limits(errors=18, consecutive_errors=3, executions=60),
        reader="reader",
    )
