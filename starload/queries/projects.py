"""The driver tables seen as project landing records, and the project warehouse over them.

Every line item is one landing record of the project named by its order, the way one
project comes back in several files. Records of an order differ in dates, counts and
children, so staging holds many copies per project. Arrays have at most two elements;
some are null, some empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.operators.dedupe import keep_first
from starload.operators.normalize import CHILDREN, normalize
from starload.plans.dimensions import DIMENSIONS, load_dimension, members
from starload.plans.facts import BRIDGES, FUNDING, bridge_fact, funding_fact, project_fact
from starload.plans.snapshots import write_snapshot
from starload.plans.warehouse import STAGING_KEYS, dedupe_staging
from starload.queries.registry import query, table
from starload.schemas import EXECUTION_TABLE, PARENT_TABLE, PROJECT_LANDING
from starload.session import scratch_dir


def _elements(array: str, *rows: tuple[str, ...]) -> str:
    """Array of structs with the fields the landing schema gives it."""
    fields = PROJECT_LANDING[array].dataType.elementType.fields

    def element(row: tuple[str, ...]) -> str:
        pairs = [f"'{f.name}', cast({value} as {f.dataType.simpleString()})" for value, f in zip(row, fields)]
        return f"named_struct({', '.join(pairs)})"

    return f"array({', '.join(element(row) for row in rows)})"


_ISO_ORDERED, _ISO_SHIPPED = "cast(cast(o_orderdate as date) as string)", "cast(cast(l_shipdate as date) as string)"

RECORD = {
    "idUnico": "l_orderkey",
    "dataCadastro": _ISO_ORDERED,
    "nome": "concat('Order ', l_orderkey)",
    "cep": "o_custkey",
    "descricao": "o_orderpriority",
    "funcaoSocial": "l_returnflag",
    "dataInicialPrevista": _ISO_ORDERED,
    "dataFinalPrevista": _ISO_SHIPPED,
    "dataInicialEfetiva": f"case when l_returnflag = 'N' then '' else {_ISO_ORDERED} end",
    "dataFinalEfetiva": f"case when l_returnflag = 'R' then concat({_ISO_SHIPPED}, 'T10:00:00') else {_ISO_SHIPPED} end",
    "especie": "l_linestatus",
    "natureza": "o_orderpriority",
    "situacao": "case when l_returnflag = 'A' then lower(o_orderstatus) else o_orderstatus end",
    "uf": "case when l_tax <> 0 then o_orderstatus end",
    "qdtEmpregosGerados": "case when l_discount = 0 then ' ' else concat(' ', cast(l_quantity as int), ' ') end",
    "populacaoBeneficiada": "l_partkey",
    "isModeladaPorBim": "l_tax > 0.04D",
    "dataSituacao": _ISO_SHIPPED,
    "tomadores": _elements("tomadores", ("o_custkey", "concat('Customer ', o_custkey)")),
    "executores": _elements("executores", ("l_suppkey", "concat('Supplier ', l_suppkey)")),
    "repassadores": "case when l_returnflag = 'R' then {} when l_returnflag = 'N' then cast(array() as {}) end".format(
        _elements("repassadores", ("l_linenumber", "concat('Line ', l_linenumber)")),
        PROJECT_LANDING["repassadores"].dataType.simpleString(),
    ),
    "eixos": _elements("eixos", ("l_linenumber", "concat('Axis ', l_linenumber)")),
    "tipos": _elements("tipos", ("l_suppkey", "concat('Type ', l_suppkey)", "l_linenumber")),
    "subTipos": _elements(
        "subTipos",
        ("l_partkey", "concat('Part ', l_partkey)", "l_suppkey"),
        ("l_partkey", "concat('Part ', l_partkey)", "l_linenumber"),
    ),
    "fontesDeRecurso": _elements(
        "fontesDeRecurso",
        ("o_orderpriority", "l_extendedprice"),
        ("lower(o_orderpriority)", "case when l_tax <> 0 then l_quantity end"),
    ),
    "geometrias": _elements(
        "geometrias",
        ("null", _ISO_ORDERED, f"case when l_returnflag = 'A' then '' else {_ISO_SHIPPED} end",
         "concat('D', l_linenumber)", "null", "null", "null", "null", "l_linestatus", "null"),
    ),
}


def lines_of_orders(spark: SparkSession, folder: str) -> DataFrame:
    """What a landing record is made of: a line item and its order."""
    lines, orders = table(spark, folder, "lineitem"), table(spark, folder, "orders")
    # both sides grow with the data, so neither is ever broadcast
    return lines.hint("merge").join(orders, lines["l_orderkey"] == orders["o_orderkey"])


def as_records(rows: DataFrame, *others: str) -> DataFrame:
    """Landing records of line items and their orders, and other columns of these."""
    return rows.selectExpr(
        *[
            f"cast({RECORD.get(field.name, 'null')} as {field.dataType.simpleString()}) as {field.name}"
            for field in PROJECT_LANDING
        ],
        *others,
    )


def landing(spark: SparkSession, folder: str) -> DataFrame:
    """Landing records with the explicit project schema."""
    return as_records(lines_of_orders(spark, folder))


def execution(spark: SparkSession, folder: str) -> DataFrame:
    """Execution rows: the value of each event, booked on the project named by its user."""
    return table(spark, folder, "events").select(
        F.col("user_id").cast("string").alias("idProjetoInvestimento"),
        F.col("value").alias("valorEmpenho"),
        F.col("event_id").cast("string").alias("numeroNotaEmpenhoGerada"),
        F.year("ts").cast("string").alias("nomearquivo"),
    )


def staging(spark: SparkSession, folder: str, only: set[str] | None = None) -> dict[str, DataFrame]:
    tables = normalize(landing(spark, folder), only=only)
    if only is None or EXECUTION_TABLE in only:
        tables[EXECUTION_TABLE] = execution(spark, folder)
    return tables


def clean_staging(spark: SparkSession, folder: str, only: set[str] | None = None) -> dict[str, DataFrame]:
    return dedupe_staging(staging(spark, folder, only))


def stored(dimension, staging: DataFrame) -> DataFrame:
    """A coded dimension as a load has it, a table whose size is known before a fact is planned.

    Within the plan of a fact its size is an open question, and the rows it codes would be shuffled by its few keys to as few tasks.
    """
    found = load_dimension(dimension, members(dimension, staging, duplicate_nk="pick"))
    return write_snapshot(found, scratch_dir(staging.sparkSession, dimension.table))


def dimension_tables(staged: dict[str, DataFrame], names: set[str]) -> dict[str, DataFrame]:
    return {
        # of a bridge only distinct pairs meet the keys, which costs less than a pass of its own
        d.table: stored(d, staged[d.source]) if d is FUNDING else load_dimension(d, members(d, staged[d.source], duplicate_nk="pick"))
        for d in DIMENSIONS
        if d.table in names
    }


# SQL of the same records, one relation per staging table -------------------------------------------------

_ORDERED = "strftime(o_orderdate, '%Y-%m-%d')"
_SHIPPED = "strftime(l_shipdate, '%Y-%m-%d')"


def _date(text: str) -> str:
    return f"cast(try_strptime({text}, '%Y-%m-%d') as date)"


_KEYS = f"cast(l_orderkey as varchar) as idunico, {_date(_ORDERED)} as datacadastro"
LINES_OF_ORDERS = "from lineitem join orders on l_orderkey = o_orderkey"

STAGING_SQL = {
    PARENT_TABLE: f"""
        select {_KEYS}, 'Order ' || l_orderkey as nome, cast(o_custkey as varchar) as cep,
          cast(null as varchar) as endereco, o_orderpriority as descricao, l_returnflag as funcaosocial,
          cast(null as varchar) as metaglobal, {_date(_ORDERED)} as datainicialprevista,
          {_date(_SHIPPED)} as datafinalprevista,
          case when l_returnflag <> 'N' then {_date(_ORDERED)} end as datainicialefetiva,
          case when l_returnflag <> 'R' then {_date(_SHIPPED)} end as datafinalefetiva,
          l_linestatus as especie, o_orderpriority as natureza, cast(null as varchar) as naturezaoutras,
          case when l_returnflag = 'A' then lower(o_orderstatus) else o_orderstatus end as situacao,
          cast(null as varchar) as descplanonacionalpoliticavinculado,
          case when l_tax <> 0 then o_orderstatus end as uf,
          case when l_discount = 0 then ' ' else ' ' || cast(l_quantity as integer) || ' ' end
            as qdtempregosgerados,
          cast(null as varchar) as descpopulacaobeneficiada, cast(l_partkey as varchar) as populacaobeneficiada,
          cast(null as varchar) as observacoespertinentes, l_tax > 0.04 as ismodeladaporbim,
          {_date(_SHIPPED)} as datasituacao {LINES_OF_ORDERS}""",
    f"{PARENT_TABLE}_tomadores": f"select {_KEYS}, o_custkey as codigo, 'Customer ' || o_custkey as nome {LINES_OF_ORDERS}",
    f"{PARENT_TABLE}_executores": f"select {_KEYS}, l_suppkey as codigo, 'Supplier ' || l_suppkey as nome {LINES_OF_ORDERS}",
    f"{PARENT_TABLE}_repassadores": f"""
        select {_KEYS}, cast(l_linenumber as bigint) as codigo, 'Line ' || l_linenumber as nome {LINES_OF_ORDERS}
        where l_returnflag = 'R'""",
    f"{PARENT_TABLE}_eixos": f"""
        select {_KEYS}, cast(l_linenumber as bigint) as id, 'Axis ' || l_linenumber as descricao {LINES_OF_ORDERS}""",
    f"{PARENT_TABLE}_tipos": f"""
        select {_KEYS}, l_suppkey as id, 'Type ' || l_suppkey as descricao,
          cast(l_linenumber as bigint) as ideixo {LINES_OF_ORDERS}""",
    f"{PARENT_TABLE}_sub_tipos": f"""
        select {_KEYS}, l_partkey as id, 'Part ' || l_partkey as descricao, l_suppkey as idtipo {LINES_OF_ORDERS}
        union all
        select {_KEYS}, l_partkey, 'Part ' || l_partkey, cast(l_linenumber as bigint) {LINES_OF_ORDERS}""",
    f"{PARENT_TABLE}_fontes_de_recurso": f"""
        select {_KEYS}, o_orderpriority as origem, l_extendedprice as valorinvestimentoprevisto {LINES_OF_ORDERS}
        union all
        select {_KEYS}, lower(o_orderpriority), case when l_tax <> 0 then l_quantity end {LINES_OF_ORDERS}""",
    f"{PARENT_TABLE}_geometria": f"""
        select {_KEYS}, cast(null as varchar) as cepareaexecutora, {_date(_ORDERED)} as datacriacao,
          case when l_returnflag <> 'A' then {_date(_SHIPPED)} end as datametadado,
          'D' || l_linenumber as datum, cast(null as varchar) as enderecoareaexecutora,
          cast(null as varchar) as geometria, cast(null as varchar) as infoadicionais,
          cast(null as varchar) as nomeareaexecutora, l_linestatus as origem,
          cast(null as varchar) as paisareaexecutora {LINES_OF_ORDERS}""",
}
EXECUTION_SQL = """
        select distinct cast(user_id as varchar) as idprojetoinvestimento, value as valorempenho,
          cast(event_id as varchar) as numeronotaempenhogerada, cast(year(ts) as varchar) as nomearquivo
        from events"""


def staging_columns(name: str) -> list[str]:
    """Column order of a staging table: keys of the parent first for children, landing order for the parent."""
    if name == PARENT_TABLE:
        return [f.name.lower() for f in PROJECT_LANDING if f.dataType.typeName() != "array"]
    array = next(child.array for child in CHILDREN if child.table == name)
    element = PROJECT_LANDING[array].dataType.elementType
    return ["idunico", "datacadastro", *[f.name.lower() for f in element]]


def clean_sql(name: str) -> str:
    if name not in STAGING_KEYS:
        return STAGING_SQL[name]
    keys = STAGING_KEYS[name]
    order = ", ".join(f"{c} nulls first" for c in staging_columns(name) if c not in keys)
    unknown = " or ".join(f"{key} is null" for key in keys)
    return f"""
        select {', '.join(staging_columns(name))} from (
          select *, row_number() over (partition by {', '.join(keys)} order by {order}) as copy
          from ({STAGING_SQL[name]}) raw) ranked
        where copy = 1 or {unknown}"""


def dimension_sql(dimension) -> str:
    """Members with the least attribute set per key, numbered in the order of the digest of the key."""
    key = f"cast({dimension.nk_source} as varchar)"
    if dimension.fold_case:
        key = f"upper({key})"
    # a natural key of the project dimension occurs once in clean staging, so min() is its value
    attributes = ", ".join(f"min({source}) as {name}" for name, source in dimension.columns.items())
    return f"""
        select cast(row_number() over (order by md5({dimension.nk})) as integer) as {dimension.sk}, grouped.*
        from (select {key} as {dimension.nk}, {attributes} from {dimension.source}
              where {dimension.nk_source} is not null group by 1) grouped"""


def with_relations(staging_names: list[str], dimension_names: list[str], body: str) -> str:
    """A statement over clean staging tables and dimensions, given as common table expressions."""
    by_table = {d.table: d for d in DIMENSIONS}
    names = dict.fromkeys([*staging_names, *[by_table[d].source for d in dimension_names]])
    parts = [f"{n} as ({EXECUTION_SQL if n == EXECUTION_TABLE else clean_sql(n)})" for n in names]
    parts += [f"{d} as ({dimension_sql(by_table[d])})" for d in dimension_names]
    return f"with {', '.join(parts)} {body}"


# Queries -------------------------------------------------------------------------------------------------

def _register_staging(name: str) -> None:
    short = name.removeprefix(f"{PARENT_TABLE}_") if name != PARENT_TABLE else "projeto_investimento"
    select = ", ".join(staging_columns(name))
    query(f"stage_{short}", f"select {select} from ({STAGING_SQL[name]}) raw")(
        lambda spark, folder: staging(spark, folder, {name})[name].select(*staging_columns(name))
    )
    if name in STAGING_KEYS:
        query(f"dedupe_{short}", clean_sql(name))(
            lambda spark, folder: clean_staging(spark, folder, {name})[name].select(*staging_columns(name))
        )


for _name in STAGING_SQL:
    _register_staging(_name)


def _register_dimension(dimension) -> None:
    sql = with_relations([], [dimension.table], f"select * from {dimension.table}")

    def build(spark, folder):
        staged = clean_staging(spark, folder, {dimension.source})[dimension.source]
        return load_dimension(dimension, members(dimension, staged, duplicate_nk="pick"))

    query(dimension.table, sql)(build)


for _dimension in DIMENSIONS:
    _register_dimension(_dimension)

_PROJECT_DIM = "dim_projeto_investimento"


def _fact_tables(
    spark: SparkSession, folder: str, sources: set[str], dimension: str | None = None
) -> dict[str, DataFrame]:
    staged = clean_staging(spark, folder, {PARENT_TABLE, *sources})
    if dimension == FUNDING.table:
        # read twice, by the dimension and by the fact
        staged[FUNDING.source] = write_snapshot(staged[FUNDING.source], scratch_dir(spark, FUNDING.source))
    return {**staged, **dimension_tables(staged, {_PROJECT_DIM, dimension})}


# The SQL of each fact over clean staging and dimensions.
FACT_SQL: dict[str, str] = {}


def _register_bridge(bridge) -> None:
    dimension = next(d for d in DIMENSIONS if d.table == bridge.dimension)
    FACT_SQL[bridge.table] = f"""
        select distinct sk_projeto_investimento, {dimension.sk} from {bridge.source} stg
        join {bridge.dimension} d on d.{dimension.nk} = cast(stg.{bridge.code} as varchar)
        join {_PROJECT_DIM} p on p.nk_projeto_investimento = stg.idunico"""
    sql = with_relations([bridge.source], [_PROJECT_DIM, bridge.dimension], FACT_SQL[bridge.table])
    query(bridge.table, sql)(
        lambda spark, folder: bridge_fact(bridge, _fact_tables(spark, folder, {bridge.source}, bridge.dimension))
    )


for _bridge in BRIDGES:
    _register_bridge(_bridge)

_FUNDING_STG = f"{PARENT_TABLE}_fontes_de_recurso"


FACT_SQL["fact_projeto_investimento_fonte_recurso"] = f"""
        select sk_projeto_investimento, sk_fonte_recurso,
          valorinvestimentoprevisto as valor_investimento_previsto
        from {PARENT_TABLE} stg
        join {_PROJECT_DIM} p on p.nk_projeto_investimento = stg.idunico
        join {_FUNDING_STG} f on f.idunico = stg.idunico
        join dim_fonte_recurso d on d.nk_fonte_recurso = upper(f.origem)"""
FACT_SQL["fact_projeto_investimento"] = f"""
        select sk_projeto_investimento,
          cast(stg.datafinalprevista - stg.datainicialprevista as integer) as prazo_previsto,
          cast(stg.datafinalefetiva - stg.datainicialefetiva as integer) as prazo_efetivo,
          cast(nullif(trim(qdtempregosgerados), '') as integer) as qtd_empregos_gerados,
          cast(nullif(trim(populacaobeneficiada), '') as integer) as pop_beneficiada,
          planned.total as valor_investimento_previsto, coalesce(executed.total, 0) as valor_execucao
        from {PARENT_TABLE} stg
        join {_PROJECT_DIM} p on p.nk_projeto_investimento = stg.idunico
        left join (select idunico, cast(sum(cast(valorinvestimentoprevisto as decimal(38,6))) as double) as total
                   from {_FUNDING_STG} group by 1) planned on planned.idunico = stg.idunico
        left join (select idprojetoinvestimento, cast(sum(cast(valorempenho as decimal(38,6))) as double) as total
                   from {EXECUTION_TABLE} group by 1) executed
          on executed.idprojetoinvestimento = stg.idunico"""


@query(
    "fact_projeto_investimento_fonte_recurso",
    with_relations(
        [PARENT_TABLE, _FUNDING_STG], [_PROJECT_DIM, "dim_fonte_recurso"], FACT_SQL["fact_projeto_investimento_fonte_recurso"]
    ),
)
def _funding(spark: SparkSession, folder: str) -> DataFrame:
    return funding_fact(_fact_tables(spark, folder, {_FUNDING_STG}, "dim_fonte_recurso"))


@query(
    "fact_projeto_investimento",
    with_relations([PARENT_TABLE, _FUNDING_STG, EXECUTION_TABLE], [_PROJECT_DIM], FACT_SQL["fact_projeto_investimento"]),
)
def _main_fact(spark: SparkSession, folder: str) -> DataFrame:
    tables = _fact_tables(spark, folder, {EXECUTION_TABLE})
    # the sum needs no more of a funding row than its key
    keys = STAGING_KEYS[_FUNDING_STG]
    tables[_FUNDING_STG] = keep_first(staging(spark, folder, {_FUNDING_STG})[_FUNDING_STG].select(*keys), keys)
    return project_fact(tables)
