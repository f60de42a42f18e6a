"""Fact specs: one measure fact, one measure bridge and the factless bridges."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.functions.columns import days_between, money_sum, text_to_int
from starload.operators.changes import upsert
from starload.plans.dimensions import BY_TABLE
from starload.schemas import EXECUTION_TABLE, PARENT_TABLE

Tables = dict[str, DataFrame]

PROJECT = BY_TABLE["dim_projeto_investimento"]
FUNDING = BY_TABLE["dim_fonte_recurso"]
FUNDING_TABLE = f"{PARENT_TABLE}_fontes_de_recurso"


@dataclass(frozen=True)
class Bridge:
    """Distinct pairs of a project and a coded dimension."""

    table: str
    source: str
    code: str
    dimension: str

    @property
    def keys(self) -> list[str]:
        return [PROJECT.sk, BY_TABLE[self.dimension].sk]


# Bridge tables, their staging sources and the code that is looked up.
BRIDGES = (
    Bridge("fact_projeto_investimento_eixos", f"{PARENT_TABLE}_eixos", "id", "dim_eixo"),
    Bridge("fact_projeto_investimento_tomadores", f"{PARENT_TABLE}_tomadores", "codigo", "dim_tomador"),
    Bridge("fact_projeto_investimento_executores", f"{PARENT_TABLE}_executores", "codigo", "dim_executor"),
    Bridge("fact_projeto_investimento_repassadores", f"{PARENT_TABLE}_repassadores", "codigo", "dim_repassador"),
    Bridge("fact_projeto_investimento_tipos", f"{PARENT_TABLE}_tipos", "id", "dim_tipo"),
    Bridge("fact_projeto_investimento_sub_tipos", f"{PARENT_TABLE}_sub_tipos", "id", "dim_sub_tipo"),
)
MAIN_FACT = "fact_projeto_investimento"
FUNDING_FACT = "fact_projeto_investimento_fonte_recurso"


def _key_of(dimension, tables: Tables, name: str) -> DataFrame:
    """The two key columns of a dimension, the natural one renamed to join on."""
    return tables[dimension.table].select(F.col(dimension.nk).alias(name), dimension.sk)


def project_fact(tables: Tables, strict_counts: bool = True) -> DataFrame:
    """One row per project: planned and actual days, head counts, planned and executed money.

    Both money tables are summed per project before they are joined. A project without
    planned money keeps null, one without executed money gets zero.
    """
    planned = tables[FUNDING_TABLE].groupBy("idunico").agg(
        money_sum(F.col("valorinvestimentoprevisto")).alias("valor_investimento_previsto")
    )
    executed = (
        tables[EXECUTION_TABLE]
        .groupBy(F.col("idProjetoInvestimento").alias("idunico"))
        .agg(money_sum(F.col("valorEmpenho")).alias("valor_execucao"))
    )
    projects = tables[PARENT_TABLE].join(_key_of(PROJECT, tables, "idunico"), "idunico")
    joined = projects.join(planned, "idunico", "left").join(executed, "idunico", "left")
    return joined.select(
        PROJECT.sk,
        days_between(F.col("datainicialprevista"), F.col("datafinalprevista")).alias("prazo_previsto"),
        days_between(F.col("datainicialefetiva"), F.col("datafinalefetiva")).alias("prazo_efetivo"),
        text_to_int(F.col("qdtempregosgerados"), strict_counts).alias("qtd_empregos_gerados"),
        text_to_int(F.col("populacaobeneficiada"), strict_counts).alias("pop_beneficiada"),
        "valor_investimento_previsto",
        F.coalesce("valor_execucao", F.lit(0.0)).alias("valor_execucao"),
    )


def funding_fact(tables: Tables) -> DataFrame:
    """One row per funding row of a known project; keys may repeat, amounts are not summed."""
    funding = tables[FUNDING_TABLE].select(
        "idunico", F.upper("origem").alias("origem"), "valorinvestimentoprevisto"
    )
    parents = tables[PARENT_TABLE].select("idunico")
    projects = parents.join(_key_of(PROJECT, tables, "idunico"), "idunico")
    sourced = funding.join(_key_of(FUNDING, tables, "origem"), "origem")
    return sourced.join(projects, "idunico").select(
        PROJECT.sk, FUNDING.sk, F.col("valorinvestimentoprevisto").alias("valor_investimento_previsto")
    )


def unique_funding(fact: DataFrame, on_duplicate: str = "error") -> DataFrame:
    """Funding rows with unique keys, as a load needs them: summed, or an error if any repeats."""
    if on_duplicate not in ("error", "sum"):
        raise ValueError(f"unknown duplicate policy {on_duplicate!r}")
    amount = money_sum(F.col("valor_investimento_previsto"))
    if on_duplicate == "error":
        message = F.lit(f"{FUNDING_FACT}: a key occurs more than once")
        amount = F.when(F.count("*") == 1, amount).otherwise(F.raise_error(message))
    return fact.groupBy(PROJECT.sk, FUNDING.sk).agg(amount.alias("valor_investimento_previsto"))


def bridge_fact(bridge: Bridge, tables: Tables) -> DataFrame:
    """Distinct key pairs; rows of unknown projects or codes are dropped.

    Natural keys are unique in both dimensions, so pairs are made distinct before the
    lookups, where repeats still collapse within each task.
    """
    dimension = BY_TABLE[bridge.dimension]
    pairs = tables[bridge.source].select("idunico", F.col(bridge.code).cast("string").alias("_code")).distinct()
    coded = pairs.join(_key_of(dimension, tables, "_code"), "_code")
    return coded.join(_key_of(PROJECT, tables, "idunico"), "idunico").select(*bridge.keys)


def load_fact(found: DataFrame, keys: list[str], current: DataFrame | None = None, delete: bool = False) -> DataFrame:
    """The fact table after a load; a table of keys alone only gains rows."""
    return found if current is None else upsert(current, found, keys, delete=delete)
