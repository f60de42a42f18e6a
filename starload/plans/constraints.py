"""Keys, references, required columns and text lengths of the warehouse tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.operators.quality import key_violations, null_counts, orphans, too_long
from starload.plans.dimensions import BY_TABLE, DIMENSIONS
from starload.plans.facts import BRIDGES, FUNDING, FUNDING_FACT, MAIN_FACT, PROJECT
from starload.schemas import MAX_LENGTHS, PARENT_TABLE, SMALL_DIM_LENGTH

PRIMARY_KEYS = {
    **{dimension.table: [dimension.sk] for dimension in DIMENSIONS},
    MAIN_FACT: [PROJECT.sk],
    FUNDING_FACT: [PROJECT.sk, FUNDING.sk],
    **{bridge.table: bridge.keys for bridge in BRIDGES},
}
FOREIGN_KEYS = [(MAIN_FACT, PROJECT), (FUNDING_FACT, PROJECT), (FUNDING_FACT, FUNDING)] + [
    pair for bridge in BRIDGES for pair in ((bridge.table, PROJECT), (bridge.table, BY_TABLE[bridge.dimension]))
]
# Columns that may not be null.
REQUIRED = {
    **{d.table: [d.sk, d.nk, "descricao"] for d in DIMENSIONS if d is not PROJECT},
    PROJECT.table: [PROJECT.sk, PROJECT.nk, "data_projeto"],
    **{table: keys for table, keys in PRIMARY_KEYS.items() if table.startswith("fact_")},
    PARENT_TABLE: ["idunico", "datacadastro"],
    f"{PARENT_TABLE}_eixos": ["idunico", "descricao", "id", "datacadastro"],
    f"{PARENT_TABLE}_executores": ["idunico", "nome", "codigo", "datacadastro"],
    f"{PARENT_TABLE}_fontes_de_recurso": ["idunico", "origem", "datacadastro"],
    f"{PARENT_TABLE}_geometria": ["idunico", "datacadastro"],
    f"{PARENT_TABLE}_repassadores": ["idunico", "nome", "codigo", "datacadastro"],
    f"{PARENT_TABLE}_sub_tipos": ["idunico", "descricao", "id", "idtipo", "datacadastro"],
    f"{PARENT_TABLE}_tipos": ["idunico", "descricao", "id", "ideixo", "datacadastro"],
    f"{PARENT_TABLE}_tomadores": ["idunico", "nome", "codigo", "datacadastro"],
}
LENGTHS = {
    **{d.table: {d.nk: SMALL_DIM_LENGTH, "descricao": SMALL_DIM_LENGTH} for d in DIMENSIONS if d is not PROJECT},
    **MAX_LENGTHS,
}


def _report(table: str, check: str, column, found: DataFrame, count) -> DataFrame:
    return found.select(
        F.lit(table).alias("table"), F.lit(check).alias("check"), column.alias("column"), count.alias("violations")
    )


def check_tables(tables: dict[str, DataFrame]) -> DataFrame:
    """Violations found in the given tables: one row per table, check and column, zero if clean."""
    parts = []
    for table, df in tables.items():
        if table in PRIMARY_KEYS:
            keys = PRIMARY_KEYS[table]
            found = key_violations(df, keys).agg(F.count("*").alias("n"))
            parts.append(_report(table, "primary key", F.lit(", ".join(keys)), found, F.col("n")))
        if table in REQUIRED:
            found = null_counts(df, REQUIRED[table])
            parts.append(_report(table, "not null", F.col("column"), found, F.col("nulls")))
        if table in LENGTHS:
            found = too_long(df, LENGTHS[table])
            parts.append(_report(table, "length", F.col("column"), found, F.col("too_long")))
    for table, dimension in FOREIGN_KEYS:
        if table in tables and dimension.table in tables:
            lost = orphans(tables[table], tables[dimension.table], dimension.sk, dimension.sk)
            found = lost.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n"))
            parts.append(_report(table, "foreign key", F.lit(dimension.sk), found, F.col("n")))
    return reduce(DataFrame.unionByName, parts)
