"""Nested landing records to flat staging tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starload.functions.columns import array_columns, lower_names, parse_date
from starload.schemas import PARENT_DATES, PARENT_TABLE, PROJECT_LANDING
from starload.sources.drift import UNKNOWN

PARENT_KEYS = ("idUnico", "dataCadastro")


@dataclass(frozen=True)
class Child:
    """A nested array that becomes a staging table of its own."""

    array: str
    table: str
    dates: tuple[str, ...] = ()


# Nested arrays and the staging tables they feed.
CHILDREN = (
    Child("fontesDeRecurso", "stg_projeto_investimento_fontes_de_recurso"),
    Child("geometrias", "stg_projeto_investimento_geometria", ("dataCriacao", "dataMetadado")),
    Child("subTipos", "stg_projeto_investimento_sub_tipos"),
    Child("tipos", "stg_projeto_investimento_tipos"),
    Child("repassadores", "stg_projeto_investimento_repassadores"),
    Child("executores", "stg_projeto_investimento_executores"),
    Child("tomadores", "stg_projeto_investimento_tomadores"),
    Child("eixos", "stg_projeto_investimento_eixos"),
)


def parse_dates(df: DataFrame, names: tuple[str, ...], strict: bool = False) -> DataFrame:
    present = [name for name in names if name in df.columns]
    return df.withColumns({name: parse_date(F.col(name), strict) for name in present})


def explode_child(
    df: DataFrame, array: str, keys: list[str], schema: T.StructType | None = None
) -> DataFrame:
    """One row per array element: the parent's keys, then the fields of the element.

    Parents whose array is null, empty or, given ``schema``, absent yield no row.
    """
    if array not in df.columns:
        if schema is None:
            raise ValueError(f"no column {array!r}; pass the schema it would have")
        df = df.withColumn(array, F.lit(None).cast(schema[array].dataType))
    return df.select(*keys, F.inline(array))


def drop_arrays(df: DataFrame) -> DataFrame:
    return df.drop(*array_columns(df))


def child_table(df: DataFrame, child: Child, strict_dates: bool = False) -> DataFrame:
    rows = explode_child(df, child.array, list(PARENT_KEYS), PROJECT_LANDING)
    return lower_names(parse_dates(rows, ("dataCadastro", *child.dates), strict_dates))


def parent_table(df: DataFrame, strict_dates: bool = False) -> DataFrame:
    """The records without their arrays; what a reader kept of unknown fields stays in the landed copy."""
    return lower_names(parse_dates(drop_arrays(df).drop(UNKNOWN), PARENT_DATES, strict_dates))


def normalize(
    df: DataFrame, strict_dates: bool = False, only: set[str] | None = None
) -> dict[str, DataFrame]:
    """Staging tables of project landing records, by table name.

    Every table is its own branch over ``df``. Give a columnar table as input, so
    that each branch reads just the array it needs.
    """
    wanted = [child for child in CHILDREN if only is None or child.table in only]
    tables = {child.table: child_table(df, child, strict_dates) for child in wanted}
    if only is None or PARENT_TABLE in only:
        tables[PARENT_TABLE] = parent_table(df, strict_dates)
    return tables
