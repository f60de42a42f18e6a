"""Dimension specs and their type-1 load with stable surrogate keys."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starload.operators.changes import rows_to_insert
from starload.operators.numbering import assign_surrogates, number_rows
from starload.schemas import PARENT_TABLE


@dataclass(frozen=True)
class Dimension:
    """How the members of a dimension derive from a staging table.

    ``columns`` maps attributes to staging columns. ``fold_case`` makes the natural
    key upper case, for dimensions keyed by a text.
    """

    table: str
    source: str
    sk: str
    nk: str
    nk_source: str
    columns: dict[str, str]
    fold_case: bool = False

    def natural_key(self) -> Column:
        key = F.col(self.nk_source).cast("string")
        return F.upper(key) if self.fold_case else key


def _labelled(name: str, source: str, code: str, label: str, fold_case: bool = False) -> Dimension:
    return Dimension(f"dim_{name}", source, f"sk_{name}", f"nk_{name}", code, {"descricao": label}, fold_case)


_STG = PARENT_TABLE

# Dimension tables, their sources and attributes.
DIMENSIONS = (
    _labelled("eixo", f"{_STG}_eixos", "id", "descricao"),
    _labelled("executor", f"{_STG}_executores", "codigo", "nome"),
    _labelled("fonte_recurso", f"{_STG}_fontes_de_recurso", "origem", "origem", fold_case=True),
    _labelled("repassador", f"{_STG}_repassadores", "codigo", "nome"),
    _labelled("sub_tipo", f"{_STG}_sub_tipos", "id", "descricao"),
    _labelled("tipo", f"{_STG}_tipos", "id", "descricao"),
    _labelled("tomador", f"{_STG}_tomadores", "codigo", "nome"),
    _labelled("uf", _STG, "uf", "uf", fold_case=True),
    _labelled("situacao", _STG, "situacao", "situacao", fold_case=True),
    _labelled("natureza", _STG, "natureza", "natureza", fold_case=True),
    _labelled("especie", _STG, "especie", "especie", fold_case=True),
    Dimension(
        "dim_projeto_investimento",
        _STG,
        "sk_projeto_investimento",
        "nk_projeto_investimento",
        "idunico",
        {
            "data_projeto": "datacadastro",
            "nome_projeto": "nome",
            "cep": "cep",
            "endereco": "endereco",
            "descricao_projeto": "descricao",
            "funcao_social": "funcaosocial",
            "meta_global": "metaglobal",
            "data_inicial_prevista": "datainicialprevista",
            "data_final_prevista": "datafinalprevista",
            "data_inicial_efetiva": "datainicialefetiva",
            "data_final_efetiva": "datafinalefetiva",
            "especie": "especie",
            "natureza": "natureza",
            "natureza_outras": "naturezaoutras",
            "situacao": "situacao",
        },
    ),
)
BY_TABLE = {dimension.table: dimension for dimension in DIMENSIONS}


def members(dimension: Dimension, staging: DataFrame, duplicate_nk: str = "error") -> DataFrame:
    """Natural keys and attributes found in staging; rows without a key are left out.

    ``duplicate_nk`` says what happens if one key has several sets of attributes:
    ``error`` fails the job, ``pick`` takes the least set, ``keep`` gives one row each.
    """
    if duplicate_nk not in ("error", "pick", "keep"):
        raise ValueError(f"unknown duplicate policy {duplicate_nk!r}")
    rows = staging.select(
        dimension.natural_key().alias(dimension.nk),
        *[F.col(source).alias(name) for name, source in dimension.columns.items()],
    ).filter(F.col(dimension.nk).isNotNull())
    if duplicate_nk == "keep":
        return rows.distinct()
    if dimension.nk_source != "idunico":
        # labels repeat in every project: hash aggregation collapses them before anything is sorted
        rows = rows.distinct()
    least, greatest = F.min(F.struct(*dimension.columns)), F.max(F.struct(*dimension.columns))
    if duplicate_nk == "pick":
        return rows.groupBy(dimension.nk).agg(least.alias("_set")).select(dimension.nk, "_set.*")
    message = F.concat(F.lit(f"{dimension.table}: several attribute sets for key "), F.col(dimension.nk))
    only = F.when(F.col("_set").eqNullSafe(F.col("_last")), F.col("_set")).otherwise(F.raise_error(message))
    return (
        rows.groupBy(dimension.nk)
        .agg(least.alias("_set"), greatest.alias("_last"))
        .withColumn("_set", only)
        .select(dimension.nk, "_set.*")
    )


def load_dimension(
    dimension: Dimension, found: DataFrame, current: DataFrame | None = None, delete: bool = False
) -> DataFrame:
    """The dimension after a load: known keys keep their surrogate, new ones get the next.

    ``found`` has one row per natural key. Members that vanished stay unless ``delete``.
    """
    if current is None:
        return assign_surrogates(found, dimension.nk, dimension.sk)
    names = list(dimension.columns)
    fresh = found.select(dimension.nk, F.struct(*names).alias("_fresh"))
    joined = current.join(fresh, dimension.nk, "inner" if delete else "full_outer")
    kept = joined.select(
        dimension.sk,
        dimension.nk,
        *[
            F.when(F.col("_fresh").isNull(), F.col(name)).otherwise(F.col(f"_fresh.{name}")).alias(name)
            for name in names
        ],
    )
    added = rows_to_insert(current.select(dimension.nk), found.select(dimension.nk), [dimension.nk])
    if delete:
        return kept.unionByName(assign_surrogates(found.join(added, dimension.nk), dimension.nk, dimension.sk, current))
    base = F.coalesce(current.agg(F.max(dimension.sk)).scalar(), F.lit(0))
    # one wide join; the bucket counts of the new members come from the keys alone
    numbered = number_rows(kept, [dimension.nk], "_number", only=F.col(dimension.sk).isNull(), counted=added)
    sk = F.coalesce(dimension.sk, (base + F.col("_number")).cast("int")).alias(dimension.sk)
    return numbered.select(sk, dimension.nk, *names)
