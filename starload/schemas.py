"""Explicit schemas for landing records and column lists of the warehouse.

Reading with these schemas instead of inference avoids an extra pass over the
JSON and keeps arrays typed even when every record leaves them empty.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


def _array_of(*fields: tuple[str, T.DataType]) -> T.ArrayType:
    return T.ArrayType(T.StructType([T.StructField(name, kind) for name, kind in fields]))


# Field, table and column names of the project data model.
_PARTY = _array_of(("codigo", T.LongType()), ("nome", T.StringType()))

PROJECT_LANDING = T.StructType(
    _strings(
        "idUnico", "dataCadastro", "nome", "cep", "endereco", "descricao", "funcaoSocial", "metaGlobal",
        "dataInicialPrevista", "dataFinalPrevista", "dataInicialEfetiva", "dataFinalEfetiva",
        "especie", "natureza", "naturezaOutras", "situacao", "descPlanoNacionalPoliticaVinculado", "uf",
        "qdtEmpregosGerados", "descPopulacaoBeneficiada", "populacaoBeneficiada", "observacoesPertinentes",
    )
    + [T.StructField("isModeladaPorBim", T.BooleanType())]
    + _strings("dataSituacao")
    + [
        T.StructField("tomadores", _PARTY),
        T.StructField("executores", _PARTY),
        T.StructField("repassadores", _PARTY),
        T.StructField("eixos", _array_of(("id", T.LongType()), ("descricao", T.StringType()))),
        T.StructField(
            "tipos",
            _array_of(("id", T.LongType()), ("descricao", T.StringType()), ("idEixo", T.LongType())),
        ),
        T.StructField(
            "subTipos",
            _array_of(("id", T.LongType()), ("descricao", T.StringType()), ("idTipo", T.LongType())),
        ),
        T.StructField(
            "fontesDeRecurso",
            _array_of(("origem", T.StringType()), ("valorInvestimentoPrevisto", T.DoubleType())),
        ),
        T.StructField(
            "geometrias",
            _array_of(
                *[
                    (name, T.StringType())
                    for name in (
                        "cepAreaExecutora", "dataCriacao", "dataMetadado", "datum", "enderecoAreaExecutora",
                        "geometria", "infoAdicionais", "nomeAreaExecutora", "origem", "paisAreaExecutora",
                    )
                ]
            ),
        ),
    ]
)

EXECUTION_LANDING = T.StructType(
    [
        T.StructField(name, T.LongType())
        for name in ("codigoAmparoLegal", "pagina", "tamanhoDaPagina", "ugResponsavel")
    ]
    + [T.StructField("valorEmpenho", T.DoubleType())]
    + _strings(
        "autorEmenda", "descricaoEmpenho", "fonteRecurso", "idProjetoInvestimento", "informacoesComplementares",
        "localEntrega", "naturezaDespesa", "nomeEsferaOrcamentaria", "nomeFavorecido", "nomeTipoEmpenho",
        "nrPtres", "numeroNotaEmpenhoGerada", "numeroProcesso", "planoInterno", "planoOrcamentario",
        "resultadoPrimario", "tipoCredito", "ugEmitente", "unidadeOrcamentaria",
    )
)

LINEAGE = "nomearquivo"
PARENT_TABLE = "stg_projeto_investimento"
EXECUTION_TABLE = "stg_execucao_financeira"

PARENT_DATES = (
    "dataCadastro", "dataInicialPrevista", "dataFinalPrevista",
    "dataInicialEfetiva", "dataFinalEfetiva", "dataSituacao",
)

# Longest text each varchar(n) column may hold.
MAX_LENGTHS = {
    "stg_projeto_investimento_tipos": {"idunico": 255, "descricao": 255},
    "dim_projeto_investimento": {
        "nk_projeto_investimento": 100, "cep": 50, "especie": 50, "natureza": 255, "situacao": 50,
    },
}
SMALL_DIM_LENGTH = 255
