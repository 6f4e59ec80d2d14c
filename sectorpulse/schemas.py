"""Layouts of the raw files and schemas of the typed tables (FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import types as T

# Positional layouts of the headerless raw files, in file order.
ESTABLISHMENT_LAYOUT = (
    "cnpj_basico", "cnpj_ordem", "cnpj_dv", "identificador_matriz_filial",
    "nome_fantasia", "situacao_cadastral", "data_situacao_cadastral",
    "motivo_situacao_cadastral", "nome_cidade_exterior", "pais",
    "data_inicio_atividade", "cnae_principal", "cnae_secundario",
    "tipo_logradouro", "logradouro", "numero", "complemento", "bairro",
    "cep", "uf", "codigo_municipio", "ddd_1", "telefone_1", "ddd_2",
    "telefone_2", "ddd_fax", "fax", "email", "situacao_especial",
    "data_situacao_especial",
)
COMPANY_LAYOUT = (
    "cnpj_basico", "razao_social", "natureza_juridica",
    "qualificacao_responsavel", "capital_social", "porte", "ente_federativo",
)
MUNICIPALITY_LAYOUT = ("codigo_municipio", "nome")
CODE_LAYOUT = ("codigo", "descricao")  # sectors and legal natures

# The typed establishment columns kept by the transform, in
# order, with the one rename applied after the selection.
ESTABLISHMENT_FINAL = (
    "cnpj", "cnpj_basico", "nome_fantasia", "situacao_cadastral",
    "data_situacao", "data_inicio_atividade", "cnae_principal",
    "codigo_municipio", "logradouro", "numero", "bairro", "cep",
    "telefone_1", "email",
)
ESTABLISHMENT_RENAME = {"telefone_1": "telefone"}
COMPANY_FINAL = ("cnpj_basico", "razao_social", "natureza_juridica", "porte", "capital_social")

# Fixed value: columns of the lead export, header text in file order.
EXPORT_HEADER = ("CNPJ", "Razão Social", "Setor", "Município", "Data de Abertura", "Telefone")


def all_string(layout) -> T.StructType:
    """Raw files are read with every column as STRING (no inference)."""
    return T.StructType([T.StructField(n, T.StringType(), True) for n in layout])


GROWTH_STATS = T.StructType([
    T.StructField("cnae_codigo", T.StringType(), True),
    T.StructField("codigo_municipio", T.StringType(), True),
    T.StructField("ano_mes", T.DateType(), True),
    T.StructField("total_aberturas", T.IntegerType(), True),
    T.StructField("variacao_pct", T.DecimalType(6, 2), True),
])

# Columns of a stored enrichment row.
ENRICHMENT = T.StructType([
    T.StructField("cnpj", T.StringType(), True),
    T.StructField("place_id", T.StringType(), True),
    T.StructField("endereco_formatado", T.StringType(), True),
    T.StructField("telefone_places", T.StringType(), True),
    T.StructField("website", T.StringType(), True),
    T.StructField("rating_google", T.DecimalType(2, 1), True),
    T.StructField("total_avaliacoes", T.IntegerType(), True),
])

ENRICHMENT_STORED = T.StructType(ENRICHMENT.fields + [T.StructField("enriquecido_em", T.TimestampType(), True)])

# Place search result fields read from a candidate's JSON payload.
PLACE_PAYLOAD = T.StructType([
    T.StructField("id", T.StringType(), True),
    T.StructField("formattedAddress", T.StringType(), True),
    T.StructField("internationalPhoneNumber", T.StringType(), True),
    T.StructField("websiteUri", T.StringType(), True),
    T.StructField("rating", T.DoubleType(), True),
    T.StructField("userRatingCount", T.IntegerType(), True),
])

# Fixed value: a place search's response.
PLACE_RESPONSE = T.StructType([T.StructField("places", T.ArrayType(PLACE_PAYLOAD), True)])

INSIGHT_ROW = T.StructType([
    T.StructField("setor", T.StringType(), True),
    T.StructField("municipio", T.StringType(), True),
    T.StructField("total_aberturas", T.IntegerType(), True),
    T.StructField("variacao_pct", T.StringType(), True),
])
# Fixed value: the one key of the snapshot.
SNAPSHOT_KEY = "top_setores_crescimento_rmpa"
INSIGHT_SNAPSHOT = T.StructType([T.StructField(SNAPSHOT_KEY, T.ArrayType(INSIGHT_ROW), True)])

# NOT NULL columns of the eight tables, keys included.
NOT_NULL = {
    "municipios": ("codigo_municipio", "nome", "uf"),
    "cnaes": ("codigo", "descricao"),
    "natureza_juridica": ("codigo", "descricao"),
    "empresas": ("cnpj_basico", "razao_social", "criado_em"),
    "estabelecimentos": ("cnpj", "cnpj_basico", "situacao_cadastral", "data_inicio_atividade", "codigo_municipio",
                         "criado_em"),
    "estatisticas_crescimento": ("cnae_codigo", "codigo_municipio", "ano_mes", "total_aberturas"),
    "leads_enriquecidos": ("cnpj", "enriquecido_em"),
    "insights_ia": ("id", "titulo", "conteudo", "baseado_em", "modelo", "gerado_em"),
}
# NOT NULL columns that the database fills when a row does not list them.
NOT_NULL_DEFAULTS = {"uf": "RS", "criado_em": "now()", "total_aberturas": 0, "enriquecido_em": "now()", "gerado_em": "now()"}
