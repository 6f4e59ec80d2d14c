"""Dashboard datasets (R7): chart rows, axis bound and the KPI record."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import (CHART_LABEL_WIDTH, EMPTY_MARK, KPI_LABEL_WIDTH, LEADS_PAGE,
                         MUNICIPALITY_FALLBACK, SECTOR_FALLBACK, STATUS_ACTIVE)
from ..functions.fmt import format_int_br, format_variation, growth_direction
from ..functions.growth_math import axis_bound
from ..functions.text import truncate_label


def growth_chart(ranking: DataFrame) -> DataFrame:
    """Label, full label, municipality, value, openings."""
    full = F.coalesce(F.col("cnaes.descricao"), F.concat(F.lit(SECTOR_FALLBACK), F.col("cnae_codigo").cast("string")))
    value = F.coalesce(F.col("variacao_pct"), F.lit(0).cast("decimal(6,2)"))
    return ranking.select(
        "posicao",
        truncate_label(full, CHART_LABEL_WIDTH).alias("setor"),
        full.alias("setor_completo"),
        F.coalesce(F.col("municipios.nome"),
                   F.concat(F.lit(MUNICIPALITY_FALLBACK), F.col("codigo_municipio").cast("string"))).alias("municipio"),
        value.alias("variacao_pct"),
        F.col("total_aberturas"),
        growth_direction(value).alias("direcao"),
        format_variation(value).alias("rotulo"))


def growth_axis_bound(chart: DataFrame) -> DataFrame:
    """One row, the upper end of the value axis."""
    return chart.agg(axis_bound("variacao_pct").alias("eixo_max"))


def dashboard_kpis(establishments: DataFrame, ranking: DataFrame, page: int = LEADS_PAGE) -> DataFrame:
    """Total establishments, top sector and its variation,
    municipalities covered (counted, not a literal), leads on the page (active
    establishments, counted up to the page size).

    One aggregate over the union of the establishments (municipality and
    status only) and the top ranking row: one pass, no join, no subquery."""
    mun_type = establishments.schema["codigo_municipio"].dataType
    est = establishments.select(
        F.col("codigo_municipio"), F.lit(None).cast("string").alias("descricao"),
        F.lit(None).cast("decimal(6,2)").alias("variacao_pct"), F.lit(True).alias("is_est"),
        (F.col("situacao_cadastral") == STATUS_ACTIVE).alias("is_lead"))
    top = ranking.where(F.col("posicao") == 1).select(
        F.lit(None).cast(mun_type).alias("codigo_municipio"), F.col("cnaes.descricao").alias("descricao"),
        F.col("variacao_pct").cast("decimal(6,2)").alias("variacao_pct"), F.lit(False).alias("is_est"),
        F.lit(False).alias("is_lead"))
    one = est.unionByName(top).agg(
        F.count_if(F.col("is_est")).alias("total_estabelecimentos"),
        F.count_if(F.col("is_lead")).alias("n_leads"),
        F.count_distinct("codigo_municipio").alias("municipios_cobertos"),
        F.max("descricao").alias("descricao"), F.max("variacao_pct").alias("variacao_pct"),
        F.count_if(~F.col("is_est")).alias("n_top"))
    return one.select(
        "total_estabelecimentos",
        format_int_br("total_estabelecimentos").alias("total_fmt"),
        F.coalesce(truncate_label("descricao", KPI_LABEL_WIDTH), F.lit(EMPTY_MARK)).alias("setor_destaque"),
        F.when(F.col("n_top") > 0, format_variation("variacao_pct")).alias("variacao_destaque"),
        "municipios_cobertos",
        F.least(F.col("n_leads"), F.lit(page).cast("bigint")).alias("leads_carregados"))
