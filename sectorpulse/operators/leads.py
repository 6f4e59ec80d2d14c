"""Leads: ranking for enrichment (R5), the newest-leads page and its display,
search, sort and export shapes (R7), and the first place match (J7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas
from ..constants import (EMPTY_MARK, ENRICHMENT_LIMIT, LEADS_PAGE, NOT_ENRICHED,
                         STATUS_ACTIVE)
from ..functions.fmt import date_br, iso_date
from ..functions.text import lead_search_text
from ..session import staged
from .embed import embed_left
from .growth import ranking_order

# Statistics rows (two short codes, a month and a number each) that a ranking sends to every task.
PAIRED_ROWS = 10_000


def _active(establishments: DataFrame) -> DataFrame:
    return establishments.where(F.col("situacao_cadastral") == STATUS_ACTIVE)


def lead_candidates(establishments: DataFrame, companies: DataFrame,
                    municipalities: DataFrame) -> DataFrame:
    """Active establishments with company name and municipality name
    (J1 inner joins of the lead query)."""
    return (_active(establishments)
            .select("cnpj", "cnpj_basico", "cnae_principal", "codigo_municipio")
            .join(companies.select("cnpj_basico", "razao_social"), "cnpj_basico")
            .join(municipalities.select("codigo_municipio", F.col("nome").alias("municipio")),
                  "codigo_municipio"))


def best_month(stats: DataFrame) -> DataFrame:
    """One row per (sector, municipality): its highest variation (NULLs
    last, earliest month on ties) -- an aggregate, combined map-side."""
    key = F.struct(F.col("variacao_pct").isNotNull(), F.col("variacao_pct"), -F.datediff("ano_mes", F.lit("1970-01-01")))
    return (stats.groupBy("cnae_codigo", "codigo_municipio")
                 .agg(F.max_by(F.struct("ano_mes", "total_aberturas", "variacao_pct"), key).alias("b"))
                 .select("cnae_codigo", "codigo_municipio", "b.*"))


def _ranked_pairs(establishments: DataFrame, companies: DataFrame, municipalities: DataFrame,
                  top: DataFrame, n: int) -> DataFrame:
    """The first ``n`` pairs of the at most ``n`` statistics rows ``top`` with the leads of their cells. The
    establishments are cut down to these cells before any name is joined, so only their leads shuffle."""
    if n <= PAIRED_ROWS:
        top = F.broadcast(top)
    cell = [F.col("cnae_principal") == F.col("cnae_codigo"), F.col("codigo_municipio") == F.col("__cidade")]
    cells = top.select("cnae_codigo", F.col("codigo_municipio").alias("__cidade")).distinct()
    leads = lead_candidates(establishments.join(cells, cell, "left_semi"), companies, municipalities)
    pairs = leads.join(top.withColumnRenamed("codigo_municipio", "__cidade"), cell)
    return (pairs.select("cnpj", "razao_social", "municipio", "cnae_codigo", "codigo_municipio",
                         "ano_mes", "variacao_pct")
                 .orderBy(*ranking_order(), "cnpj", "razao_social", "municipio").limit(n))


def lead_ranking(establishments: DataFrame, companies: DataFrame, municipalities: DataFrame,
                 stats: DataFrame, n: int = ENRICHMENT_LIMIT, best_month_only: bool = False) -> DataFrame:
    """The ``n`` (lead, month) pairs with the highest variation.

    Every month of a lead's (sector, municipality) joins (C5), so a lead can
    fill several slots. The full pairing grows to leads x months; instead:

    1. the first ``n`` statistics rows are written and paired with the leads of
       their cells. Pairs rank by their statistics rows, so ``n`` pairs from
       these rows, or no rows beyond them, are the answer;
    2. only when cells without joinable leads leave fewer pairs: keep the
       statistics of cells with leads (an aggregate over all leads). Each row
       has at least one lead, so the first ``n`` of them are enough.
    """
    if best_month_only:
        stats = best_month(stats)
    stats = stats.select("cnae_codigo", "codigo_municipio", "ano_mes", "variacao_pct")
    top = staged(stats.orderBy(*ranking_order()).limit(n), "cells")
    first = staged(_ranked_pairs(establishments, companies, municipalities, top, n), "pairs")
    if first.count() < n and top.count() == n:
        leads = lead_candidates(establishments, companies, municipalities)
        cells = leads.select(F.col("cnae_principal").alias("cnae_codigo"), "codigo_municipio").distinct()
        top = staged(stats.join(cells, ["cnae_codigo", "codigo_municipio"], "left_semi")
                          .orderBy(*ranking_order()).limit(n), "cells")
        return _ranked_pairs(establishments, companies, municipalities, top, n)
    return first.orderBy(*ranking_order(), "cnpj", "razao_social", "municipio").limit(n)


def recent_leads(establishments: DataFrame, companies: DataFrame, sectors: DataFrame,
                 municipalities: DataFrame, enrichment: DataFrame | None,
                 n: int = LEADS_PAGE) -> DataFrame:
    """The ``n`` newest active establishments (ties by key), then
    the four nullable embeds on those ``n`` rows only (limit before embeds).
    ``posicao`` is the row's place on the page, newest first."""
    newest = [F.col("data_inicio_atividade").desc_nulls_last(), F.col("cnpj").asc_nulls_last()]
    # Written once: each embed reads the page and does not plan the top-k again.
    top = staged(_active(establishments)
                 .select("cnpj", "cnpj_basico", "nome_fantasia", "data_inicio_atividade",
                         "situacao_cadastral", "cnae_principal", "codigo_municipio")
                 .orderBy(*newest).limit(n)
                 # One page of at most n rows: numbering it in one task is bounded.
                 .withColumn("posicao", F.row_number().over(Window.orderBy(*newest))), "page")
    out = embed_left(top, companies, {"cnpj_basico": "cnpj_basico"}, "empresas", ["razao_social", "porte"])
    out = embed_left(out, sectors, {"cnae_principal": "codigo"}, "cnaes", ["descricao"])
    out = embed_left(out, municipalities, {"codigo_municipio": "codigo_municipio"}, "municipios", ["nome"])
    if enrichment is not None:
        out = embed_left(out, enrichment, {"cnpj": "cnpj"}, "leads_enriquecidos",
                         ["endereco_formatado", "telefone_places", "website", "rating_google"])
    else:
        out = out.withColumn("leads_enriquecidos", F.lit(None).cast(
            "struct<endereco_formatado:string,telefone_places:string,website:string,rating_google:decimal(2,1)>"))
    return out


def all_leads(establishments: DataFrame, companies: DataFrame, sectors: DataFrame, municipalities: DataFrame,
              enrichment: DataFrame) -> DataFrame:
    """Every active establishment with its four nullable embeds: as ``recent_leads`` for the whole table, so the
    dimensions are joined as the planner chooses."""
    out = _active(establishments).select("cnpj", "cnpj_basico", "nome_fantasia", "data_inicio_atividade",
                                         "cnae_principal", "codigo_municipio")
    for dim, own, key, name, fields in (
            (companies, "cnpj_basico", "cnpj_basico", "empresas", ["razao_social"]),
            (sectors, "cnae_principal", "codigo", "cnaes", ["descricao"]),
            (municipalities, "codigo_municipio", "codigo_municipio", "municipios", ["nome"]),
            (enrichment, "cnpj", "cnpj", "leads_enriquecidos", ["telefone_places"])):
        side = dim.select(F.col(key).alias("__k"), F.struct(*fields).alias(name))
        out = out.join(side, out[own] == side["__k"], "left").drop("__k")
    return out


DISPLAY_COLUMNS = ("empresa", "setor", "municipio", "aberta_em", "contato")


def leads_display(leads: DataFrame) -> DataFrame:
    """The five displayed values with their fallbacks."""
    return leads.select(
        *[c for c in ("posicao",) if c in leads.columns], "cnpj", "data_inicio_atividade",
        F.coalesce(F.col("empresas.razao_social"), F.col("nome_fantasia"), F.lit(EMPTY_MARK)).alias("empresa"),
        F.coalesce(F.col("cnaes.descricao"), F.lit(EMPTY_MARK)).alias("setor"),
        F.coalesce(F.col("municipios.nome"), F.lit(EMPTY_MARK)).alias("municipio"),
        date_br("data_inicio_atividade").alias("aberta_em"),
        F.coalesce(F.col("leads_enriquecidos.telefone_places"), F.lit(NOT_ENRICHED)).alias("contato"))


def leads_search(display: DataFrame, text: str) -> DataFrame:
    """Case-insensitive substring match in any displayed value."""
    q = F.lit(text.lower())
    cond = None
    for c in DISPLAY_COLUMNS:
        m = F.coalesce(F.contains(F.lower(F.col(c)), q), F.lit(False))
        cond = m if cond is None else cond | m
    return display.where(cond)


def leads_sorted(display: DataFrame, column: str, ascending: bool = True, page: int = LEADS_PAGE) -> DataFrame:
    """Order by one displayed column (the date by its date value), key
    as tie-break; ``posicao`` numbers the order. The result is one page of at
    most ``page`` rows, as many as the display it sorts holds."""
    if column not in DISPLAY_COLUMNS:
        raise ValueError(f"unknown display column {column!r}")
    value = F.col("data_inicio_atividade") if column == "aberta_em" else F.col(column)
    o = value.asc_nulls_last() if ascending else value.desc_nulls_last()
    order = [o, F.col("cnpj").asc_nulls_last()]
    return display.orderBy(*order).limit(page).withColumn("posicao", F.row_number().over(Window.orderBy(*order)))


def leads_export_frame(leads: DataFrame) -> DataFrame:
    """K9/F16 columns: key, company, sector, municipality, ISO date, phone;
    NULL becomes '' in the joined line; ``posicao`` keeps the page order."""
    cols = [F.col("cnpj"), F.col("empresas.razao_social"), F.col("cnaes.descricao"),
            F.col("municipios.nome"), iso_date("data_inicio_atividade"),
            F.col("leads_enriquecidos.telefone_places")]
    names = ["cnpj", "razao_social", "setor", "municipio", "data_abertura", "telefone"]
    line = F.array_join(F.array(*[F.coalesce(c, F.lit("")) for c in cols]), ";")
    return leads.select("posicao", *[c.alias(n) for c, n in zip(cols, names)], line.alias("linha"))


def search_texts(establishments: DataFrame, companies: DataFrame,
                 municipalities: DataFrame) -> DataFrame:
    """the place-search text of every joinable active lead."""
    return (lead_candidates(establishments, companies, municipalities)
            .select("cnpj", lead_search_text("razao_social", "municipio").alias("texto_busca")))


def place_first_match(leads: DataFrame, candidates: DataFrame, key: str = "cnpj",
                      rank: tuple[str, ...] = ("rank",), payload: str = "payload") -> DataFrame:
    """The first place of the first response per key; leads with
    no response, or with one that holds no place, are skipped (inner join).

    ``payload`` is a search response, ``{"places": [...]}``, of which the first
    element counts; a bare place object with an id is taken as it is.

    The first candidate is taken per key *before* the join (``min_by``,
    combined map-side), so a key with many candidates never fans out.
    """
    first = (candidates.groupBy(key)
                       .agg(F.min_by(F.col(payload), F.struct(*[F.col(r) for r in rank])).alias("payload")))
    places = F.from_json("payload", schemas.PLACE_RESPONSE).getField("places")
    bare = F.from_json("payload", schemas.PLACE_PAYLOAD)
    place = (F.when(places.isNotNull(), F.get(places, F.lit(0)))
              .when(bare.getField("id").isNotNull(), bare))
    first = first.select(key, place.alias("place")).where(F.col("place").isNotNull())
    matched = leads.select("cnpj", *([key] if key != "cnpj" else [])).join(first, key)
    p = F.col("place")
    return matched.select(
        "cnpj",
        p.getField("id").alias("place_id"),
        p.getField("formattedAddress").alias("endereco_formatado"),
        p.getField("internationalPhoneNumber").alias("telefone_places"),
        p.getField("websiteUri").alias("website"),
        p.getField("rating").cast("decimal(2,1)").alias("rating_google"),
        p.getField("userRatingCount").alias("total_avaliacoes"))
