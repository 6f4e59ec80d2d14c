"""Monthly openings, trailing mean and variation (R4), rankings.

Plan shape of :func:`growth_stats`: scan (pruned) -> filter -> partial
hash aggregate -> exchange -> final aggregate -> exchange on
(sector, municipality) -> sort -> window -> project. The second exchange
moves aggregated cells only (sectors x municipalities x months), never raw
rows, and each window partition holds one cell's months.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..constants import (INSIGHT_SIZE, RANKING_MIN_OPENINGS, RANKING_SIZE,
                         STATUS_ACTIVE, TRAILING_ROWS)
from ..functions.growth_math import hundredths_to_pct, variation_hundredths
from ..session import staged
from .embed import embed_left

CELL = ("cnae_codigo", "codigo_municipio")


def ranking_order(variation: str = "variacao_pct"):
    """Total order of every top-k here (contract C6): variation descending
    with NULLs last, then sector, municipality, month ascending."""
    return [F.col(variation).desc_nulls_last(), F.col("cnae_codigo").asc_nulls_first(),
            F.col("codigo_municipio").asc_nulls_first(), F.col("ano_mes").asc_nulls_first()]


def monthly_openings(establishments: DataFrame) -> DataFrame:
    """A1/F8: active openings per (sector, municipality, month)."""
    return (establishments
            .where((F.col("situacao_cadastral") == STATUS_ACTIVE)
                   & F.col("data_inicio_atividade").isNotNull())
            .groupBy(F.col("cnae_principal").alias("cnae_codigo"),
                     F.col("codigo_municipio"),
                     F.trunc("data_inicio_atividade", "MM").alias("ano_mes"))
            .agg(F.count(F.lit(1)).cast("int").alias("total_aberturas")))


def _frame(rows: int = TRAILING_ROWS):
    # The frame counts rows (months with openings), not calendar months.
    return Window.partitionBy(*CELL).orderBy("ano_mes").rowsBetween(-rows, -1)


def trailing_mean(monthly: DataFrame, rows: int = TRAILING_ROWS) -> DataFrame:
    """V1: mean of up to ``rows`` previous rows, current row excluded, with
    the frame's integer sum and count."""
    w = _frame(rows)
    return monthly.select(
        "*",
        F.sum("total_aberturas").over(w).cast("bigint").alias("soma_janela"),
        F.count("total_aberturas").over(w).alias("n_janela"),
        F.avg("total_aberturas").over(w).alias("media_movel_6m"))


def growth_stats(establishments: DataFrame, rows: int = TRAILING_ROWS) -> DataFrame:
    """(cnae_codigo, codigo_municipio, ano_mes, total_aberturas,
    variacao_pct DECIMAL(6,2)); variation NULL without history (C2, C3)."""
    framed = trailing_mean(monthly_openings(establishments), rows)
    return framed.select(
        *CELL, "ano_mes", "total_aberturas",
        hundredths_to_pct(variation_hundredths("total_aberturas", "soma_janela", "n_janela"))
        .alias("variacao_pct"))


def growth_ranking(stats: DataFrame, sectors: DataFrame | None = None,
                   municipalities: DataFrame | None = None, n: int = RANKING_SIZE,
                   min_openings: int = RANKING_MIN_OPENINGS) -> DataFrame:
    """The ``n`` highest variations over all months (C4) among
    cells with a variation and at least ``min_openings``; ``posicao`` is
    1-based. With dimensions given, adds the nullable embeds
    ``cnaes{descricao}`` and ``municipios{nome}``."""
    top = (stats.where(F.col("variacao_pct").isNotNull()
                       & (F.col("total_aberturas") >= min_openings))
                .orderBy(*ranking_order()).limit(n))
    if sectors is not None or municipalities is not None:
        # Written once: the embeds read n rows and do not plan the ranking again.
        top = staged(top, "ranking")
    # n rows at most: numbering them in one partition is harmless.
    ranked = top.withColumn("posicao", F.row_number().over(Window.orderBy(*ranking_order())))
    if sectors is not None:
        ranked = embed_left(ranked, sectors, {"cnae_codigo": "codigo"}, "cnaes", ["descricao"])
    if municipalities is not None:
        ranked = embed_left(ranked, municipalities, {"codigo_municipio": "codigo_municipio"},
                            "municipios", ["nome"])
    return ranked


def latest_month_top(stats: DataFrame, sectors: DataFrame, municipalities: DataFrame,
                     n: int = INSIGHT_SIZE) -> DataFrame:
    """Top ``n`` variations of the latest month, with sector
    description and municipality name (inner joins)."""
    described = (stats.join(sectors.select(F.col("codigo").alias("cnae_codigo"), F.col("descricao").alias("setor"),
                                           F.lit(True).alias("__s")), "cnae_codigo", "left")
                      .join(municipalities.select("codigo_municipio", F.col("nome").alias("municipio"),
                                                  F.lit(True).alias("__m")), "codigo_municipio", "left"))
    shown = F.col("variacao_pct").isNotNull() & F.col("__s").isNotNull() & F.col("__m").isNotNull()
    # The newest month's rows come first and its presentable ones before the others, so the first n rows
    # tell the month and hold its top: the statistics are planned once.
    newest = described.withColumn("__shown", shown).orderBy(
        F.col("ano_mes").desc_nulls_last(), F.col("__shown").desc(), *ranking_order()).limit(n)
    top = newest.withColumn("__latest", F.max("ano_mes").over(Window.partitionBy())).where(
        F.col("__shown") & (F.col("ano_mes") == F.col("__latest")))
    return top.select(F.row_number().over(Window.orderBy(*ranking_order())).alias("posicao"),
                      "setor", "municipio", "total_aberturas", "variacao_pct",
                      "cnae_codigo", "codigo_municipio", "ano_mes")


# ------------------------------------------------------------------ batch by batch

STATE = "estado_crescimento"


def carried(state: DataFrame | None, monthly: DataFrame, rows: int = TRAILING_ROWS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """V1/V2 of new months from the carried state: (statistics of the new months, new state, late rows).

    ``state`` holds the last ``rows`` months with openings of each cell (C1: rows, not calendar months), all that
    a later month's frame can reach, so old rows are never read again. ``monthly`` (staged: it is read for each
    result) are the openings of the new months. A cell's row that is no later than the cell's state is late: its
    statistics are closed, it is handed back and not counted."""
    fresh = monthly.withColumn("__new", F.lit(True))
    late = monthly.limit(0)
    if state is not None:
        closed = state.groupBy(*CELL).agg(F.max("ano_mes").alias("__closed"))
        known = monthly.join(closed, [monthly[c].eqNullSafe(closed[c]) for c in CELL], "left").select(
            monthly["*"], "__closed")
        behind = F.coalesce(F.col("ano_mes") <= F.col("__closed"), F.lit(False))
        late = known.where(behind).drop("__closed")
        fresh = known.where(~behind).drop("__closed").withColumn("__new", F.lit(True)).unionByName(
            state.withColumn("__new", F.lit(False)))
    stats = trailing_mean(fresh, rows).where("__new").select(
        *CELL, "ano_mes", "total_aberturas",
        hundredths_to_pct(variation_hundredths("total_aberturas", "soma_janela", "n_janela")).alias("variacao_pct"))
    newest = Window.partitionBy(*CELL).orderBy(F.col("ano_mes").desc())
    kept = fresh.withColumn("__n", F.row_number().over(newest)).where(F.col("__n") <= rows).drop("__n", "__new")
    return stats, kept, late
