"""Composite jobs over a monthly registry batch.

A batch folder holds one-member zip archives: ``Estabelecimentos*.zip`` and
``Empresas*.zip`` (shards), ``Municipios.zip``, ``Cnaes.zip`` and
``Naturezas.zip``. Every stage is one lazy Spark plan cut only at its
Parquet writes (those writes are also the lineage cuts that let a job
resume after lost executors). Tables live under ``warehouse`` as versioned
folders switched by pointer (see ``sinks.writes``).
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..constants import ENRICHMENT_LIMIT, INSIGHT_SIZE, REGION_MUNICIPALITIES, STATE_DEFAULT
from ..operators import dashboard as D
from ..operators import growth as G
from ..operators import insight as I
from ..operators import leads as L
from ..operators import quality as Q
from ..operators import region as RG
from ..operators import registry as R
from ..session import staged
from ..sinks import writes as W
from ..sources import shards as S
from ..sources.records import with_reason
from ..sources.zipsource import scan_zip


def _zip(spark: SparkSession, batch_dir: str, pattern: str, layout: Sequence[str]) -> DataFrame:
    return scan_zip(spark, os.path.join(batch_dir, pattern), layout)


def municipalities(spark: SparkSession, batch_dir: str) -> DataFrame:
    return _zip(spark, batch_dir, "Municipios.zip", schemas.MUNICIPALITY_LAYOUT)


def load_reference(spark: SparkSession, batch_dir: str, warehouse: str,
                   whitelist=REGION_MUNICIPALITIES) -> dict[str, DataFrame]:
    """Legal natures, sectors and the region's municipalities, upserted
    by key (idempotent); the municipality state defaults to 'RS'."""
    code = schemas.CODE_LAYOUT
    nat = _zip(spark, batch_dir, "Naturezas.zip", code)
    cnae = _zip(spark, batch_dir, "Cnaes.zip", code)
    mun = RG.in_region(municipalities(spark, batch_dir), whitelist)
    out = {}
    for name, df, key, stored in (("natureza_juridica", nat, "codigo", {}), ("cnaes", cnae, "codigo", {}),
                                  ("municipios", mun, "codigo_municipio", {"uf": STATE_DEFAULT})):
        # The last record of a code wins, in (archive, record) order.
        listed = [c for c in df.columns if c not in ("shard", "linha")]
        incoming = df.select(*listed, F.struct("shard", "linha").alias("__seq"))
        schema = T.StructType([T.StructField(c, T.StringType(), True) for c in [*listed, *stored]])
        out[name] = W.upsert_table(spark, warehouse, name, incoming, key, schema, seq="__seq", defaults=stored)
    return out


def filter_region(spark: SparkSession, batch_dir: str, staging: str,
                  whitelist=REGION_MUNICIPALITIES) -> DataFrame:
    """The region's establishments of every shard, written as Parquet
    partitioned by shard (K1); returns rows per shard and the total (K11).
    Raises when the batch has no establishment archive (S5)."""
    codes = RG.region_codes(municipalities(spark, batch_dir), whitelist)
    est = _zip(spark, batch_dir, "Estabelecimentos*.zip", schemas.ESTABLISHMENT_LAYOUT)
    regional = RG.filter_region(est, codes)
    W.counted_write(regional, f"{staging}/estabelecimentos_rmpa", partition_by=["shard"])
    return S.shard_counts(spark.read.parquet(f"{staging}/estabelecimentos_rmpa"), "shard")


def batch_records(spark: SparkSession, batch_dir: str, staging: str, pattern: str = "Estabelecimentos*.zip",
                  layout: Sequence[str] = schemas.ESTABLISHMENT_LAYOUT) -> DataFrame:
    """All records of a batch's archives, accepted and rejected ones parted in one pass below
    ``staging``; returns the counts per archive and in all."""
    path = f"{staging}/registros-{uuid.uuid4().hex[:8]}"
    rows = scan_zip(spark, os.path.join(batch_dir, pattern), layout, keep_corrupt=True)
    W.land_parted(with_reason(rows, len(layout)), path)
    return S.record_counts(spark.read.parquet(path))


def transform(spark: SparkSession, batch_dir: str, staging: str) -> dict[str, int]:
    """R2: typed active establishments and the companies that have one
    (semi join, then first row per key in (shard, line) order)."""
    raw = spark.read.parquet(f"{staging}/estabelecimentos_rmpa")
    est = R.establishments_final(raw)
    n_est = W.counted_write(est, f"{staging}/estabelecimentos_final")
    est = spark.read.parquet(f"{staging}/estabelecimentos_final")
    comp_raw = _zip(spark, batch_dir, "Empresas*.zip", schemas.COMPANY_LAYOUT)
    n_comp = W.counted_write(R.companies_final(comp_raw, est), f"{staging}/empresas_final")
    return {"estabelecimentos": n_est, "empresas": n_comp}


ESTABLISHMENT_COLUMNS = [schemas.ESTABLISHMENT_RENAME.get(c, c) for c in schemas.ESTABLISHMENT_FINAL]
SHOWN_VIOLATIONS = 20


class LoadRefused(ValueError):
    """Rows break the constraints of the tables they were to be loaded into."""


def load_violations(spark: SparkSession, warehouse: str, companies: DataFrame,
                    establishments: DataFrame) -> DataFrame:
    """Q1-Q3 on the rows of a load: keys, references and NOT NULL columns."""
    t = lambda name: table(spark, warehouse, name)
    return Q.union_checks(
        Q.pk_violations(companies, ["cnpj_basico"], "empresas"),
        Q.pk_violations(establishments, ["cnpj"], "estabelecimentos"),
        Q.fk_violations(companies, "natureza_juridica", t("natureza_juridica"), "codigo", "empresas"),
        Q.fk_violations(establishments, "cnpj_basico", companies, "cnpj_basico", "estabelecimentos"),
        Q.fk_violations(establishments, "cnae_principal", t("cnaes"), "codigo", "estabelecimentos"),
        Q.fk_violations(establishments, "codigo_municipio", t("municipios"), "codigo_municipio",
                        "estabelecimentos"),
        Q.not_null_violations(companies, ["cnpj_basico", "razao_social"], "empresas"),
        Q.not_null_violations(establishments, ["cnpj", "cnpj_basico", "situacao_cadastral",
                                               "data_inicio_atividade", "codigo_municipio"],
                              "estabelecimentos"))


def load(spark: SparkSession, staging: str, warehouse: str, waive: Sequence[str] = ()) -> dict[str, int]:
    """Full refresh of companies and establishments together; the
    enrichment table is emptied as by a cascading truncate (C10).

    Rows that break a key, a reference or NOT NULL refuse the whole load, and
    the old tables stay. ``waive`` names columns (``table.column``) whose
    violations are let through."""
    companies = spark.read.parquet(f"{staging}/empresas_final")
    establishments = spark.read.parquet(f"{staging}/estabelecimentos_final")
    broken = (load_violations(spark, warehouse, companies, establishments)
              .where(~F.concat_ws(".", "tabela", "coluna").isin(list(waive)))
              .limit(SHOWN_VIOLATIONS).collect())
    if broken:
        raise LoadRefused("; ".join(f"{r.tabela}.{r.coluna}={r.valor!r} ({r.ocorrencias} rows)" for r in broken))
    return W.refresh(
        spark, warehouse,
        {"empresas": companies, "estabelecimentos": establishments},
        columns={"empresas": list(schemas.COMPANY_FINAL), "estabelecimentos": ESTABLISHMENT_COLUMNS},
        cascade={"leads_enriquecidos": schemas.ENRICHMENT_STORED})


def table(spark: SparkSession, warehouse: str, name: str) -> DataFrame:
    return W.read_current(spark, warehouse, name)


def compute_growth(spark: SparkSession, warehouse: str) -> int:
    """Recompute the growth statistics table (K5)."""
    stats = G.growth_stats(table(spark, warehouse, "estabelecimentos"))
    return W.refresh(spark, warehouse, {"estatisticas_crescimento": stats})["estatisticas_crescimento"]


def advance_growth(spark: SparkSession, warehouse: str, establishments: DataFrame,
                   stats: str = "estatisticas_crescimento") -> dict[str, int]:
    """R4 batch by batch: the statistics of the months that ``establishments`` brings, from the carried state
    (``growth.carried``) and without any old row; returns the rows written and those that came too late.

    The statistics are a table partitioned by month; a batch overwrites the months it brings and
    nothing else, then the new state is switched to. A job that dies between the two leaves the
    old state, and running it again writes the same months again."""
    known = W.current_tables(spark, warehouse)
    state = W.read_current(spark, warehouse, G.STATE) if G.STATE in known else None
    monthly = staged(G.monthly_openings(establishments), "monthly")
    new, kept, late = G.carried(state, monthly)
    written = W.write_months(spark, warehouse, stats, new)
    counted = late.count()
    W.refresh(spark, warehouse, {G.STATE: kept})
    return {"escritas": written, "atrasadas": counted}


def enrich(spark: SparkSession, warehouse: str, candidates: DataFrame, n: int = ENRICHMENT_LIMIT,
           best_month_only: bool = False) -> DataFrame:
    """Rank leads (T1), take each ranked lead's first place candidate
    (J7; ``candidates``: cnpj, rank, payload) and upsert the matches with
    the clock refreshed (K8)."""
    t = lambda name: table(spark, warehouse, name)
    ranked = L.lead_ranking(t("estabelecimentos"), t("empresas"), t("municipios"),
                            t("estatisticas_crescimento"), n, best_month_only)
    matches = L.place_first_match(ranked.select("cnpj").distinct(), candidates)
    return W.upsert_table(spark, warehouse, "leads_enriquecidos", matches, "cnpj",
                          schemas.ENRICHMENT_STORED, touch="enriquecido_em")


def generate_insight(spark: SparkSession, warehouse: str, content: str, model: str,
                     n: int = INSIGHT_SIZE) -> int:
    """Snapshot of the latest month's top ``n`` as JSON, appended with
    the given text (the text model itself is not called). Empty input
    appends nothing."""
    t = lambda name: table(spark, warehouse, name)
    top = G.latest_month_top(t("estatisticas_crescimento"), t("cnaes"), t("municipios"), n)
    record = I.insight_record(I.insight_snapshot(top), content, model)
    return W.append(record, f"{warehouse}/insights_ia")


def dashboard(spark: SparkSession, warehouse: str) -> dict[str, DataFrame]:
    """The page's datasets (ranking, chart, axis, KPIs, leads, display)."""
    t = lambda name: table(spark, warehouse, name)
    est = t("estabelecimentos")
    ranking = G.growth_ranking(t("estatisticas_crescimento"), t("cnaes"), t("municipios"))
    chart = D.growth_chart(ranking)
    leads = L.recent_leads(est, t("empresas"), t("cnaes"), t("municipios"), t("leads_enriquecidos"))
    insights = spark.read.parquet(f"{warehouse}/insights_ia") if _exists(spark, f"{warehouse}/insights_ia") else None
    return {
        "ranking": ranking, "chart": chart, "axis": D.growth_axis_bound(chart),
        "kpis": D.dashboard_kpis(est, ranking), "leads": leads,
        "display": L.leads_display(leads),
        "insight": I.latest_insight(insights) if insights is not None else None,
    }


def _exists(spark: SparkSession, path: str) -> bool:
    return W.path_exists(spark, path)


def run_batch(spark: SparkSession, batch_dir: str, root: str, whitelist=REGION_MUNICIPALITIES,
              waive: Sequence[str] = ()) -> dict:
    """R0-R4 end to end for one batch folder (``waive``: see :func:`load`)."""
    staging, warehouse = f"{root}/staging", f"{root}/warehouse"
    load_reference(spark, batch_dir, warehouse, whitelist)
    counts = filter_region(spark, batch_dir, staging, whitelist)
    loaded = transform(spark, batch_dir, staging)
    load(spark, staging, warehouse, waive)
    cells = compute_growth(spark, warehouse)
    return {"shards": {r[0]: r[1] for r in counts.collect()}, **loaded, "estatisticas": cells}


__all__ = ["load_reference", "filter_region", "batch_records", "transform", "advance_growth", "load", "compute_growth", "enrich",
           "generate_insight", "dashboard", "run_batch", "table"]
