"""Lead ranking: every month of a cell joins (C5), or one best month per
cell with ``best_month_only``; the top stats rows are broadcast, bounded by n."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sectorpulse.operators import leads as L


def _frames(spark):
    est = spark.createDataFrame(
        [("e1", "c1", "S", "M", 2), ("e2", "c1", "S", "M", 2), ("e3", "c2", "T", "M", 2),
         ("e4", "c2", "T", "M", 8)],
        "cnpj string, cnpj_basico string, cnae_principal string, codigo_municipio string, "
        "situacao_cadastral smallint")
    comp = spark.createDataFrame([("c1", "ACME"), ("c2", "BETA")], "cnpj_basico string, razao_social string")
    mun = spark.createDataFrame([("M", "CIDADE")], "codigo_municipio string, nome string")
    stats = spark.createDataFrame(
        [("S", "M", dt.date(2026, 1, 1), 3, "50.00"), ("S", "M", dt.date(2026, 2, 1), 2, "40.00"),
         ("T", "M", dt.date(2026, 1, 1), 9, "45.00"), ("T", "M", dt.date(2026, 2, 1), 1, None)],
        "cnae_codigo string, codigo_municipio string, ano_mes date, total_aberturas int, variacao_pct string"
    ).selectExpr("cnae_codigo", "codigo_municipio", "ano_mes", "total_aberturas",
                 "cast(variacao_pct as decimal(6,2)) as variacao_pct")
    return est, comp, mun, stats


def test_lead_ranking_fans_out_over_months(spark):
    est, comp, mun, stats = _frames(spark)
    out = L.lead_ranking(est, comp, mun, stats, n=4).collect()
    assert [(r.cnpj, str(r.variacao_pct)) for r in out] == [
        ("e1", "50.00"), ("e2", "50.00"), ("e3", "45.00"), ("e1", "40.00")]
    plan = L.lead_ranking(est, comp, mun, stats, n=4)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
    pairs = L._ranked_pairs(est, comp, mun, stats.drop("total_aberturas"), 4)
    assert "Broadcast" in pairs._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("best", [False, True])
@pytest.mark.parametrize("n", [1, 2, 3, 5, 40])
def test_lead_ranking_equals_the_full_pairing(spark, n, best):
    """The best cells have no joinable lead (no company, no municipality, not active, null code), others have many."""
    est = spark.createDataFrame(
        [("e%02d" % i, "c%d" % (i % 4), s, m, 2) for i, (s, m) in enumerate(
            [("S", "M")] * 4 + [("T", "M")] * 3 + [("S", "N"), (None, "M"), ("S", None)])]
        + [("x1", "gone", "U", "M", 2), ("x2", "c1", "V", "M", 8), ("x3", "c1", "S", "nowhere", 2)],
        "cnpj string, cnpj_basico string, cnae_principal string, codigo_municipio string, "
        "situacao_cadastral smallint")
    comp = spark.createDataFrame([("c%d" % i, "N%d" % (i % 2)) for i in range(4)],
                                 "cnpj_basico string, razao_social string")
    mun = spark.createDataFrame([("M", "CIDADE"), ("N", "OUTRA")], "codigo_municipio string, nome string")
    rows = [(s, m, dt.date(2026, k, 1), 1, v if v is None else v + (k == 2)) for s, m, v in
            [("U", "M", 900), ("V", "M", 800), ("S", "nowhere", 700), (None, "M", 600), ("S", None, 500),
             ("S", "M", 40), ("T", "M", 40), ("S", "N", None)] for k in (1, 2, 3)]
    stats = spark.createDataFrame(rows, "cnae_codigo string, codigo_municipio string, ano_mes date, "
                                        "total_aberturas int, variacao_pct int").withColumn(
        "variacao_pct", F.col("variacao_pct").cast("decimal(6,2)"))
    if best:
        kept = {}
        for r in sorted(rows, key=lambda r: (r[4] is None, -(r[4] or 0), r[2])):
            kept.setdefault(r[:2], r)
        rows = list(kept.values())
    firms, towns = dict(map(tuple, comp.collect())), dict(map(tuple, mun.collect()))
    full = [(v is None, -(v or 0), s, m, k, e.cnpj, firms[e.cnpj_basico], towns[m])
            for s, m, k, _, v in rows for e in est.collect()
            if s is not None and m in towns and (e.cnae_principal, e.codigo_municipio) == (s, m)
            and e.situacao_cadastral == 2 and e.cnpj_basico in firms]
    got = L.lead_ranking(est, comp, mun, stats, n=n, best_month_only=best).collect()
    assert [(r.cnpj, r.cnae_codigo, r.codigo_municipio, r.ano_mes) for r in got] == [
        (f[5], f[2], f[3], f[4]) for f in sorted(full)[:n]]


def test_lead_ranking_joins_names_once_when_the_first_cells_have_leads(spark, monkeypatch):
    calls = []
    real = L.lead_candidates
    monkeypatch.setattr(L, "lead_candidates", lambda *a: calls.append(1) or real(*a))
    L.lead_ranking(*_frames(spark), n=4).collect()
    assert len(calls) == 1


def test_lead_ranking_best_month_only(spark):
    est, comp, mun, stats = _frames(spark)
    out = L.lead_ranking(est, comp, mun, stats, n=10, best_month_only=True).collect()
    assert [(r.cnpj, r.ano_mes.month, str(r.variacao_pct)) for r in out] == [
        ("e1", 1, "50.00"), ("e2", 1, "50.00"), ("e3", 1, "45.00")]
