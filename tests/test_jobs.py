"""End to end over a small hand-written registry batch (raw zip archives)."""

import os
import zipfile

import pytest

from sectorpulse import schemas
from sectorpulse.plans import jobs
from sectorpulse.session import local_dir


def _csv(rows):
    out = []
    for r in rows:
        out.append(";".join('"' + v.replace('"', '""') + '"' if v is not None else "" for v in r))
    return "\r\n".join(out) + "\r\n"


def _zip(folder, name, rows):
    with zipfile.ZipFile(os.path.join(folder, name), "w") as zf:
        zf.writestr(name.replace(".zip", ".CSV"), _csv(rows).encode("latin-1"))


def _est(basico, ordem, status, start, cnae, mun, fantasia=None):
    row = dict.fromkeys(schemas.ESTABLISHMENT_LAYOUT)
    row.update(cnpj_basico=basico, cnpj_ordem=ordem, cnpj_dv="01", nome_fantasia=fantasia,
               situacao_cadastral=status, data_situacao_cadastral="20200101",
               data_inicio_atividade=start, cnae_principal=cnae, codigo_municipio=mun,
               cep="90000000", telefone_1="5551")
    return [row[c] for c in schemas.ESTABLISHMENT_LAYOUT]


def test_batch_end_to_end(spark, tmp_dir):
    batch = os.path.join(local_dir(tmp_dir), "raw", "2026-06")
    os.makedirs(batch)
    _zip(batch, "Municipios.zip", [["8801", "PORTO ALEGRE"], ["8802", "Gravataí"], ["9999", "PELOTAS"]])
    _zip(batch, "Cnaes.zip", [["6201501", "Desenvolvimento de software"], ["5611201", "Restaurantes"]])
    _zip(batch, "Naturezas.zip", [["2062", "Sociedade Limitada"]])
    months = ["20260101", "20260101", "20260201", "20260201", "20260201", "20260201"]
    e0 = [_est("00000001", f"{i:04d}", "02", d, "6201501", "8801") for i, d in enumerate(months)]
    e0 += [_est("00000002", "0001", "08", "20260101", "6201501", "8801"),  # closed
           _est("00000003", "0001", "02", "20260301", "5611201", "9999")]  # outside region
    e1 = [_est("00000004", "0001", "02", "0", "5611201", "8802", "Bar")]   # no date
    _zip(batch, "Estabelecimentos0.zip", e0)
    _zip(batch, "Estabelecimentos1.zip", e1)
    comp = [["00000001", "ACME LTDA", "2062", "49", "1000,00", "01", None],
            ["00000001", "ACME DUP", "2062", "49", "1,00", "01", None],
            ["00000004", "BAR DO ZE", "2062", "49", "10,50", "05", None],
            ["00000005", "NOWHERE SA", "2062", "49", "1,00", "05", None]]
    _zip(batch, "Empresas0.zip", comp)

    # One establishment has no opening date: the load is refused, and nothing is switched.
    with pytest.raises(jobs.LoadRefused, match="estabelecimentos.data_inicio_atividade"):
        jobs.run_batch(spark, batch, tmp_dir)
    with pytest.raises(FileNotFoundError):
        jobs.table(spark, f"{tmp_dir}/warehouse", "empresas")
    out = jobs.run_batch(spark, batch, tmp_dir, waive=["estabelecimentos.data_inicio_atividade"])
    assert out["shards"][None] == 8  # 7 regional rows in shard 0 + 1 in shard 1
    assert out["estabelecimentos"] == 7 and out["empresas"] == 2
    wh = f"{tmp_dir}/warehouse"
    emp = {r.cnpj_basico: r.razao_social for r in jobs.table(spark, wh, "empresas").collect()}
    assert emp == {"00000001": "ACME LTDA", "00000004": "BAR DO ZE"}  # keep first, semi join
    stats = jobs.table(spark, wh, "estatisticas_crescimento").orderBy("ano_mes").collect()
    assert [(r.total_aberturas, str(r.variacao_pct)) for r in stats] == [(2, "None"), (4, "100.00")]
    mun = {r.codigo_municipio: r.uf for r in jobs.table(spark, wh, "municipios").collect()}
    assert mun == {"8801": "RS", "8802": "RS"}

    assert jobs.generate_insight(spark, wh, "texto", "modelo") == 1
    d = jobs.dashboard(spark, wh)
    assert d["kpis"].first().total_estabelecimentos == 7
    assert d["display"].count() == 7
    assert d["insight"].count() == 1
    cand = spark.createDataFrame(
        [("00000001000001", 2, '{"id": "p2"}'), ("00000001000001", 1, '{"id": "p1", "rating": 4.5}')],
        "cnpj string, rank int, payload string")
    enr = jobs.enrich(spark, wh, cand, n=50).collect()
    assert [(r.cnpj, r.place_id, str(r.rating_google)) for r in enr] == [("00000001000001", "p1", "4.5")]
