"""Global order, carried statistics, the fold of all of Unicode, plans that read once."""
import datetime as dt
import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from sectorpulse.functions.text import ascii_fold, normalize_name, normalize_name_udf
from sectorpulse.operators import growth as G
from sectorpulse.operators import leads as L
from sectorpulse.operators import order as O
from sectorpulse.plans import jobs
from sectorpulse.sinks import writes as W


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ------------------------------------------------------------------ order

def test_positions_equal_a_sort(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice([None, 1, 2, 3]), rng.choice("abc")) for i in range(997)]
    df = spark.createDataFrame(rows, "k int, v int, w string").repartition(6)
    order = [F.col("v").desc_nulls_last(), F.col("w"), F.col("k")]
    out = O.positions(df, order, page=100)
    want = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[2], r[0]))
    got = {r.posicao: (r.k, r.v, r.w) for r in out.collect()}
    assert [got[i + 1] for i in range(len(rows))] == want
    assert "SinglePartition" not in plan_of(out)
    page = O.page_of(out, 3).collect()
    assert [r.posicao for r in page] == list(range(201, 301)) and {r.pagina for r in page} == {3}
    assert O.positions(df.limit(0), order).count() == 0


# ------------------------------------------------------------------ carried statistics

def establishments(spark, rows):
    return spark.createDataFrame([(c, m, 2, d) for c, m, d in rows],
                                 "cnae_principal string, codigo_municipio string, situacao_cadastral int, "
                                 "data_inicio_atividade date")


def generated(seed, n=1500):
    rng = random.Random(seed)
    return [(rng.choice(["A", "B", None]), rng.choice(["1", "2"]),
             dt.date(2020 + rng.randrange(3), 1 + rng.randrange(12), 1 + rng.randrange(28))) for _ in range(n)]


def test_batches_equal_one_full_run_and_read_no_old_rows(spark, tmp_dir):
    rows = generated(1)
    cuts = [dt.date(2020, 3, 1), dt.date(2020, 4, 1), dt.date(2021, 9, 1), dt.date(2023, 1, 1)]
    low = dt.date(2019, 1, 1)
    for high in cuts:
        got = jobs.advance_growth(spark, tmp_dir, establishments(spark, [r for r in rows if low <= r[2] < high]))
        assert got["atrasadas"] == 0
        low = high
    stored = W.read_current(spark, tmp_dir, "estatisticas_crescimento")
    full = G.growth_stats(establishments(spark, rows))
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, stored.select(*full.columns).collect()), key=key) == sorted(map(tuple, full.collect()), key=key)
    state = W.read_current(spark, tmp_dir, G.STATE)
    assert state.groupBy(*G.CELL).count().agg(F.max("count")).first()[0] == 6


def test_a_batch_run_twice_and_late_rows(spark, tmp_dir):
    a = establishments(spark, [("A", "1", dt.date(2020, 1, 5)), ("A", "1", dt.date(2020, 2, 5))])
    b = establishments(spark, [("A", "1", dt.date(2020, 2, 9)), ("A", "1", dt.date(2020, 3, 9)), ("B", "1", dt.date(2020, 1, 9))])
    jobs.advance_growth(spark, tmp_dir, a)
    state = W.read_current(spark, tmp_dir, G.STATE)
    new, kept, late = G.carried(state, G.monthly_openings(b))
    assert [(r.cnae_codigo, r.ano_mes.month) for r in late.collect()] == [("A", 2)]
    assert sorted((r.cnae_codigo, r.ano_mes.month, r.variacao_pct and float(r.variacao_pct)) for r in new.collect()) == [
        ("A", 3, 0.0), ("B", 1, None)]
    got = jobs.advance_growth(spark, tmp_dir, b)
    assert got == {"escritas": 2, "atrasadas": 1}


# ------------------------------------------------------------------ text

def test_normalize_name_equals_the_rule_on_every_code_point(spark):
    """A thousand code points a text, each between letters that show where it went."""
    points = [cp for cp in range(1, 0x110000) if not 0xD800 <= cp < 0xE000]
    texts = ["".join(f"{chr(cp)}q" for cp in points[i:i + 1000]) for i in range(0, len(points), 1000)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(8)
    got = df.select("i", normalize_name("t").alias("a"), normalize_name_udf("t").alias("b")).collect()
    for r in got:
        want = ascii_fold(texts[r.i]).strip().upper()
        assert r.a == want and r.b == want, r.i


def test_normalize_name_keeps_the_order_of_marks(spark):
    texts = ["A\u0323\u0307 ﬁ", "ｆｕｌｌ ½", "  é\x00x ", None, "", "Ⅷ㎏", unicodedata.normalize("NFD", "São João")]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: (r.a, r.b) for r in df.select("i", normalize_name("t").alias("a"), normalize_name_udf("t").alias("b")).collect()}
    for i, t in enumerate(texts):
        want = None if t is None else ascii_fold(t).strip().upper()
        assert got[i] == (want, want)


# ------------------------------------------------------------------ plans

@pytest.fixture
def tables(spark):
    from sectorpulse.bindings import Tables
    return Tables(spark, "/root/testdata/sf0.001")


def test_the_page_is_planned_once(tables):
    from sectorpulse.plans import queries as Q
    plan = plan_of(Q._recent_o(tables))
    assert "TakeOrderedAndProject" not in plan                  # the top-k has run; embeds read its rows
    assert plan.count("o_orderstatus") <= 2 * plan.count("FileScan")


def test_the_latest_month_reads_the_fact_table_once(tables):
    from sectorpulse.plans import queries as Q
    plan = plan_of(Q._top5_g(tables))
    assert plan.count("l_shipdate") > 0 and plan.count("lineitem.parquet") == 1
    assert "TakeOrderedAndProject" in plan


def test_latest_month_shows_only_described_rows_of_the_newest_month(spark):
    d = dt.date
    stats = spark.createDataFrame(
        [("A", "1", d(2020, 1, 1), 5, 10), ("A", "1", d(2020, 2, 1), 5, None), ("X", "1", d(2020, 2, 1), 5, 99),
         ("B", "1", d(2020, 2, 1), 5, 20), ("B", "9", d(2020, 2, 1), 5, 30), ("B", "2", d(2020, 2, 1), 5, 5)],
        "cnae_codigo string, codigo_municipio string, ano_mes date, total_aberturas int, variacao_pct int")
    sectors = spark.createDataFrame([("A", "a"), ("B", "b")], "codigo string, descricao string")
    towns = spark.createDataFrame([("1", "um"), ("2", "dois")], "codigo_municipio string, nome string")
    got = G.latest_month_top(stats, sectors, towns, n=5).collect()
    assert [(r.posicao, r.setor, r.municipio, r.variacao_pct) for r in got] == [(1, "b", "um", 20), (2, "b", "dois", 5)]
    assert G.latest_month_top(stats.where("ano_mes < '2020-02-01' or variacao_pct is null"), sectors, towns).count() == 0
    assert G.latest_month_top(stats.limit(0), sectors, towns).count() == 0


def test_all_leads_show_what_the_page_shows(tables):
    from sectorpulse.bindings import orders_municipalities, orders_sectors
    from sectorpulse.plans import queries as Q
    every = L.leads_display(L.all_leads(Q._est_o(tables), Q._companies_o(tables), orders_sectors(tables),
                                        orders_municipalities(tables), Q._enrichment_o(tables)))
    page = L.leads_display(Q._recent_o(tables)).drop("posicao")
    assert page.exceptAll(every.select(*page.columns)).count() == 0
