"""Growth statistics: FIXTURES.md golden, the C2 tie, exactness against
fractions, and plan shape."""

import datetime as dt
from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sectorpulse.functions import hundredths_to_pct, variation_hundredths
from sectorpulse.operators import growth as G


def _establishments(spark, monthly):
    rows = []
    k = 0
    for month, n in monthly:
        for i in range(n):
            rows.append((f"c{k}", "6201501", "4314902", dt.date(2026, month, 1 + i % 27), 2))
            k += 1
    rows.append(("closed", "6201501", "4314902", dt.date(2026, 1, 1), 8))
    rows.append(("nodate", "6201501", "4314902", None, 2))
    return spark.createDataFrame(rows, "cnpj string, cnae_principal string, codigo_municipio string, "
                                       "data_inicio_atividade date, situacao_cadastral smallint")


def test_growth_golden(spark):
    monthly = [(1, 2), (2, 4), (4, 6), (5, 3), (6, 3), (7, 5), (8, 1), (9, 8)]
    stats = G.growth_stats(_establishments(spark, monthly)).orderBy("ano_mes").collect()
    got = [(r.ano_mes.month, r.total_aberturas, None if r.variacao_pct is None else str(r.variacao_pct))
           for r in stats]
    assert got == [(1, 2, None), (2, 4, "100.00"), (4, 6, "100.00"), (5, 3, "-25.00"),
                   (6, 3, "-20.00"), (7, 5, "38.89"), (8, 1, "-73.91"), (9, 8, "118.18")]


def test_exact_tie(spark):
    monthly = [(1, 10), (2, 10), (3, 11), (4, 11), (5, 11), (6, 11), (7, 11)]
    last = G.growth_stats(_establishments(spark, monthly)).orderBy(F.desc("ano_mes")).first()
    assert str(last.variacao_pct) == "3.13"


def _exact(t, s, n):
    v = (Fraction(t) - Fraction(s, n)) / Fraction(s, n) * 100
    q = (abs(v) * 100).numerator * 2 + (abs(v) * 100).denominator
    h = q // (2 * (abs(v) * 100).denominator)
    return Decimal(-h if v < 0 else h) / 100


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 10_000), st.integers(1, 6)), min_size=1, max_size=30),
       st.data())
def test_variation_matches_fractions(spark, pairs, data):
    rows = []
    for t, n in pairs:
        s = data.draw(st.integers(n, 40 * n))
        rows.append((t, s, n))
    df = spark.createDataFrame(rows, "t int, s long, n long")
    got = [r[0] for r in df.select(hundredths_to_pct(variation_hundredths("t", "s", "n"), 12)).collect()]
    for (t, s, n), g in zip(rows, got):
        want = (Decimal(t * n - s) * 100 / Decimal(s)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
        assert g == want == _exact(t, s, n), (t, s, n, g, want)


def test_growth_plan_is_jvm_only(spark):
    df = G.growth_stats(_establishments(spark, [(1, 2), (2, 3)]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "Window" in plan and "HashAggregate" in plan


def test_ranking_uses_top_k(spark):
    stats = G.growth_stats(_establishments(spark, [(1, 2), (2, 6), (3, 7)]))
    r = G.growth_ranking(stats, n=8, min_openings=5)
    assert "TakeOrderedAndProject" in r._jdf.queryExecution().executedPlan().toString()
    assert [x.posicao for x in r.collect()] == [1, 2]


def test_stored_table_pushes_status_and_date(spark, tmp_dir):
    est = _establishments(spark, [(1, 2), (2, 3)])
    est.write.parquet(tmp_dir)
    df = G.growth_stats(spark.read.parquet(tmp_dir))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(situacao_cadastral,2)" in plan
    assert "IsNotNull(data_inicio_atividade)" in plan
    assert "cnpj" not in plan.split("ReadSchema:")[1].split("\n")[0]  # pruned
