"""Keep-first, semi join, upsert, refresh and export (FIXTURES.md §4)."""

from pyspark.sql import functions as F

from sectorpulse.operators import registry as R
from sectorpulse.operators import region as RG
from sectorpulse.sinks import writes as W


def test_keep_first_file_order(spark):
    df = spark.createDataFrame([("1", "a", "s0", 0), ("1", "b", "s0", 1), ("2", "c", "s1", 0)],
                               "k string, v string, shard string, linha long")
    got = sorted(tuple(r) for r in R.keep_first(df, "k", ["shard", "linha"]).select("k", "v").collect())
    assert got == [("1", "a"), ("2", "c")]


def test_keep_first_is_an_aggregate(spark):
    df = spark.createDataFrame([("1", "a")], "k string, v string")
    plan = R.keep_first(df, "k")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and ("ObjectHashAggregate" in plan or "SortAggregate" in plan
                                     or "HashAggregate" in plan)


def test_semi_then_first_equals_first_then_semi(spark):
    comp = spark.createDataFrame(
        [("1", "a", "s0", 0), ("1", "b", "s1", 0), ("2", "c", "s0", 1), ("3", "d", "s0", 2)],
        "cnpj_basico string, razao_social string, shard string, linha long")
    est = spark.createDataFrame([("1",), ("3",), ("3",)], "cnpj_basico string")
    a = R.keep_first(R.companies_semi(comp, est), "cnpj_basico", ["shard", "linha"])
    b = R.companies_semi(R.keep_first(comp, "cnpj_basico", ["shard", "linha"]), est)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_upsert_golden_and_idempotent(spark):
    existing = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    incoming = spark.createDataFrame([(2, "x", 1), (3, "y", 2), (3, "z", 3)], "k int, v string, seq int")
    once = W.upsert(existing, incoming, "k", seq="seq")
    assert sorted(map(tuple, once.collect())) == [(1, "a"), (2, "x"), (3, "z")]
    twice = W.upsert(once, incoming, "k", seq="seq")
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, once.collect()))


def test_refresh_switches_versions_and_cascades(spark, tmp_dir):
    from sectorpulse import schemas
    a = spark.createDataFrame([(1,), (2,)], "k int")
    counts = W.refresh(spark, tmp_dir, {"t": a}, cascade={"leads_enriquecidos": schemas.ENRICHMENT})
    assert counts == {"t": 2, "leads_enriquecidos": 0}
    b = spark.createDataFrame([(3,)], "k int")
    W.refresh(spark, tmp_dir, {"t": b})
    assert [r.k for r in W.read_current(spark, tmp_dir, "t").collect()] == [3]
    assert W.read_current(spark, tmp_dir, "leads_enriquecidos").count() == 0


def test_upsert_table_twice_equals_once(spark, tmp_dir):
    schema = "k int, v string"
    from pyspark.sql import types as T
    st = T.StructType.fromDDL(schema)
    inc = spark.createDataFrame([(1, "a"), (2, "b")], schema)
    W.upsert_table(spark, tmp_dir, "t", inc, "k", st)
    out = W.upsert_table(spark, tmp_dir, "t", inc, "k", st)
    assert sorted(map(tuple, out.collect())) == [(1, "a"), (2, "b")]


def test_export_quotes_separators(spark, tmp_dir):
    df = spark.createDataFrame([("1", "a;b", None)], "cnpj string, nome string, tel string")
    path = W.export_csv(df, tmp_dir, header=("CNPJ", "Razão Social", "Telefone"), day="2026-01-02")
    assert path.endswith("leads_2026-01-02")
    back = spark.read.option("sep", ";").option("header", True).csv(path).collect()
    assert tuple(back[0]) == ("1", "a;b", None)


def test_region_codes_and_missing(spark):
    mun = spark.createDataFrame([("0001", "Porto Alegre"), ("0002", " Gravataí "), ("0003", "Pelotas")],
                                "codigo_municipio string, nome string")
    codes = sorted(r[0] for r in RG.region_codes(mun).collect())
    assert codes == ["0001", "0002"]
    missing = [r[0] for r in RG.region_missing(mun).collect()]
    assert "PORTO ALEGRE" not in missing and "GRAVATAI" not in missing and len(missing) == 32
    assert missing == sorted(missing)


def test_filter_region_pushes_in_list(spark, tmp_dir):
    est = spark.createDataFrame([("a", "0001"), ("b", "0003")], "cnpj string, codigo_municipio string")
    est.write.parquet(tmp_dir)
    codes = spark.createDataFrame([("0001",)], "codigo_municipio string")
    out = RG.filter_region(spark.read.parquet(tmp_dir), codes)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(codigo_municipio" in plan or "EqualTo(codigo_municipio" in plan
    assert [r.cnpj for r in out.collect()] == ["a"]
