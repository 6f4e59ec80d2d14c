"""Responses, upserts, switches and pages as the review asked for them."""

from pyspark.sql import functions as F

from sectorpulse.operators import leads as L
from sectorpulse.sinks import writes as W


def test_first_place_of_a_response(spark):
    cand = spark.createDataFrame(
        [("a", 1, '{"places": [{"id": "p1", "rating": 4.5}, {"id": "p2"}]}'), ("b", 1, '{"places": []}'),
         ("b", 2, '{"places": [{"id": "late"}]}'), ("c", 1, "{}"), ("d", 1, None), ("e", 1, "broken")],
        "cnpj string, rank int, payload string")
    leads = spark.createDataFrame([(k,) for k in "abcdef"], "cnpj string")
    got = [(r.cnpj, r.place_id, str(r.rating_google)) for r in L.place_first_match(leads, cand).collect()]
    assert got == [("a", "p1", "4.5")]


def test_upsert_of_a_column_subset(spark):
    old = spark.createDataFrame([("a", 1, "SC"), ("b", 2, None)], "k string, v int, uf string")
    new = spark.createDataFrame([("a", 7), ("b", 8), ("c", 9), ("d", None)], "k string, v int")
    out = W.upsert(old, new, "k", defaults={"uf": "RS"})
    assert sorted(map(tuple, out.collect())) == [("a", 7, "SC"), ("b", 8, None), ("c", 9, "RS"), ("d", None, "RS")]


def test_defaults_leave_explicit_nulls(spark):
    df = spark.createDataFrame([("a", None)], "k string, uf string")
    assert W.with_defaults(df, {"uf": "RS", "n": 0}).first() == ("a", None, 0)


def test_tables_of_a_refresh_switch_together(spark, tmp_dir, monkeypatch):
    one = spark.createDataFrame([(1,)], "k int")
    W.refresh(spark, tmp_dir, {"a": one, "b": one})
    save, calls = W._save, []

    def dies(*args, **more):
        calls.append(args)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return save(*args, **more)

    monkeypatch.setattr(W, "_save", dies)
    try:
        W.refresh(spark, tmp_dir, {"a": one.limit(0), "b": one.limit(0)})
    except RuntimeError:
        pass
    assert [W.read_current(spark, tmp_dir, t).count() for t in "ab"] == [1, 1]


def test_export_keeps_the_page_order(spark, tmp_dir):
    page = spark.range(200).repartition(7).select((F.lit(200) - F.col("id")).cast("int").alias("posicao"),
                                                  F.col("id").cast("string").alias("cnpj"))
    path = W.export_csv(page, tmp_dir, header=("CNPJ",), order="posicao")
    back = [r[0] for r in spark.read.option("header", True).csv(path).collect()]
    assert back == [str(i) for i in range(199, -1, -1)]


def test_one_batch_is_pruned(spark, tmp_dir):
    from sectorpulse.sources.shards import union_shards
    spark.range(10).withColumn("lote", F.concat(F.lit("b"), F.col("id") % 2)).write.partitionBy("lote").parquet(tmp_dir)
    out = union_shards(spark, tmp_dir, batch="b1")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(lote" in plan and out.count() == 5
