"""Scale properties: results do not depend on partitioning, and a key that
holds a third of the rows is reduced map-side, never collected whole."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from sectorpulse.operators import leads as L
from sectorpulse.operators import registry as R

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables absent")
@pytest.mark.parametrize("key", ["growth_stats", "lead_ranking", "companies_keep_first", "recent_leads"])
def test_partition_count_does_not_change_results(spark, key):
    out = []
    for n in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        df = E.queries()[key](spark, SF)
        out.append(sorted(map(repr, map(tuple, df.collect()))))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert out[0] == out[1]


def _hot(spark, n=3000):
    # key 'hot' holds a third of the rows
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("ordem"), (F.col("id") * 7 % 11).cast("string").alias("payload"))


def test_hot_key_keep_first_combines_map_side(spark):
    df = _hot(spark).repartition(8)
    kept = R.keep_first(df, "k", ["ordem"])
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan
    row = kept.where(F.col("k") == "hot").first()
    assert row.ordem == 0 and kept.count() == 2001


def test_hot_key_first_candidate_before_join(spark):
    cand = _hot(spark).withColumnRenamed("k", "cnpj").withColumnRenamed("ordem", "rank") \
        .withColumn("payload", F.to_json(F.struct(F.col("payload").alias("id"))))
    leads = spark.createDataFrame([("hot",), ("1",), ("nope",)], "cnpj string")
    out = L.place_first_match(leads, cand)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan
    got = sorted((r.cnpj, r.place_id) for r in out.collect())
    assert got == [("1", "7"), ("hot", "0")]
