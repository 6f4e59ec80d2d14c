"""Catalogue tables: switches, bucket-wise upserts, clocks, file names."""
import glob
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sectorpulse import schemas
from sectorpulse.session import local_dir
from sectorpulse.sinks import writes as W

KV = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.StringType())])


def rows(spark, pairs, schema="k string, v string"):
    return spark.createDataFrame(pairs, schema)


def files(root):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{local_dir(root)}/**/*.parquet", recursive=True)}


def test_upsert_rewrites_only_the_buckets_of_its_keys(spark, tmp_dir):
    W.upsert_table(spark, tmp_dir, "t", rows(spark, [(str(i), "old") for i in range(400)]), "k", KV)
    table = W.current_tables(spark, tmp_dir)["t"]
    before = files(tmp_dir)
    assert len({os.path.dirname(f) for f in before}) == W.BUCKETS
    out = W.upsert_table(spark, tmp_dir, "t", rows(spark, [("7", "new"), ("x", "new")]), "k", KV)
    assert W.current_tables(spark, tmp_dir)["t"] == table                      # same table, no new copy
    after = files(tmp_dir)
    touched = {r[0] for r in rows(spark, [("7", ""), ("x", "")]).select(W.bucket_of(["k"], W.BUCKETS)).collect()}
    folders = {os.path.dirname(f) for f in set(before) ^ set(after)}
    assert {int(f.rsplit("=", 1)[1]) for f in folders} == touched
    assert all(after[f] == t for f, t in before.items() if os.path.dirname(f) not in folders)
    got = {r.k: r.v for r in out.collect()}
    assert len(got) == 401 and [k for k, v in got.items() if v == "new"].__len__() == 2


def test_upsert_scan_prunes_buckets(spark, tmp_dir):
    W.upsert_table(spark, tmp_dir, "t", rows(spark, [(str(i), "old") for i in range(50)]), "k", KV)
    plan = W.touched_rows(spark, W.current_tables(spark, tmp_dir)["t"], [2, 5])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "balde" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "balde" not in W.read_current(spark, tmp_dir, "t").columns


def test_upsert_equals_plain_merge_with_null_keys_defaults_and_order(spark, tmp_dir):
    schema = T.StructType.fromDDL("k string, v string, uf string")
    first = rows(spark, [("a", "1", "SC"), ("b", "2", "RS"), (None, "n", "PR")], "k string, v string, uf string")
    W.upsert_table(spark, tmp_dir, "t", first, "k", schema, buckets=3)
    later = rows(spark, [("b", "x", 1), ("b", "y", 2), ("c", "z", 1), (None, "m", 3)], "k string, v string, seq int")
    plain = W.upsert(first, later, "k", seq="seq", defaults={"uf": "RS"})
    out = W.upsert_table(spark, tmp_dir, "t", later, "k", schema, seq="seq", defaults={"uf": "RS"})
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, out.collect()), key=key) == sorted(map(tuple, plain.collect()), key=key) == sorted(
        [("a", "1", "SC"), ("b", "y", "RS"), ("c", "z", "RS"), (None, "m", "RS"), (None, "n", "PR")], key=key)
    assert W.buckets_of(spark, W.current_tables(spark, tmp_dir)["t"]) == 3


def test_upsert_after_a_refresh_deals_the_table_into_buckets(spark, tmp_dir):
    W.refresh(spark, tmp_dir, {"t": rows(spark, [("a", "1")])}, cascade={"u": KV})
    assert W.buckets_of(spark, W.current_tables(spark, tmp_dir)["t"]) is None
    assert W.upsert_table(spark, tmp_dir, "t", rows(spark, [("b", "2")]), "k", KV).count() == 2
    assert W.upsert_table(spark, tmp_dir, "u", rows(spark, [("b", "2")]), "k", KV).count() == 1
    assert W.upsert_table(spark, tmp_dir, "t", rows(spark, []), "k", KV).count() == 2        # nothing comes in
    W.refresh(spark, tmp_dir, {"t": rows(spark, [("z", "9")])})
    assert [r.k for r in W.read_current(spark, tmp_dir, "t").collect()] == ["z"]
    assert len(W.drop_old(spark, tmp_dir)) == 3 and W.drop_old(spark, tmp_dir) == []
    assert W.read_current(spark, tmp_dir, "u").count() == 1


def test_all_tables_of_a_refresh_switch_together(spark, tmp_dir):
    one, two = rows(spark, [("a", "1")]), rows(spark, [("a", "2")])
    W.refresh(spark, tmp_dir, {"t": one, "u": one})
    broken = two.withColumn("v", F.raise_error(F.lit("stop")).cast("string"))
    with pytest.raises(Exception, match="stop"):
        W.refresh(spark, tmp_dir, {"t": two, "u": broken})
    assert [W.read_current(spark, tmp_dir, t).first().v for t in ("t", "u")] == ["1", "1"]


def test_enrichment_moves_the_clock_and_reference_does_not(spark, tmp_dir):
    inc = spark.createDataFrame([("1", "p", None, None, None, None, None)], schemas.ENRICHMENT)
    a = W.upsert_table(spark, tmp_dir, "e", inc, "cnpj", schemas.ENRICHMENT_STORED, touch="enriquecido_em").first()
    b = W.upsert_table(spark, tmp_dir, "e", inc, "cnpj", schemas.ENRICHMENT_STORED, touch="enriquecido_em").first()
    c = W.upsert_table(spark, tmp_dir, "e", inc, "cnpj", schemas.ENRICHMENT_STORED).first()
    assert a.enriquecido_em < b.enriquecido_em == c.enriquecido_em


def test_partitioned_writes_gather_a_value_before_writing(spark, tmp_dir):
    df = spark.range(4000, numPartitions=16).withColumn("shard", F.col("id") % 5)
    W.counted_write(df, tmp_dir, partition_by=["shard"])
    assert len(files(tmp_dir)) <= 2 * 5                                        # not 16 x 5
