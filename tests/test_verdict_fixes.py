"""Plans and writers that a review found wanting."""

import csv
import io
import zipfile

import pytest
from pyspark.sql import functions as F

from sectorpulse.operators.embed import embed_left
from sectorpulse.operators.registry import companies_semi
from sectorpulse.sinks import writes as W


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_embed_shuffles_no_dimension(spark):
    """With automatic broadcast off (large dimensions), only bounded sides are sent."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        top = spark.range(5).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
        dim = spark.range(3, 1000).select(F.col("id").alias("code"), F.concat(F.lit("n"), "id").alias("name"))
        out = embed_left(top, dim, {"k": "code"}, "d", ["name"])
        assert "SortMergeJoin" not in plan_of(out)
        assert sorted((r.k, r.v, r.d and r.d.name) for r in out.collect()) == [
            (0, 0, None), (1, 2, None), (2, 4, None), (3, 6, "n3"), (4, 8, "n4")]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_embed_of_a_repeated_key_doubles_no_row(spark):
    top = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    dim = spark.createDataFrame([(1, "b"), (1, "a"), (1, None), (None, "n"), (3, "z")], "code int, name string")
    out = embed_left(top, dim.where("name IS NOT NULL"), {"k": "code"}, "d", ["name"]).collect()
    assert sorted((r.k or 0, r.d and r.d.name) for r in out) == [(0, None), (1, "a"), (2, None)]
    assert [r.d.name for r in embed_left(top, dim, {"k": "code"}, "d", ["name"]).collect() if r.k == 1] == [None]


def test_semi_join_combines_hot_keys_first(spark):
    companies = spark.range(20).select(F.col("id").cast("string").alias("cnpj_basico"))
    branches = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50)
                                         .cast("string").alias("cnpj_basico"))
    out = companies_semi(companies, branches)
    assert "partial" in plan_of(out) or "HashAggregate" in plan_of(out)
    assert out.count() == 20


def test_upsert_without_order_keeps_one_row_per_key(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    new = spark.createDataFrame([("a", 5), ("a", 9), ("c", 3)], "k string, v int")
    assert sorted(map(tuple, W.upsert(old, new, "k").collect())) == [("a", 9), ("b", 2), ("c", 3)]


def test_missing_marker_of_a_written_table_raises(spark, tmp_dir):
    schema = spark.createDataFrame([("a", 1)], "k string, v int").schema
    assert W.read_current(spark, tmp_dir, "t", schema).count() == 0          # never written
    W._save(spark, tmp_dir, "t", spark.createDataFrame([("a", 1)], schema))
    with pytest.raises(FileNotFoundError):                                   # written, but not switched to
        W.read_current(spark, tmp_dir, "t", schema)


def test_a_stop_between_write_and_switch_keeps_the_old_version(spark, tmp_dir):
    first = spark.createDataFrame([("a", 1)], "k string, v int")
    W.refresh(spark, tmp_dir, {"t": first})
    W._save(spark, tmp_dir, "t", first.limit(0))                             # the job dies here
    assert W.read_current(spark, tmp_dir, "t").count() == 1
    W.refresh(spark, tmp_dir, {"t": first.union(first)})
    assert W.read_current(spark, tmp_dir, "t").count() == 2


def test_zip_fields_of_any_length_and_strict_mode(spark, tmp_path):
    from sectorpulse.sources.zipsource import scan_zip

    text = io.StringIO()
    csv.writer(text, delimiter=";", quoting=csv.QUOTE_ALL).writerows([["x" * 200_000, "b"], ["c"]])
    path = tmp_path / "a.zip"
    with zipfile.ZipFile(path, "w") as zf:
        zf.writestr("a.csv", text.getvalue().encode("latin-1"))
    rows = scan_zip(spark, str(path), ("p", "q")).orderBy("linha").collect()
    assert [len(rows[0]["p"]), rows[1]["q"]] == [200_000, None]
    with pytest.raises(Exception):
        scan_zip(spark, str(path), ("p", "q"), strict=True).collect()
