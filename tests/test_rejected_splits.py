"""Rejected records of orders whose shards are read in several splits, not all of them cutting a record."""
import datetime
import os

import pytest

from sectorpulse.plans.queries import QUERIES
from sectorpulse.session import local_dir

# Shard 0 has a line break in each record, shard 1 has none.
KEYS = [12 * i + s for i in range(400) for s in (0, 1)]
DAY = datetime.date(1995, 3, 7)


def _kind(key):
    return {1: "curto", 2: "longo", 3: "solto"}.get(key % 97, "")


@pytest.fixture
def orders_dir(spark, tmp_dir):
    d = local_dir(tmp_dir)
    os.makedirs(d)
    rows = spark.createDataFrame([(k, DAY) for k in KEYS], "o_orderkey long, o_orderdate date")
    rows.coalesce(1).write.parquet(f"{tmp_dir}/orders.parquet")
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    yield tmp_dir
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_rejected_counts_of_shards_in_several_splits(spark, orders_dir):
    got = {r[0]: tuple(r)[1:] for r in QUERIES["rejected_counts"](spark, orders_dir).collect()}

    def told(keys):
        kinds = [_kind(k) for k in keys]
        return (len(kinds), kinds.count(""), kinds.count("curto") + kinds.count("solto"), kinds.count("longo"), 0)

    assert got == {None: told(KEYS), 0: told(k for k in KEYS if k % 4 == 0), 1: told(k for k in KEYS if k % 4 == 1)}


def test_rejected_records_of_shards_in_several_splits(spark, orders_dir):
    got = sorted(tuple(r) for r in QUERIES["rejected_records"](spark, orders_dir).collect())
    want = []
    for key in KEYS:
        head = f'"{key}";"PEDIDO {key}' + ('\nsala; ""x""' if key % 3 == 0 else "") + '"'
        if _kind(key) == "curto":
            want.append((key % 4, "campos a menos", head))
        elif _kind(key) == "longo":
            want.append((key % 4, "campos a mais", f'{head};"19950307";"sobra"'))
        elif _kind(key) == "solto":
            want.append((key % 4, "campos a menos", f"### {key}"))
    assert got == sorted(want)
    assert {shard for shard, _, _ in got} == {0, 1}


@pytest.fixture
def cores_change(spark, orders_dir, monkeypatch):
    """The text is split for two cores in the first pass; five are there when the records are read."""
    from sectorpulse.sinks import writes
    plain = writes.land_parted

    def late(rows, *args):
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", "5")
        return plain(rows, *args)

    monkeypatch.setattr(writes, "land_parted", late)
    spark.conf.set("spark.sql.leafNodeDefaultParallelism", "2")
    yield orders_dir
    spark.conf.unset("spark.sql.leafNodeDefaultParallelism")


def test_rejected_counts_though_cores_change_between_the_passes(spark, cores_change):
    test_rejected_counts_of_shards_in_several_splits(spark, cores_change)


def test_rejected_records_though_cores_change_between_the_passes(spark, cores_change):
    test_rejected_records_of_shards_in_several_splits(spark, cores_change)


def test_rejected_records_of_negative_keys(spark, tmp_dir):
    os.makedirs(local_dir(tmp_dir))
    rows = spark.createDataFrame([(k, DAY) for k in (-3, -95, -96, 2, 98)], "o_orderkey long, o_orderdate date")
    rows.write.parquet(f"{tmp_dir}/orders.parquet")
    got = sorted(tuple(r) for r in QUERIES["rejected_records"](spark, tmp_dir).collect())
    assert got == [(2, "campos a mais", '"2";"PEDIDO 2";"19950307";"sobra"'), (2, "campos a menos", '"98";"PEDIDO 98"')]


def test_rejected_records_without_orders(spark, tmp_dir):
    os.makedirs(local_dir(tmp_dir))
    spark.createDataFrame([], "o_orderkey long, o_orderdate date").write.parquet(f"{tmp_dir}/orders.parquet")
    got = QUERIES["rejected_records"](spark, tmp_dir)
    assert got.columns == ["shard", "motivo", "texto"] and got.collect() == []
