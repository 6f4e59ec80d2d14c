"""Raw text fixtures (FIXTURES.md §1) through the delimited and zip sources."""

import os
import zipfile

from sectorpulse.session import local_dir
from sectorpulse.sources.delimited import scan_delimited
from sectorpulse.sources.zipsource import list_archives, scan_zip, unpacked

LAYOUT = ("codigo", "nome", "extra")
# leading zeros, accented name, doubled quote with separator, empty quoted and
# empty unquoted, trailing backslash, CRLF, quoted line break, short row
RAW = ('"0001";"SÃO JERÔNIMO";"x"\r\n'
       '"0002";"a ""x"";y";""\n'
       '0003;;"tail\\"\n'
       '"0004";"line\nbreak";"z"\r\n'
       '"0005";"short"\n')
WANT = [("0001", "SÃO JERÔNIMO", "x"), ("0002", 'a "x";y', None), ("0003", None, "tail\\"),
        ("0004", "line\nbreak", "z"), ("0005", "short", None)]


def _write(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    p = os.path.join(folder, name)
    with open(p, "wb") as f:
        f.write(text.encode("latin-1"))
    return p


def test_scan_delimited_fixture(spark, tmp_dir):
    d = local_dir(tmp_dir)
    _write(d, "Municipios.csv", RAW)
    got = [tuple(r) for r in scan_delimited(spark, d, LAYOUT).orderBy("codigo").collect()]
    assert got == WANT


def test_scan_zip_fixture_and_order(spark, tmp_dir):
    d = local_dir(tmp_dir)
    os.makedirs(d, exist_ok=True)
    for i, text in enumerate([RAW, '"0009";"b";"c"\n']):
        with zipfile.ZipFile(os.path.join(d, f"Shard{i}.zip"), "w") as zf:
            zf.writestr(f"SHARD{i}.CSV", text.encode("latin-1"))
    df = scan_zip(spark, d, LAYOUT)
    got = [tuple(r) for r in df.orderBy("shard", "linha").collect()]
    assert [g[:3] for g in got] == WANT + [("0009", "b", "c")]
    assert [(g[3], g[4]) for g in got][:2] == [("Shard0.zip", 0), ("Shard0.zip", 1)]
    assert unpacked(spark, d).rdd.getNumPartitions() == 2  # one unpacking task per archive


def test_list_archives_errors_when_empty(tmp_dir):
    import pytest
    d = local_dir(tmp_dir)
    os.makedirs(d, exist_ok=True)
    with pytest.raises(FileNotFoundError):
        list_archives(os.path.join(d, "Estabelecimentos*.zip"))


def test_union_shards_prunes_batch_partition(spark, tmp_dir):
    from sectorpulse.sources.shards import union_shards
    df = spark.createDataFrame([("a", "2026-05"), ("b", "2026-06"), ("c", "2026-06")], "k string, lote string")
    df.write.partitionBy("lote").parquet(tmp_dir)
    out = union_shards(spark, tmp_dir, batch="2026-06")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(lote" in plan and "2026-06" in plan
    assert sorted(r.k for r in out.collect()) == ["b", "c"]
    assert {r.shard_nome for r in out.collect()} == {"lote=2026-06"}


def test_malformed_rows_permissive_and_strict(spark, tmp_dir):
    import pytest
    d = local_dir(tmp_dir)
    _write(d, "bad.csv", '"1";"a";"x"\n"2";"b";"y";"extra"\n')
    df = scan_delimited(spark, d, LAYOUT, keep_corrupt=True).cache()
    rows = {r.codigo: r for r in df.collect()}
    assert rows["1"]._corrupt_record is None
    assert rows["2"]._corrupt_record is not None  # kept, flagged, countable
    with pytest.raises(Exception):
        scan_delimited(spark, d, LAYOUT, strict=True).collect()
