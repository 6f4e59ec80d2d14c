"""Range reads of quoted text: record borders, numbers, rejected records, archives."""
import csv
import io
import os
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from sectorpulse.session import local_dir
from sectorpulse.sources import records as RC
from sectorpulse.sources import zipsource as Z
from sectorpulse.sources.delimited import scan_delimited
from sectorpulse.sources.shards import keep_first_record

LAYOUT = ("codigo", "nome", "extra")


def _write(folder, name, data):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "wb") as f:
        f.write(data)


def generated(n, seed=0, end="\n", breaks=0.4):
    rng = random.Random(seed)
    word = lambda: rng.choice(["São", "a;b", 'q"uote', "x", "", "Zé", "long text here"])
    rows = []
    for i in range(n):
        text = word() + ("".join("\n" * rng.randrange(1, 3) + word() for _ in range(rng.randrange(5)))
                         if rng.random() < breaks else "")
        rows.append((str(i), text, word()))
    out = io.StringIO()
    csv.writer(out, delimiter=";", quoting=csv.QUOTE_ALL, lineterminator=end).writerows(rows)
    return rows, out.getvalue().encode("latin-1")


@pytest.fixture
def small_ranges(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("end", ["\n", "\r\n", "\r"])
def test_one_file_is_read_by_many_tasks(spark, tmp_dir, small_ranges, end):
    rows, data = generated(200, end=end)
    _write(local_dir(tmp_dir), "a.csv", data)
    df = RC.scan_ranges(spark, tmp_dir, LAYOUT)
    got = [tuple(r) for r in df.select(*LAYOUT, "linha").orderBy("linha").collect()]
    assert got == [(*(v or None for v in r), i) for i, r in enumerate(rows)]
    assert spark.read.text(tmp_dir).rdd.getNumPartitions() >= 5


def test_ranges_give_the_rows_of_scan_delimited(spark, tmp_dir, small_ranges):
    _, data = generated(120, seed=3)
    _write(local_dir(tmp_dir), "a.csv", data)
    _write(local_dir(tmp_dir), "b.csv", data[:len(data) // 2].rsplit(b'"\n"', 1)[0] + b'"')
    got = RC.scan_ranges(spark, tmp_dir, LAYOUT, keep_corrupt=True).drop("arquivo", "linha")
    want = scan_delimited(spark, tmp_dir, LAYOUT, keep_corrupt=True)
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, want.cache().collect()), key=key)


def test_every_border_inside_a_record(spark, tmp_dir):
    """Every place of a short text as the border of two ranges."""
    text = b'"1";"a\n""b"";\n\nc";"x"\n"2";"d";"\n"\n\n"3";"";"e"\n'
    want = [('"1";"a\n""b"";\n\nc";"x"', 0), ('"2";"d";"\n"', 1), ('"3";"";"e"', 2)]
    ends = [i + 1 for i, b in enumerate(text) if b == 10]
    rows = []
    for i, a in enumerate(ends):
        for j, b in enumerate(ends[i:]):
            cuts = [0, a, b, len(text)]
            rows += [(f"{i}-{j}", s, text[s:e]) for s, e in zip(cuts[:-1], cuts[1:]) if s < e]
    blocks = spark.createDataFrame(rows, "arquivo string, inicio long, valor binary").repartition(7)
    found = {}
    for r in RC.block_records(blocks).collect():
        found.setdefault(r.arquivo, []).append((r.registro, r.linha))
    assert len(found) == len({r[0] for r in rows})
    for name, got in found.items():
        assert sorted(got, key=lambda x: x[1]) == want, name


def test_a_field_longer_than_a_range(spark, tmp_dir, small_ranges):
    text = '"1";"' + "line\n" * 1000 + '";"x"\n"2";"b";"y"\n'
    _write(local_dir(tmp_dir), "a.csv", text.encode())
    got = RC.scan_ranges(spark, tmp_dir, LAYOUT).orderBy("linha").collect()
    assert [(r.codigo, len(r.nome), r.linha) for r in got] == [("1", 5000, 0), ("2", 1, 1)]


def test_empty_files_and_encodings(spark, tmp_dir):
    _write(local_dir(tmp_dir), "empty.csv", b"")
    _write(local_dir(tmp_dir), "blank.csv", b"\n\n")
    assert RC.scan_ranges(spark, tmp_dir, LAYOUT).count() == 0
    with pytest.raises(ValueError):
        RC.scan_ranges(spark, tmp_dir, LAYOUT, encoding="UTF-16")


def test_other_splits_in_the_second_pass_are_refused():
    lines = iter([("f", 7, __import__("pyarrow").array([b"x"]))])
    with pytest.raises(ValueError, match="split otherwise"):
        list(RC._glued(lines, {("f", 0): (0, 0)}, False))


def test_rejected_records_have_reasons_and_are_parted_in_one_pass(spark, tmp_dir):
    from sectorpulse.sinks.writes import land_parted
    _write(local_dir(tmp_dir) + "/in", "a.csv", b'"1";"a";"x"\n"2";"b"\n"3";"c;c";"y";"z"\n##\n"4";"d\nd";"w"\n')
    rows = RC.with_reason(RC.scan_ranges(spark, tmp_dir + "/in", LAYOUT, keep_corrupt=True), 3)
    counts = land_parted(rows, tmp_dir + "/out")
    assert counts == {"aceitos": 2, "rejeitados": 3}
    good = spark.read.parquet(tmp_dir + "/out/rejeitado=false").orderBy("linha")
    bad = spark.read.parquet(tmp_dir + "/out/rejeitado=true").orderBy("linha")
    assert [(r.codigo, r.nome, r.linha) for r in good.collect()] == [("1", "a", 0), ("4", "d\nd", 4)]
    assert [(r.linha, r.motivo, r._corrupt_record) for r in bad.collect()] == [
        (1, "campos a menos", '"2";"b"'), (2, "campos a mais", '"3";"c;c";"y";"z"'), (3, "campos a menos", "##")]
    with pytest.raises(Exception):
        RC.scan_ranges(spark, tmp_dir + "/in", LAYOUT, strict=True).collect()


def test_keep_first_over_raw_shards(spark, tmp_dir, small_ranges):
    _write(local_dir(tmp_dir), "s2.csv", b'"k";"late";"1"\n"m";"only";"2"\n')
    _write(local_dir(tmp_dir), "s1.csv", b'"j";"a\nb";"0"\n"k";"first";"1"\n"k";"second";"1"\n')
    got = keep_first_record(RC.scan_ranges(spark, tmp_dir, LAYOUT), ["codigo"])
    assert sorted((r.codigo, r.nome) for r in got.collect()) == [("j", "a\nb"), ("k", "first"), ("m", "only")]


def test_archives_are_parsed_in_blocks(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(Z, "BLOCK_BYTES", 600)
    d = local_dir(tmp_dir)
    os.makedirs(d, exist_ok=True)
    rows, data = generated(150, seed=9, end="\r\n")
    with zipfile.ZipFile(os.path.join(d, "S.zip"), "w") as zf:
        zf.writestr("S.CSV", data)
    blocks = list(Z._member_blocks("S.zip", os.path.join(d, "S.zip")))
    assert len(blocks) > 5 and b"".join(b.column(2)[0].as_py() for b in blocks) == data
    frame = spark.createDataFrame([tuple(c[0].as_py() for c in b.columns) for b in blocks], Z.BLOCKS)
    got = RC.parse(RC.block_records(frame), LAYOUT).orderBy("linha").collect()
    assert [(r.codigo, r.nome, r.extra, r.linha) for r in got] == [(*(v or None for v in r), i) for i, r in enumerate(rows)]
    assert Z.scan_zip(spark, d, LAYOUT).agg(F.count("*"), F.max("linha")).first()[:] == (150, 149)


def test_archives_in_a_store_that_only_spark_reads(spark, tmp_dir):
    d = local_dir(tmp_dir)
    os.makedirs(d, exist_ok=True)
    with zipfile.ZipFile(os.path.join(d, "S.zip"), "w") as zf:
        zf.writestr("S.CSV", b'"1";"a";"x"\n"2";"b"\n')
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.zips.link./in", f"file://{d}")
    rows = Z.scan_zip(spark, "viewfs://zips/in", LAYOUT, keep_corrupt=True).orderBy("linha").collect()
    assert [(r.codigo, r.shard, r._corrupt_record) for r in rows] == [("1", "S.zip", None), ("2", "S.zip", '"2";"b"')]


@pytest.fixture
def splits_by_bytes(spark):
    """Splits of a quarter of all bytes read (4 cores), however small the files are."""
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    yield
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_files_without_cut_records_count_for_the_splits(spark, tmp_dir, splits_by_bytes):
    """Leaving them out of the pass over the parts changed the splits of the others: F3."""
    _write(local_dir(tmp_dir), "a.csv", ('"1";"' + "line\n" * 1600 + '";"x"\n"2";"b";"y"\n').encode())
    _write(local_dir(tmp_dir), "b.csv", "".join(f'"{i}";"plain";"z"\n' for i in range(3, 500)).encode())
    got = RC.scan_ranges(spark, tmp_dir, LAYOUT).collect()
    assert sorted((int(r.codigo), len(r.nome), r.extra) for r in got) == [(1, 8000, "x"), (2, 1, "y"),
                                                                        *((i, 5, "z") for i in range(3, 500))]


@pytest.mark.parametrize("size", [None, "700"])
def test_a_field_left_open_at_the_end_of_a_file(spark, tmp_dir, size):
    """The last record is told though no border cuts it, and only once if one does."""
    text = "".join(f'"{i}";"plain";"z"\n' for i in range(100)) + '"100";"open\n' + "line\n" * 50
    _write(local_dir(tmp_dir), "a.csv", text.encode())
    if size:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        got = RC.text_records(spark, tmp_dir).orderBy("linha").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r.linha for r in got] == list(range(101))
    assert got[-1].registro == '"100";"open\n' + "line\n" * 49 + "line"


def test_wider_splits_in_the_second_pass_keep_all_records():
    """Splits of the second pass that join ranges of the first (fewer cores) are no error: no record may be lost."""
    import pyarrow as pa
    lines = [b'"1";"a";"x"', b'"2";"b";"y"', b'"3";"c', b'd";"z"']
    table, cut = {("f", 0): (0, 0), ("f", 10): (0, 1), ("f", 20): (1, 3)}, {"f"}
    told = lambda parts: [(r["linha"], r["registro"]) for b in RC._glued(
        iter([("f", 0, pa.array(lines[:3])), ("f", 20, pa.array(lines[3:]))]), table, parts, cut) for r in b.to_pylist()]
    assert told(False) == [(0, lines[0]), (1, lines[1])]
    assert told(True) == [(2, lines[2]), (2, lines[3])]


def test_the_splits_of_the_first_pass_are_held(spark, tmp_dir, splits_by_bytes):
    """Cores and settings that change between the passes change no split, and rows follow the caller's session: F1, F2."""
    rows, data = generated(300, seed=5)
    _write(local_dir(tmp_dir), "a.csv", data)
    spark.conf.set("spark.sql.leafNodeDefaultParallelism", "3")
    try:
        found = RC.scan_ranges(spark, tmp_dir, LAYOUT)
        lines = RC._text_lines(spark, tmp_dir)
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", "7")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "900")
        got = found.orderBy("linha").collect()
        assert lines.select("inicio").distinct().count() == lines.rdd.getNumPartitions() == 3   # no empty side
        assert found.sparkSession is spark
    finally:
        spark.conf.unset("spark.sql.leafNodeDefaultParallelism")
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [(r.codigo, r.nome, r.extra) for r in got] == [tuple(v or None for v in r) for r in rows]
