"""Records of quoted text, read by byte ranges in parallel.

A quoted field may hold line breaks, so a range that starts in the middle of a
file does not know whether its first line starts a record. Two passes settle it:

1. every range counts its quotes and, for either answer, the lines that would
   start a record. Quotes come in pairs inside a record, so the sum of the quotes
   of all earlier ranges tells, by its parity, whether a range starts inside a
   quoted field; the sum of the record starts of the earlier ranges numbers its
   first record. Both are prefix sums over one row a range;
2. every range glues its lines to records, knowing where it stands. A record that
   crosses a border leaves a part in each range it touches; the parts, at most two a
   range, meet by their record number.

The ranges are Spark's own splits of the text (lines belong to the range they
start in), or blocks of an unpacked archive. A file's size does not bound the
number of tasks, and a record's number is its place in the file, gapless from 0,
whatever the ranges are. Lines end in LF, CRLF or CR and are glued by LF (C18).

Limits: a quote character stands only around a field or doubled inside one; the
encoding is a superset of ASCII (not UTF-16). Lines without any character
between records are no records.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence, Set

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import all_string
from .delimited import CORRUPT, delimited_options

# One entry (a few numbers) for each range goes to the driver and to the tasks of the second
# pass. Spark's driver plans every one of them as an input split anyway.
MAX_RANGES = 2_000_000
Lines = Iterator[tuple[str, int, pa.BinaryArray]]   # (file, start of the range, some of its lines in order)


# ------------------------------------------------------------------ lines of a task

def _of_text(batches: Iterator[pa.RecordBatch]) -> Lines:
    """Rows (arquivo, inicio, valor): one line each, ranges one after the other."""
    for batch in batches:
        if not batch.num_rows:
            continue
        files, starts = batch.column("fonte").to_numpy(), batch.column("inicio").to_numpy()
        cuts = np.flatnonzero((files[1:] != files[:-1]) | (starts[1:] != starts[:-1])) + 1
        for first, end in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            yield batch.column("arquivo")[first].as_py(), int(starts[first]), batch.column("valor").slice(first, end - first)


def _of_blocks(batches: Iterator[pa.RecordBatch]) -> Lines:
    """Rows (arquivo, inicio, valor): whole blocks that end at a line end."""
    for batch in batches:
        for i in range(batch.num_rows):
            text = batch.column("valor")[i].as_py().replace(b"\r\n", b"\n").replace(b"\r", b"\n")
            lines = text.split(b"\n")
            if not lines[-1]:
                lines.pop()
            yield batch.column("arquivo")[i].as_py(), batch.column("inicio")[i].as_py(), pa.array(lines, pa.binary())


def _shape(lines: pa.BinaryArray, state: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(inside a field before each line, empty line, state behind) from the state before the lines."""
    odd = pc.count_substring(lines, b'"').to_numpy(zero_copy_only=False).astype(np.int64) & 1
    behind = (state + np.cumsum(odd)) & 1
    empty = pc.binary_length(lines).to_numpy(zero_copy_only=False) == 0
    return (behind ^ odd).astype(bool), empty, int(behind[-1]) if len(behind) else state


def _measured(lines: Lines) -> Iterator[pa.RecordBatch]:
    """One row a range: parity of its quotes, records it starts if it begins outside or inside a field."""
    now, row = None, [0, 0, 0]

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([now[0]]), *(pa.array([x], pa.int64()) for x in (now[1], *row))],
                                          names=["arquivo", "inicio", "aspas", "fora", "dentro"])

    for file, start, some in lines:
        if (file, start) != now:
            if now is not None:
                yield out()
            now, row = (file, start), [0, 0, 0]
        inside, empty, row[0] = _shape(some, row[0])
        row[1] += int((~inside & ~empty).sum())
        row[2] += int((inside & ~empty).sum())
    if now is not None:
        yield out()


RANGE_SCHEMA = "arquivo string, inicio long, aspas long, fora long, dentro long"


def range_table(measured: DataFrame, per_folder: bool = False) -> DataFrame:
    """(arquivo, inicio, estado, primeira, registros, aberto): whether each range starts inside a field, the number
    of its first record, its records, and whether it ends inside a field. Prefix sums over the ranges of one file;
    with ``per_folder`` records are numbered through all files of a folder in order of their names (a shard written
    as several files)."""
    before = Window.partitionBy("arquivo").orderBy("inicio").rowsBetween(Window.unboundedPreceding, -1)
    through = before if not per_folder else Window.partitionBy(F.regexp_extract("arquivo", "^(.*)/", 1)).orderBy(
        "arquivo", "inicio").rowsBetween(Window.unboundedPreceding, -1)
    state = F.coalesce(F.sum("aspas").over(before), F.lit(0)) % 2
    known = measured.withColumn("estado", state)
    starts = F.when(F.col("estado") == 0, F.col("fora")).otherwise(F.col("dentro"))
    return (known.withColumn("registros", starts)
                 .withColumn("primeira", F.coalesce(F.sum("registros").over(through), F.lit(0)))
                 .withColumn("aberto", (F.col("estado") + F.col("aspas")) % 2)
                 .select("arquivo", "inicio", "estado", "primeira", "registros", "aberto"))


class _Range:
    """Glues the lines of one range to numbered records."""

    def __init__(self, state: int, first: int):
        self.state, self.number = state, first
        self.open: list[pa.Array] = []         # lines of the record that is not closed yet
        self.head = bool(state)                # it began in an earlier range
        self.done: list[tuple[int, pa.Array]] = []
        self.parts: list[tuple[int, bytes]] = []

    def _close(self) -> None:
        text = b"\n".join(x for some in self.open for x in some.to_pylist())
        if self.head:
            self.parts.append((self.number - 1, text))
        else:
            self.done.append((self.number, pa.array([text], pa.binary())))
            self.number += 1
        self.open, self.head = [], False

    def feed(self, lines: pa.BinaryArray) -> None:
        inside, empty, behind = _shape(lines, self.state)
        keep = inside | ~empty
        if not keep.all():
            lines, inside = lines.filter(pa.array(keep)), inside[keep]
        starts = np.flatnonzero(~inside)
        first = int(starts[0]) if len(starts) else len(lines)
        if first:
            self.open.append(lines.slice(0, first))
        if (self.open or self.head) and (len(starts) or not behind):
            self._close()
        self.state = behind
        if len(starts):
            if behind:                         # the last record goes on behind these lines
                self.open, starts, lines = [lines.slice(int(starts[-1]))], starts[:-1], lines.slice(0, int(starts[-1]))
            rest = lines.slice(first)
            if len(starts) == len(rest):       # no line break inside a field: nothing to glue
                whole = rest
            else:
                offsets = np.append(starts - first, len(rest)).astype(np.int32)
                whole = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), rest), pa.scalar(b"\n", pa.binary()))
            if len(whole):
                self.done.append((self.number, whole))
                self.number += len(whole)

    def end(self) -> None:
        if self.open or (self.head and self.state):
            text = b"\n".join(x for some in self.open for x in some.to_pylist())
            self.parts.append((self.number - 1 if self.head else self.number, text))


def _glued(lines: Lines, table: dict, parts: bool, cut: Set[str] = frozenset()) -> Iterator[pa.RecordBatch]:
    """Whole records of all ranges, or the parts that borders cut, of the files ``cut``."""
    now, part = None, None

    def out(file: str, start: int, numbers: pa.Array, texts: pa.Array) -> pa.RecordBatch:
        n = len(texts)
        return pa.RecordBatch.from_arrays([pa.array([file] * n if n < 2 else pa.repeat(file, n), pa.string()), numbers,
                                           pa.array(np.full(n, start, dtype=np.int64)), texts],
                                          names=["arquivo", "linha", "inicio", "registro"])

    def told(last: bool) -> Iterator[pa.RecordBatch]:
        if last:
            part.end()
        if parts:
            for number, text in part.parts if last else []:
                yield out(*now, pa.array([number], pa.int64()), pa.array([text], pa.binary()))
        else:
            for number, texts in part.done:
                yield out(*now, pa.array(np.arange(number, number + len(texts), dtype=np.int64)), texts)
        part.done = []

    for file, start, some in lines:
        if (file, start) != now:
            if now is not None:
                yield from told(True)
            if (file, start) not in table:
                raise ValueError(f"{file} was split otherwise in the first pass (no range at {start})")
            now, part = (file, start), _Range(*table[file, start])
        if parts and file not in cut:
            continue
        part.feed(some)
        yield from told(False)
    if now is not None:
        yield from told(True)


# ------------------------------------------------------------------ records

def _records(spark: SparkSession, lines: DataFrame, split: Callable, encoding: str, per_folder: bool = False) -> DataFrame:
    """(arquivo, linha, registro) of ``lines`` (arquivo, inicio, valor and, for text, fonte)."""
    table = range_table(lines.mapInArrow(lambda b: _measured(split(b)), RANGE_SCHEMA), per_folder)
    rows = table.limit(MAX_RANGES + 1).collect()
    if len(rows) > MAX_RANGES:
        raise ValueError(f"more than {MAX_RANGES} ranges: raise spark.sql.files.maxPartitionBytes")
    known = {(r["arquivo"], r["inicio"]): (int(r["estado"]), int(r["primeira"])) for r in rows}
    schema = "arquivo string, linha long, inicio long, registro binary"
    text = F.decode("registro", encoding)
    whole = lines.mapInArrow(lambda b: _glued(split(b), known, False), schema).select("arquivo", "linha", text.alias("registro"))
    cut = {r["arquivo"] for r in rows if r["estado"] or r["aberto"]}
    if not cut:                                        # no border or end inside a field: nothing to put together
        return whole
    # The tasks pass over the other files. A filter here would make Spark leave these files out, and it sizes its
    # splits by the bytes of all files that it reads: they would not be those of the first pass.
    parts = lines.mapInArrow(lambda b: _glued(split(b), known, True, cut), schema)
    pieces = F.array_sort(F.collect_list(F.struct("inicio", text.alias("texto"))))
    return whole.unionByName(parts.groupBy("arquivo", "linha").agg(pieces.alias("p")).select(
        "arquivo", "linha", F.array_join(F.transform("p", lambda x: x["texto"]), "\n").alias("registro")))


def _text_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """The lines of text files (arquivo, fonte, inicio, valor), in the same splits whenever they are read. Spark
    sizes splits by the settings and cores at hand when a pass starts, of the session that made the reader; cores
    change as executors come and go. So the reader is of a session of its own, with the present settings and cores."""
    held = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if held.conf.get(key, None) != value:
            try:
                held.conf.set(key, value)
            except AnalysisException:  # pragma: no cover - static, the same for all sessions
                pass
    least = (spark.conf.get("spark.sql.files.minPartitionNum", None) or spark.conf.get("spark.sql.leafNodeDefaultParallelism", None)
             or spark.sparkContext.defaultParallelism)
    held.conf.set("spark.sql.files.minPartitionNum", str(least))
    lines = held.read.text(paths if isinstance(paths, str) else list(paths)).select(
        F.col("_metadata.file_path").alias("arquivo"), F.xxhash64("_metadata.file_path").alias("fonte"),
        F.col("_metadata.file_block_start").alias("inicio"), F.col("value").cast("binary").alias("valor"))
    # What follows belongs to the caller's session, that of the first side; the optimizer drops the empty one.
    none = spark.range(1).where(F.lit(False)).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in lines.schema])
    return none.unionByName(lines)


def text_records(spark: SparkSession, paths: str | Sequence[str], encoding: str = "ISO-8859-1",
                 per_folder: bool = False) -> DataFrame:
    """(arquivo, linha, registro): the records of text files, split by Spark's text reader."""
    if encoding.upper().replace("_", "-").startswith(("UTF-16", "UTF-32")):
        raise ValueError("the encoding must be a superset of ASCII")
    return _records(spark, _text_lines(spark, paths), _of_text, encoding, per_folder)


def block_records(blocks: DataFrame, encoding: str = "ISO-8859-1") -> DataFrame:
    """The same of ``blocks`` (arquivo, inicio, valor): text cut at line ends, in order of ``inicio``."""
    return _records(blocks.sparkSession, blocks.select("arquivo", "inicio", "valor"), _of_blocks, encoding)


def parse(records: DataFrame, layout: Sequence[str], sep: str = ";", strict: bool = False,
          keep_corrupt: bool = False) -> DataFrame:
    """The fields of ``records`` by the JVM's CSV parser, with ``arquivo`` and ``linha``. Records with
    another number of fields are kept, missing fields NULL, their text in ``_corrupt_record`` with
    ``keep_corrupt``; ``strict`` fails the job at the first."""
    schema = all_string(layout)
    if keep_corrupt and not strict:
        schema = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType(), True)])
    options = {k: v for k, v in delimited_options(sep=sep, strict=strict).items() if k != "encoding"}
    fields = F.from_csv("registro", schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), options)
    return records.withColumn("__f", fields).select(*[F.col(f"__f.{f.name}") for f in schema.fields], "arquivo", "linha")


def scan_ranges(spark: SparkSession, paths: str | Sequence[str], layout: Sequence[str], encoding: str = "ISO-8859-1",
                sep: str = ";", strict: bool = False, keep_corrupt: bool = False, per_folder: bool = False) -> DataFrame:
    """S1 for files of any size: as ``scan_delimited``, but a file is split into ranges though quoted
    fields hold line breaks, and every row has its file and record number (C7)."""
    return parse(text_records(spark, paths, encoding, per_folder), layout, sep, strict, keep_corrupt)


# ------------------------------------------------------------------ rejected records

def fields_of(record: Column, sep: str = ";") -> Column:
    """Number of fields of a record: separators outside quotes, and one."""
    bare = F.regexp_replace(record, '"[^"]*"', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit(""))) + 1


def with_reason(rows: DataFrame, width: int, sep: str = ";") -> DataFrame:
    """``motivo`` of a row scanned with ``keep_corrupt``: NULL if accepted, else how it differs from the layout."""
    n = fields_of(F.col(CORRUPT), sep)
    return rows.withColumn("motivo", F.when(F.col(CORRUPT).isNull(), F.lit(None)).when(n < width, "campos a menos")
                           .when(n > width, "campos a mais").otherwise("ilegivel"))
