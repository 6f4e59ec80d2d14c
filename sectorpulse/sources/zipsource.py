"""One-member zip archives of ';' text as a table.

Spark reads no ``.zip``. A task only unpacks: it streams the member of its
archive and hands on blocks of about ``BLOCK_BYTES`` that end at a line end, which
are written to the shared folder once. From there on nothing depends on the
archive: the blocks are the ranges of ``records``, so any number of tasks parse
one archive, decode it in the JVM, number its records (C7) and tell malformed
ones (C17), as for plain text.

An archive on a path that the executors see as a file is streamed; one in a
store that only Spark reads comes as a ``binaryFile`` value, which Spark limits to
2 GB. An archive is unpacked by one task: its format has no index by position.
"""

from __future__ import annotations

import csv
import glob
import io
import os
import re
import zipfile
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import local_dir, scratch_path
from .records import block_records, parse

BLOCK_BYTES = 1 << 20
BLOCKS = "arquivo string, inicio long, valor binary"


def list_archives(pattern: str) -> list[str]:
    """Archives in sorted name order; an empty match is an error."""
    paths = sorted(glob.glob(pattern)) if any(ch in pattern for ch in "*?[") else (
        sorted(os.path.join(pattern, f) for f in os.listdir(pattern) if f.endswith(".zip"))
        if os.path.isdir(pattern) else [pattern])
    paths = [p for p in paths if os.path.isfile(p)]
    if not paths:
        raise FileNotFoundError(f"no archive matches {pattern}")
    return paths


def _member_blocks(name: str, archive) -> Iterator[pa.RecordBatch]:
    """Blocks of the first member, cut behind the last line end inside each."""
    with zipfile.ZipFile(archive) as zf, zf.open(zf.namelist()[0]) as raw:
        held, at = b"", 0
        while True:
            some = raw.read(BLOCK_BYTES)
            text = held + some
            # A CR at the very end may be half of a CRLF: it waits for the next block.
            end = len(text) if not some else max(text.rfind(b"\n"), text.rfind(b"\r", 0, len(text) - 1)) + 1
            if end:
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([at], pa.int64()),
                                                  pa.array([text[:end]], pa.binary())], names=["arquivo", "inicio", "valor"])
            held, at = text[end:], at + end
            if not some:
                return


def unpacked(spark: SparkSession, path: str) -> DataFrame:
    """(arquivo, inicio, valor) of the archives at ``path``: name, byte offset in the member, block."""
    def streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in batch.column(0).to_pylist():
                yield from _member_blocks(os.path.basename(p), p)

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                yield from _member_blocks(p.rsplit("/", 1)[-1], io.BytesIO(content.as_py()))

    if re.match(r"(?!file:)\w[\w+.-]*:", path):
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path).select("path", "content")
        return files.mapInArrow(held, BLOCKS)
    paths = list_archives(local_dir(path))
    names = spark.createDataFrame([(p, i) for i, p in enumerate(paths)], "path string, i int")
    return names.repartitionByRange(len(paths), "i").select("path").mapInArrow(streamed, BLOCKS)


def scan_zip(spark: SparkSession, path: str, layout: Sequence[str], encoding: str = "ISO-8859-1", sep: str = ";",
             strict: bool = False, keep_corrupt: bool = False) -> DataFrame:
    """S3: the archives at ``path`` as one DataFrame: all columns STRING, ``shard`` (the archive) and
    ``linha`` (the record's number in it); malformed records as in ``records.parse``."""
    staged = scratch_path(spark, "zip-blocks")
    # Uncompressed, so that a split of the blocks is as large in memory as on disk.
    unpacked(spark, path).write.option("compression", "uncompressed").option(
        "parquet.block.size", 32 * BLOCK_BYTES).parquet(staged)
    blocks = spark.read.schema(BLOCKS).parquet(staged)
    return parse(block_records(blocks, encoding), layout, sep, strict, keep_corrupt).withColumnRenamed("arquivo", "shard")


def write_zip_shards(df: DataFrame, folder: str, prefix: str, shards: int,
                     encoding: str = "ISO-8859-1", sep: str = ";") -> list[str]:
    """Write ``df`` as ``shards`` one-member archives (the registry's
    publication format), one per partition, from the executors."""
    cols = df.columns
    os.makedirs(folder, exist_ok=True)

    def write_part(it):
        import pandas as pd
        from pyspark import TaskContext
        pid = TaskContext.get().partitionId()
        path = os.path.join(folder, f"{prefix}{pid}.zip")
        tmp = f"{path}.{TaskContext.get().attemptNumber()}.tmp"
        n = 0
        with zipfile.ZipFile(tmp, "w", zipfile.ZIP_DEFLATED) as zf:
            with zf.open(f"{prefix}{pid}.CSV", "w") as raw:
                text = io.TextIOWrapper(raw, encoding=encoding, newline="")
                w = csv.writer(text, delimiter=sep, quotechar='"', doublequote=True,
                               quoting=csv.QUOTE_ALL, lineterminator="\n")
                for pdf in it:
                    for rec in pdf.itertuples(index=False):
                        w.writerow(["" if v is None or (isinstance(v, float) and v != v) else v for v in rec])
                        n += 1
                text.flush()
                text.detach()
        os.replace(tmp, path)  # a retried task replaces a partial archive
        yield pd.DataFrame({"path": [path], "rows": [n]})

    out = df.repartition(shards).select(*cols).mapInPandas(write_part, "path string, rows long")
    return sorted(r.path for r in out.collect())
