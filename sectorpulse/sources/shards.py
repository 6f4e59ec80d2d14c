"""Multi-shard reads (S5, S6, S7, U1): one scan over every shard, with the
shard name and the row's position inside its file as columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def union_shards(spark: SparkSession, paths: str | Sequence[str], fmt: str = "parquet",
                 batch: str | None = None) -> DataFrame:
    """The union of all shards as one scan (paths or globs; Spark raises
    when nothing matches). ``shard_nome`` is the folder (or file) holding
    the row; ``shard_nome``, ``arquivo`` (file name) and ``linha`` (row index
    inside that Parquet file) give the file order of C7. ``batch`` keeps one
    ``lote=`` partition (S6), pruned at planning time."""
    df = spark.read.format(fmt).load(paths if isinstance(paths, str) else list(paths))
    if batch is not None:
        df = df.where(F.col("lote") == batch)
    # parent folder of the file: a linear split, not a backtracking regex
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    cols = [F.col(c) for c in df.columns]
    extra = [name.alias("shard_nome")]
    if fmt == "parquet":
        extra += [F.col("_metadata.file_name").alias("arquivo"), F.col("_metadata.row_index").alias("linha")]
    return df.select(*cols, *extra)


def shard_counts(df: DataFrame, shard_col: str = "shard_nome") -> DataFrame:
    """Rows per shard and the total (``shard`` NULL), one aggregate."""
    return df.rollup(shard_col).agg(F.count(F.lit(1)).alias("linhas"))


def keep_first_record(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """A5/C7 over numbered text records: of the rows of a key the first in (file, record number) order, kept by
    an aggregate that combines map-side."""
    rest = [c for c in rows.columns if c not in key]
    first = F.min_by(F.struct(*rest), F.struct("arquivo", "linha"))
    return (rows.groupBy(*key).agg(first.alias("__r"))
                .select(*key, *[F.col(f"__r.{c}").alias(c) for c in rest]))


def record_counts(rows: DataFrame, shard_col: str = "shard") -> DataFrame:
    """Records read, accepted and rejected by reason, per shard and in all (shard NULL)."""
    reason = F.col("motivo")
    return rows.rollup(shard_col).agg(
        F.count(F.lit(1)).alias("lidos"), F.count_if(reason.isNull()).alias("aceitos"),
        F.count_if(reason == "campos a menos").alias("curtos"), F.count_if(reason == "campos a mais").alias("longos"),
        F.count_if(reason == "ilegivel").alias("ilegiveis"))
