"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import configure, scratch_path

# White space of the word rule: space and U+0009 to U+000D (fixed values).
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
# Rows of one Arrow batch: whole texts travel in them, so the batch stays small.
ARROW_BATCH_ROWS = 512


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of the operators: the library's own, and small Arrow
    batches so that a batch of long texts fits a worker."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_BATCH_ROWS))
    return spark


@contextmanager
def few_rows_a_batch(spark: SparkSession, rows: int = 8) -> Iterator[None]:
    """For a job run inside: Arrow batches of so few rows, where a row holds megabytes."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` to a new folder of the shared checkpoint
    directory and read it back. A lost executor costs its running tasks only."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def word_count(text: Column) -> Column:
    """Number of words, 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def positions(df: DataFrame, group: Sequence[str], order: Sequence[str], out: str = "position") -> DataFrame:
    """Gapless position from 0 of every row inside its group, without sending
    a group to one task.

    A row's place is the number of rows in the earlier hash buckets of its
    group plus its rank inside its own bucket. Only (group, bucket) counts,
    summed before the shuffle, are put in order across buckets. ``df`` is read
    twice, so it should be cheap or staged. Rows equal in all of ``order`` are
    interchangeable."""
    buckets = shuffle_width(df.sparkSession)
    keys = [*group, "__bucket"]
    rows = df.withColumn("__bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    earlier = (Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0)))
    offsets = (rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
                   .withColumn("__before", F.coalesce(F.sum("__n").over(
                       earlier.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
                   .drop("__n"))
    inside = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1
    return (rows.withColumn("__inside", inside).join(offsets, keys)
                .withColumn(out, (F.col("__before") + F.col("__inside")).cast("long"))
                .drop("__bucket", "__inside", "__before"))
