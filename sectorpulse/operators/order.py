"""Global order at table scale (T4, T7, K9): the position and page of every row
without a window in one task.

Rows are range-partitioned on the order, whose bounds Spark samples, and sorted
inside their partitions; a row's place in its partition and the numbers of rows of
the partitions before it give its position. Only one count a partition is summed
over partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import LEADS_PAGE
from ..session import staged

# ``monotonically_increasing_id``: the partition above, the row in it below this bit (fixed value).
ROW_BITS = 33


def positions(df: DataFrame, order: Sequence[Column], page: int = LEADS_PAGE) -> DataFrame:
    """``df`` with ``posicao`` (from 1, gapless, in ``order``) and ``pagina`` (from 1, ``page`` rows each).
    Rows that tie in all of ``order`` meet in one partition, so it should end with a key; they get
    neighbouring positions. The order is by partition of the result, too."""
    spark = df.sparkSession
    width = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ordered = staged(df.repartitionByRange(width, *order).sortWithinPartitions(*order)
                       .withColumn("__id", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("__id", ROW_BITS)
    # One number a partition, at most ``width``.
    counts = {r["p"]: r["n"] for r in ordered.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}
    before, upto = [], 0
    for p in sorted(counts):
        before.append((p, upto))
        upto += counts[p]
    offsets = spark.createDataFrame(before, "__part long, __before long")
    placed = ordered.withColumn("__part", part.cast("long")).join(F.broadcast(offsets), "__part")
    place = F.col("__before") + F.col("__id").bitwiseAND(F.lit((1 << ROW_BITS) - 1)) + 1
    return (placed.withColumn("posicao", place.cast("long"))
                  .withColumn("pagina", (F.floor((F.col("posicao") - 1) / page) + 1).cast("long"))
                  .drop("__id", "__part", "__before"))


def page_of(placed: DataFrame, number: int) -> DataFrame:
    """One page of :func:`positions`, in order."""
    return placed.where(F.col("pagina") == number).orderBy("posicao")
