"""Sharding by weighted rendezvous hashing.

Every shard draws a score from the hash of (record key, shard); the record
goes to the shard with the highest score. A new shard can only win records
for itself, so growing from n to n + 1 shards moves about 1/(n + 1) of them
and none between old shards. With weight w the score is ``-w / ln(u)``, u the
hash as a fraction of (0, 1): a shard's share follows its weight.

Defined cases: a null key hashes like any other key, so all such rows share
one shard; repeated rows go where the first goes and get slots of their own;
an empty table gives an empty result; a column of the input named like an
output column is replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import positions


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """Shard number (0 to ``len(weights) - 1``) of ``key``. A weight of 0
    closes a shard; at least one must be positive."""
    if not any(w > 0 for w in weights):
        raise ValueError("at least one shard needs a positive weight")

    def score(shard: int, weight: float) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 11).cast("double")
        fraction = (bits + F.lit(0.5)) * F.lit(2.0 ** -53)
        return F.lit(-float(weight)) / F.log(fraction)

    entries = [F.struct(score(s, w).alias("score"), F.lit(s).alias("shard"))
               for s, w in enumerate(weights) if w > 0]
    return F.array_max(F.array(*entries))["shard"]


def assign_shards(df: DataFrame, key: str, weights: Sequence[float], out: str = "shard") -> DataFrame:
    """``df`` with its shard; a map over rows, nothing is shuffled."""
    return df.withColumn(out, rendezvous(F.col(key), weights))


def with_slots(df: DataFrame, shard: str, order: Sequence[str], out: str = "slot") -> DataFrame:
    """Gapless slot from 0 inside every shard (see ``positions``)."""
    return positions(df, [shard], order, out)


def write_shards(df: DataFrame, key: str, weights: Sequence[float], path: str, out: str = "shard") -> None:
    """Write one folder per shard. The rows of a shard are spread over several
    tasks by key, so no task writes a whole shard."""
    sharded = assign_shards(df, key, weights, out)
    (sharded.repartition(F.col(out), F.pmod(F.xxhash64(key), F.lit(8)))
            .write.partitionBy(out).parquet(path))
