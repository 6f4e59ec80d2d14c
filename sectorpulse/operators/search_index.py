"""Substring search over all leads (W8) by a trigram index.

Every three neighbouring characters of a lead's displayed values, lower-cased, are
a posting (trigram, lead). Postings are partitioned by a hash of the trigram and
sorted by it; the leads by a hash of their number. A search looks up how often
each trigram of its text occurs, joins the postings of the rarest ones, reads the
leads of the numbers left and holds them against the text itself. So it reads
the partitions that can match, not the leads.

A text of fewer than three characters has no trigram: it is held against all leads.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .leads import DISPLAY_COLUMNS, leads_search

WIDTH = 3            # characters of a posting
PARTS = 64           # partitions of the postings and of the leads
RAREST = 3           # lists that are joined; the exact check settles the rest


@dataclass
class LeadIndex:
    """Folders of the leads (with ``__id`` and ``__bloco``), the postings and the counts (with ``__parte``)."""

    leads: str
    postings: str
    counts: str


def _part(c: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(c), F.lit(parts)).cast("int")


def grams(values: list[Column]) -> Column:
    """Distinct trigrams of the values."""
    def of(v: Column) -> Column:
        starts = F.when(F.length(v) >= WIDTH, F.sequence(F.lit(1), F.length(v) - (WIDTH - 1))).otherwise(
            F.array().cast("array<int>"))
        return F.transform(starts, lambda i: v.substr(i, F.lit(WIDTH)))
    return F.array_distinct(F.flatten(F.array(*[F.coalesce(of(F.lower(v)), F.array().cast("array<string>")) for v in values])))


def build_index(spark: SparkSession, display: DataFrame, parts: int = PARTS) -> LeadIndex:
    """Index of the displayed leads, written to the shared folder."""
    root = scratch_path(spark, "lead-index")
    out = LeadIndex(f"{root}/leads", f"{root}/postings", f"{root}/counts")
    # Numbered and written in one pass; the postings are made from the written rows.
    (display.withColumn("__id", F.monotonically_increasing_id()).withColumn("__bloco", _part(F.col("__id"), parts))
            .hint("rebalance", "__bloco").write.partitionBy("__bloco").parquet(out.leads))
    leads = spark.read.parquet(out.leads)
    postings = (leads.select("__id", F.explode(grams([F.col(c) for c in DISPLAY_COLUMNS])).alias("__gram"))
                     .withColumn("__parte", _part(F.col("__gram"), parts)))
    # A trigram of every lead is one large value: rebalancing deals it to several tasks.
    (postings.hint("rebalance", "__parte").sortWithinPartitions("__parte", "__gram")
             .write.partitionBy("__parte").parquet(out.postings))
    (spark.read.parquet(out.postings).groupBy("__parte", "__gram").agg(F.count(F.lit(1)).alias("__n"))
          .hint("rebalance", "__parte").write.partitionBy("__parte").parquet(out.counts))
    return out


def candidates(spark: SparkSession, index: LeadIndex, text: str, parts: int = PARTS) -> DataFrame | None:
    """(__id) of the leads that hold the rarest trigrams of ``text``; None if it has no trigram."""
    low = text.lower()
    wanted = sorted({low[i:i + WIDTH] for i in range(len(low) - WIDTH + 1)})
    if not wanted:
        return None
    # As many rows as the text has trigrams.
    part = {r["g"]: r["p"] for r in spark.createDataFrame([(g,) for g in wanted], "g string")
            .select("g", _part(F.col("g"), parts).alias("p")).collect()}
    known = spark.read.parquet(index.counts).where(
        F.col("__parte").isin(sorted(set(part.values()))) & F.col("__gram").isin(wanted))
    often = {r["__gram"]: r["__n"] for r in known.collect()}
    rarest = sorted(wanted, key=lambda g: (often.get(g, 0), g))[:RAREST]
    out = None
    for g in rarest:
        listed = spark.read.parquet(index.postings).where((F.col("__parte") == part[g]) & (F.col("__gram") == g)).select("__id")
        out = listed if out is None else out.join(listed, "__id", "left_semi")
    return out


def search(spark: SparkSession, index: LeadIndex, text: str, parts: int = PARTS) -> DataFrame:
    """The leads with ``text`` in a displayed value, as ``leads_search`` finds them among all."""
    leads = spark.read.parquet(index.leads)
    found = candidates(spark, index, text, parts)
    if found is not None:
        # At most ``parts`` numbers; the scan of the leads is pruned to them when it is planned.
        blocks = sorted(r[0] for r in found.select(_part(F.col("__id"), parts)).distinct().collect())
        leads = leads.where(F.col("__bloco").isin(blocks)).join(found, "__id", "left_semi")
    return leads_search(leads, text).drop("__id", "__bloco")
