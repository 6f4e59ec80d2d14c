"""Corpus pipeline: quality classifier, near-duplicates, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet to the shared folder and read back as the next one's input.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sectorpulse.llm import dedup_cpsjoin, mix_pivotal, pack_cutting_stock, quality_pu
from sectorpulse.llm.common import prepare, read_table, staged
from sectorpulse.llm.queries import vocabulary


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    prepare(spark)
    return quality_pu.accepted(docs, read_table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    prepare(spark)
    return dedup_cpsjoin.keep_one(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    prepare(spark)
    return mix_pivotal.mix(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences."""
    prepare(spark)
    return pack_cutting_stock.pack(docs, vocabulary())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality), ("near_dedup", near_dedup), ("mixing", mixing), ("packing", packing)]

# A fitted classifier, random rounding and a tokenizer can't be said in SQL; the tests hold
# every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
