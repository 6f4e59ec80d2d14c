"""Table constraints re-aimed as checks (Q1-Q5). Each check returns the
violations as a DataFrame, aggregated per violated value; no row is
collected."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas

VIOLATION_COLUMNS = ("tabela", "coluna", "valor", "ocorrencias")


def _key_text(cols: Sequence[str]):
    return F.concat_ws("|", *[F.col(c).cast("string") for c in cols])


def pk_violations(df: DataFrame, key: Sequence[str], table: str) -> DataFrame:
    """Q1: key values present more than once (partial + final aggregate)."""
    return (df.groupBy(*key).agg(F.count(F.lit(1)).alias("ocorrencias"))
              .where(F.col("ocorrencias") > 1)
              .select(F.lit(table).alias("tabela"), F.lit(",".join(key)).alias("coluna"),
                      _key_text(key).alias("valor"), "ocorrencias"))


def fk_violations(child: DataFrame, fk: str, parent: DataFrame, pk: str, table: str) -> DataFrame:
    """Q2: non-NULL references with no parent row (left anti join)."""
    refs = child.where(F.col(fk).isNotNull()).groupBy(fk).agg(F.count(F.lit(1)).alias("ocorrencias"))
    missing = refs.join(parent.select(F.col(pk).alias(fk)), fk, "left_anti")
    return missing.select(F.lit(table).alias("tabela"), F.lit(fk).alias("coluna"),
                          F.col(fk).cast("string").alias("valor"), "ocorrencias")


def not_null_violations(df: DataFrame, cols: Sequence[str], table: str) -> DataFrame:
    """Q3: NULL count per NOT NULL column, in one pass; zero counts dropped."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = counts.unpivot([], list(cols), "coluna", "ocorrencias")
    return long.where(F.col("ocorrencias") > 0).select(
        F.lit(table).alias("tabela"), "coluna", F.lit(None).cast("string").alias("valor"), "ocorrencias")


def declared_not_null(tables: dict[str, DataFrame]) -> DataFrame:
    """Q3 for whole tables: every NOT NULL column that a table declares, each table in one pass. A column that
    a frame does not list counts as filled where the table has a default, else as NULL in every row."""
    checks = []
    for name, df in tables.items():
        cols = [c for c in schemas.NOT_NULL[name] if c in df.columns or c not in schemas.NOT_NULL_DEFAULTS]
        absent = {c: F.lit(None).cast("string") for c in cols if c not in df.columns}
        checks.append(not_null_violations(df.withColumns(absent) if absent else df, cols, name))
    return union_checks(*checks)


def row_checks(df: DataFrame, table: str, checks: Sequence[tuple[str, object]]) -> DataFrame:
    """Q4/Q5 in one pass over ``df``: ``checks`` are (column, bad-row
    condition); each failing (column, value) is counted by one aggregate."""
    hits = F.filter(F.array(*[F.when(bad, F.struct(F.lit(c).alias("coluna"),
                                                    F.col(c).cast("string").alias("valor")))
                              for c, bad in checks]), lambda x: x.isNotNull())
    return (df.select(F.explode(hits).alias("h"))
              .groupBy(F.col("h.coluna").alias("coluna"), F.col("h.valor").alias("valor"))
              .agg(F.count(F.lit(1)).alias("ocorrencias"))
              .select(F.lit(table).alias("tabela"), "coluna", "valor", "ocorrencias"))


def too_long(col: str, max_len: int):
    return F.length(col) > max_len


def not_numeric(col: str, precision: int, scale: int):
    c = F.col(col)
    return c.isNotNull() & c.try_cast(f"decimal({precision},{scale})").isNull()


def outside(col: str, domain: Sequence):
    c = F.col(col)
    return c.isNotNull() & ~c.isin(list(domain))


def union_checks(*checks: DataFrame) -> DataFrame:
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out
