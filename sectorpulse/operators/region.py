"""Region resolution and filtering (R0/R1: W2, W3, J4, J6, U2, U3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import REGION_MUNICIPALITIES
from ..functions.text import normalize_name
from ..session import bounded

# Region codes are pushed into the scan as an IN list up to this many codes;
# beyond it the filter is a semi join left to the planner.
MAX_PUSHED_CODES = 10_000


def _named(municipalities: DataFrame, code_col: str, name_col: str) -> DataFrame:
    return municipalities.select(F.col(code_col).alias("codigo_municipio"),
                                 normalize_name(F.col(name_col)).alias("nome_normalizado"))


def in_region(municipalities: DataFrame, whitelist=REGION_MUNICIPALITIES, name_col: str = "nome") -> DataFrame:
    """Municipality rows, as they are, whose normalised name is in ``whitelist``."""
    return municipalities.where(normalize_name(F.col(name_col)).isin(list(whitelist)))


def region_municipalities(municipalities: DataFrame, whitelist=REGION_MUNICIPALITIES,
                          code_col: str = "codigo_municipio", name_col: str = "nome") -> DataFrame:
    """Municipality rows whose normalised name is in ``whitelist``."""
    return _named(municipalities, code_col, name_col).where(F.col("nome_normalizado").isin(list(whitelist)))


def region_codes(municipalities: DataFrame, whitelist=REGION_MUNICIPALITIES,
                 code_col: str = "codigo_municipio", name_col: str = "nome") -> DataFrame:
    """The distinct municipality codes of the region."""
    return region_municipalities(municipalities, whitelist, code_col, name_col) \
        .select("codigo_municipio").distinct()


def region_missing(municipalities: DataFrame, whitelist=REGION_MUNICIPALITIES,
                   code_col: str = "codigo_municipio", name_col: str = "nome") -> DataFrame:
    """Whitelist names with no municipality row, sorted. The
    whitelist is a parameter (a few dozen names), so it is a literal table."""
    spark = municipalities.sparkSession
    wanted = spark.createDataFrame([(n,) for n in dict.fromkeys(whitelist)], "nome_normalizado string")
    found = (region_municipalities(municipalities, whitelist, code_col, name_col)
             .select("nome_normalizado").distinct())
    return wanted.join(found, "nome_normalizado", "left_anti").orderBy("nome_normalizado")


def filter_region(establishments: DataFrame, codes: DataFrame,
                  code_col: str = "codigo_municipio") -> DataFrame:
    """Keep establishments of the region.

    A region has a bounded number of codes (checked): they become an IN list
    that Catalyst pushes into the Parquet scan (row-group pruning) and that
    evaluates as a hash set. An unexpectedly large code table falls back to
    a left semi join chosen by the planner (broadcast or shuffled by AQE).
    """
    if bounded(codes, MAX_PUSHED_CODES):
        values = [r[0] for r in codes.select("codigo_municipio").distinct().collect()]
        return establishments.where(F.col(code_col).isin(values))
    return establishments.join(codes.withColumnRenamed("codigo_municipio", code_col), code_col, "left_semi")
