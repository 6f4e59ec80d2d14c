"""Parsers for the registry's raw text fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..util import as_col


def parse_registry_date(c) -> Column:
    """'yyyyMMdd' -> DATE; any other length or an invalid date -> NULL."""
    c = as_col(c)
    return F.when(F.length(c) == 8, F.try_to_date(c, "yyyyMMdd"))


def lenient_short(c) -> Column:
    """lenient cast to SMALLINT ('02' -> 2, '' / 'x' -> NULL)."""
    return as_col(c).try_cast("smallint")


def parse_capital(c, precision: int = 15, scale: int = 2) -> Column:
    """decimal comma -- the first ',' becomes '.', then a lenient cast."""
    return F.regexp_replace(as_col(c), r"^([^,]*),", "$1.").try_cast(f"decimal({precision},{scale})")


def compose_key(*parts) -> Column:
    """concatenation that is NULL when any part is NULL."""
    return F.concat(*[as_col(p) for p in parts])
