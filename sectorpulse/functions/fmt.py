"""Display formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..util import as_col

# Fixed values of the pt-BR display formats.
NULL_VARIATION = "—"          # shown for a missing variation
DATE_BR = "dd/MM/yyyy"
DATE_ISO = "yyyy-MM-dd"


def _swap_separators(c: Column) -> Column:
    # en-US grouping/decimal marks -> pt-BR ('1,234.5' -> '1.234,5')
    return F.translate(c, ",.", ".,")


def format_variation(v) -> Column:
    """signed percentage with one decimal in pt-BR, an em dash for NULL.

    Rounds half away from zero on the decimal first; the sign comes from the
    unrounded value, so -0.04 prints '-0,0%'.
    """
    v = as_col(v)
    sign = F.when(v > 0, F.lit("+")).when(v < 0, F.lit("-")).otherwise(F.lit(""))
    body = _swap_separators(F.format_number(F.abs(F.round(v, 1)), 1))
    return F.when(v.isNull(), F.lit(NULL_VARIATION)).otherwise(F.concat(sign, body, F.lit("%")))


def format_int_br(n) -> Column:
    """integer with '.' thousands separators."""
    return F.translate(F.format_number(as_col(n), 0), ",", ".")


def date_br(d) -> Column:
    """date shown as stored, dd/MM/yyyy (no zone shift, contract C11)."""
    return F.date_format(as_col(d), DATE_BR)


def iso_date(d) -> Column:
    """yyyy-MM-dd."""
    return F.date_format(as_col(d), DATE_ISO)


def growth_direction(v) -> Column:
    """'up' when the value is >= 0."""
    v = as_col(v)
    return F.when(v >= 0, F.lit("up")).otherwise(F.lit("down"))
