"""Exact arithmetic for the growth variation (V2, F9, contract C2) and the
chart axis bound (A7, F21)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..util import as_col


def variation_hundredths(t: str, s: str, n: str) -> Column:
    """Variation of ``t`` against the mean ``s/n`` in hundredths of a percent,
    rounded half away from zero, with integers only::

        d = t*n - s
        sign(d) * ((2*|d|*10000 + s) div (2*s))

    NULL when the frame is empty (``s`` NULL) or sums to zero.
    Arguments are column names (the integer ``div`` is a SQL operator).
    """
    d = f"(CAST({t} AS BIGINT) * {n} - {s})"
    q = F.expr(f"(2 * abs({d}) * 10000 + {s}) div (2 * {s})")
    h = F.when(F.expr(f"{d} < 0"), -q).otherwise(q)
    return F.when(F.col(s).isNull() | (F.col(s) == 0), F.lit(None)).otherwise(h)


def hundredths_to_pct(h, precision: int = 6) -> Column:
    """Hundredths as DECIMAL(precision, 2); an overflow raises in ANSI mode,
    as the reference's NUMERIC(6,2) column does."""
    return (as_col(h).cast("decimal(18,0)") * F.lit(0.01).cast("decimal(2,2)")).cast(f"decimal({precision},2)")


# Fixed values of the chart axis: floor of the largest magnitude, headroom.
AXIS_FLOOR = 1
AXIS_HEADROOM = "1.15"


def axis_bound(v) -> Column:
    """A7 as an aggregate: ceil(max(1, max |v|) * 1.15) in exact decimals.
    ``greatest`` skips NULL, so empty input gives the floor's bound (2)."""
    m = F.greatest(F.lit(AXIS_FLOOR).cast("decimal(10,2)"), F.max(F.abs(as_col(v))))
    return F.ceil(m * F.lit(AXIS_HEADROOM).cast("decimal(3,2)")).cast("bigint")
