"""Nullable N:1 embeds (P6, J3): attach dimension fields to a *bounded*
result as a struct that is NULL when unmatched."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def embed_left(bounded: DataFrame, dim: DataFrame, keys: dict[str, str], name: str,
               fields: list[str]) -> DataFrame:
    """Left join ``bounded`` (a top-k result: its size is the k) to ``dim``.

    The keys of ``bounded`` are broadcast and the dimension, only streamed, is
    semi-joined to them; the few rows left are broadcast to ``bounded``. Neither
    join shuffles the dimension, whatever its size. ``keys`` maps bounded columns
    to dim columns. Should a key repeat there, its least struct is the one
    embedded: one row a key is sent, and no row of ``bounded`` doubles.
    """
    on = [f"__k_{bk}" for bk in keys]
    wanted = bounded.select(*[F.col(bk).alias(k) for bk, k in zip(keys, on)]).distinct()
    d = dim.select(*[F.col(dk).alias(k) for dk, k in zip(keys.values(), on)],
                   F.struct(*[F.col(f) for f in fields]).alias(name))
    few = d.join(F.broadcast(wanted), on, "left_semi").groupBy(*on).agg(F.min(name).alias(name))
    cond = [F.col(bk) == F.col(k) for bk, k in zip(keys, on)]
    # An unmatched row gets a NULL struct, not a struct of NULLs.
    return bounded.join(F.broadcast(few), cond, "left").select(*bounded.columns, name)
