"""Typed establishments and companies (R2: P1-P3, W1, F2-F5, A4, A5, J5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..constants import STATUS_ACTIVE
from ..functions.parse import compose_key, lenient_short, parse_capital, parse_registry_date


def typed_establishments(raw: DataFrame) -> DataFrame:
    """Key, dates and status typed; other columns stay text."""
    return raw.withColumns({
        "cnpj": compose_key("cnpj_basico", "cnpj_ordem", "cnpj_dv"),
        "data_inicio_atividade": parse_registry_date("data_inicio_atividade"),
        "data_situacao": parse_registry_date("data_situacao_cadastral"),
        "situacao_cadastral": lenient_short("situacao_cadastral"),
    })


def establishments_final(raw: DataFrame) -> DataFrame:
    """R2 establishments: typed, active only (W1), 14 columns (P2) with
    ``telefone_1`` renamed (P3). NULL opening dates are kept (C13)."""
    out = (typed_establishments(raw)
           .where(F.col("situacao_cadastral") == STATUS_ACTIVE)
           .select(*schemas.ESTABLISHMENT_FINAL))
    for old, new in schemas.ESTABLISHMENT_RENAME.items():
        out = out.withColumnRenamed(old, new)
    return out


def typed_companies(raw: DataFrame) -> DataFrame:
    """Companies with share capital (F4) and size (F3) typed, 5 columns."""
    return (raw.withColumns({"capital_social": parse_capital("capital_social"),
                             "porte": lenient_short("porte")})
               .select(*schemas.COMPANY_FINAL, *[c for c in ("shard", "linha") if c in raw.columns]))


def keep_first(df: DataFrame, key: str | Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """A5: one row per key, the first in ``order`` (default: all columns).

    An aggregate, not a window: ``min_by`` combines map-side, so a key that
    holds a third of all rows is reduced in every task before the shuffle
    and no task ever holds a whole group. Unlike ``dropDuplicates`` the
    kept row is deterministic.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    if not order:
        # Ordered by all columns the first row is the least struct: each row is carried once.
        picked = df.groupBy(*keys).agg(F.min(F.struct(*[F.col(c) for c in rest])).alias("__row"))
        return picked.select(*keys, *[F.col(f"__row.{c}").alias(c) for c in rest])
    picked = (df.groupBy(*keys)
                .agg(F.min_by(F.struct(*[F.col(c) for c in rest]),
                              F.struct(*[F.col(c) for c in order])).alias("__row")))
    return picked.select(*keys, *[F.col(f"__row.{c}").alias(c) for c in rest])


def companies_semi(companies: DataFrame, establishments: DataFrame) -> DataFrame:
    """Companies with at least one establishment (left semi join). The
    keys are made distinct first: combined map-side, so a company with a third
    of all establishments reaches the join as one row per task."""
    return companies.join(establishments.select("cnpj_basico").distinct(), "cnpj_basico", "left_semi")


def companies_final(raw_companies: DataFrame, establishments: DataFrame,
                    order: Sequence[str] = ("shard", "linha")) -> DataFrame:
    """R2 companies: typed, semi-joined to the establishments, then the first
    row per key in file order (C7). The semi join is written before the
    de-duplication: both use the same key, so the result is the same and the
    national table shrinks before the shuffle."""
    typed = typed_companies(raw_companies)
    present = [c for c in order if c in typed.columns]
    firsts = keep_first(companies_semi(typed, establishments), "cnpj_basico", present or None)
    return firsts.select(*schemas.COMPANY_FINAL)
