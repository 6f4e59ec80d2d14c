"""Insight snapshot (R6: A9, F18, K6) and the newest insight (T5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas

# Title of the regional growth insight and its model label.
INSIGHT_TITLE = "Panorama de crescimento setorial — RMPA"


def insight_snapshot(top: DataFrame) -> DataFrame:
    """The ranked rows (already limited, see ``latest_month_top``)
    as one JSON document ``{"top_setores_crescimento_rmpa": [...]}``.

    Decimals become strings, as ``json.dumps(default=str)`` writes them
    (C9); NULL fields are kept. Empty input gives no row (nothing to
    store)."""
    rows = F.sort_array(F.collect_list(F.struct(
        F.col("posicao"), F.col("setor"), F.col("municipio"), F.col("total_aberturas"),
        F.col("variacao_pct").cast("string").alias("variacao_pct"))))
    doc = F.struct(F.transform(rows, lambda r: F.struct(
        r["setor"].alias("setor"), r["municipio"].alias("municipio"),
        r["total_aberturas"].alias("total_aberturas"), r["variacao_pct"].alias("variacao_pct")))
        .alias(schemas.SNAPSHOT_KEY))
    return (top.agg(F.count(F.lit(1)).alias("n"), F.to_json(doc, {"ignoreNullFields": "false"}).alias("baseado_em"))
               .where(F.col("n") > 0).select("baseado_em"))


def snapshot_rows(snapshots: DataFrame, column: str = "baseado_em") -> DataFrame:
    """Parse stored snapshots back into ranked rows (audit view)."""
    parsed = F.from_json(F.col(column), schemas.INSIGHT_SNAPSHOT)
    return (snapshots.select(F.posexplode(parsed.getField(schemas.SNAPSHOT_KEY)).alias("i", "r"))
                     .select((F.col("i") + 1).alias("posicao"), "r.*"))


def insight_record(snapshot: DataFrame, content, model: str, title: str = INSIGHT_TITLE) -> DataFrame:
    """K6 row: title, content (an input: the text model is not called
    here), snapshot, model label and the clock."""
    content = F.lit(content) if isinstance(content, str) else content
    return snapshot.select(F.lit(title).alias("titulo"), content.alias("conteudo"),
                           F.col("baseado_em"), F.lit(model).alias("modelo"),
                           F.current_timestamp().alias("gerado_em"))


def latest_insight(log: DataFrame, time_col: str = "gerado_em", id_col: str = "id") -> DataFrame:
    """T5: the newest record, or nothing when the log is empty."""
    order = [F.col(time_col).desc_nulls_last()]
    if id_col in log.columns:
        order.append(F.col(id_col).desc_nulls_last())
    return log.orderBy(*order).limit(1)
