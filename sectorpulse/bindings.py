"""Bind the driver's TPC-H-like tables to the registry roles.

Operators take DataFrames with the registry's column names; these
projections produce them from the driver tables, so every query reads the
given tables and its work grows with them.

* G (growth): establishment = lineitem row, company = supplier,
  sector = ``p_type``, municipality = ``s_nationkey`` -> ``nation``,
  opened = ``l_shipdate``, active = ``l_linestatus = 'O'``.
* O (orders): establishment = order, company = customer, sector =
  ``o_orderpriority``, municipality = ``c_nationkey`` -> ``nation``,
  opened = ``o_orderdate``, active = ``o_orderstatus = 'O'``. Raw text
  fields are rendered from typed columns, with some deliberately bad values.
* D (documents): free text for the text functions and the text sources.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schemas

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

# Fixed values of the bindings (shared with the oracle SQL in plans/oracle.py).
ACTIVE_STATUS_G = "O"           # l_linestatus of an active establishment
ACTIVE_STATUS_O = "O"           # o_orderstatus of an active establishment
SHARDS_G = 4                    # shard of a growth row = l_orderkey % 4
DROPPED_SEGMENT_O = "AUTOMOBILE"  # customers the foreign-key check leaves out of its parent table
# Region whitelist for the driver tables (normalised names, one absent).
DRIVER_REGION = ("NATION_1", "NATION_4", "NATION_9", "NATION_16", "NATION_23", "NATION_40")


@dataclass
class Tables:
    """Lazy access to the driver's parquet tables of one scale factor."""

    spark: SparkSession
    sf_dir: str
    _cache: dict = field(default_factory=dict)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in TABLES:
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = self.spark.read.parquet(f"{self.sf_dir.rstrip('/')}/{name}.parquet")
        return self._cache[name]


def _s(c: Column) -> Column:
    return c.cast("string")


# --------------------------------------------------------------------------
# G: growth
# --------------------------------------------------------------------------

def growth_establishments(t: Tables, active_only: bool = False) -> DataFrame:
    """Typed establishments of binding G (active and closed).

    ``active_only`` keeps only active rows by filtering the source column
    itself, so the predicate reaches the lineitem scan before the joins
    (the derived status column would hide it from pushdown). Consumers that
    filter on status 2 anyway get the same rows."""
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                           "l_linestatus", "l_shipdate")
    if active_only:
        li = li.where(F.col("l_linestatus") == ACTIVE_STATUS_G)
    p = t.part.select("p_partkey", "p_type")
    s = t.supplier.select("s_suppkey", "s_nationkey")
    return (li.join(p, li.l_partkey == p.p_partkey)
              .join(s, li.l_suppkey == s.s_suppkey)
              .select(F.concat(_s(F.col("l_orderkey")), F.lit("-"), _s(F.col("l_linenumber"))).alias("cnpj"),
                      F.col("l_suppkey").alias("cnpj_basico"),
                      F.when(F.col("l_linestatus") == ACTIVE_STATUS_G, 2).otherwise(8)
                       .cast("smallint").alias("situacao_cadastral"),
                      F.col("l_shipdate").cast("date").alias("data_inicio_atividade"),
                      F.col("p_type").alias("cnae_principal"),
                      F.col("s_nationkey").alias("codigo_municipio"),
                      (F.col("l_orderkey") % SHARDS_G).cast("int").alias("shard")))


def growth_companies(t: Tables) -> DataFrame:
    return t.supplier.select(F.col("s_suppkey").alias("cnpj_basico"), F.col("s_name").alias("razao_social"))


def growth_sectors(t: Tables) -> DataFrame:
    """Sector dimension derived from the parts: one row per type."""
    return (t.part.select(F.col("p_type").alias("codigo")).distinct()
              .select("codigo", F.lower("codigo").alias("descricao")))


def growth_municipalities(t: Tables) -> DataFrame:
    return t.nation.select(F.col("n_nationkey").alias("codigo_municipio"), F.col("n_name").alias("nome"))


# --------------------------------------------------------------------------
# O: orders as establishments
# --------------------------------------------------------------------------

def _bad_date(key: Column, good: Column) -> Column:
    return (F.when(key % 10 == 3, F.lit("0"))
             .when(key % 100 == 9, F.lit("20240231"))
             .when(key % 100 == 19, F.lit("00000000"))
             .when(key % 100 == 29, F.lit(""))
             .otherwise(good))


def orders_raw_establishments(t: Tables) -> DataFrame:
    """Binding O in the raw, all-text establishment layout (a subset of the
    30 positional columns; the others are NULL)."""
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    c = t.customer.select("c_custkey", "c_nationkey")
    k = F.col("o_orderkey")
    ymd = F.date_format("o_orderdate", "yyyyMMdd")
    cols = {
        "cnpj_basico": F.lpad(_s(F.col("o_custkey")), 8, "0"),
        "cnpj_ordem": F.lpad(_s(k % 10000), 4, "0"),
        "cnpj_dv": F.when(k % 50 == 7, F.lit(None).cast("string"))
                    .otherwise(F.lpad(_s(F.floor(k / 10000) % 100), 2, "0")),
        "identificador_matriz_filial": F.lit("1"),
        "nome_fantasia": F.when(k % 5 == 0, F.lit(None).cast("string"))
                          .otherwise(F.concat(F.lit("PEDIDO "), _s(k))),
        "situacao_cadastral": F.when(F.col("o_orderstatus") == ACTIVE_STATUS_O, F.lit("02"))
                               .when(F.col("o_orderstatus") == "F", F.lit("08")).otherwise(F.lit("04")),
        "data_situacao_cadastral": ymd,
        "data_inicio_atividade": _bad_date(k, ymd),
        "cnae_principal": F.col("o_orderpriority"),
        "cep": F.lpad(_s(k % 100000000), 8, "0"),
        "codigo_municipio": F.lpad(_s(F.col("c_nationkey")), 4, "0"),
    }
    out = []
    for name in schemas.ESTABLISHMENT_LAYOUT:
        out.append((cols[name] if name in cols else F.lit(None).cast("string")).alias(name))
    return o.join(c, o.o_custkey == c.c_custkey).select(*out)


def orders_raw_companies(t: Tables, without_segment: str | None = None) -> DataFrame:
    """Binding O companies in the raw layout: every customer. A segment is
    left out only where a check needs references that miss."""
    c = t.customer
    if without_segment is not None:
        c = c.where(~F.col("c_mktsegment").eqNullSafe(without_segment))
    key = F.col("c_custkey")
    cap = F.replace(_s(F.col("c_acctbal").cast("decimal(15,2)")), F.lit("."), F.lit(","))
    cols = {
        "cnpj_basico": F.lpad(_s(key), 8, "0"),
        "razao_social": F.col("c_name"),
        "natureza_juridica": F.lpad(_s(F.col("c_nationkey")), 4, "0"),
        "capital_social": F.when(key % 13 == 5, F.concat(cap, F.lit(",00"))).otherwise(cap),
        "porte": F.when(key % 17 == 3, F.lit("07"))
                  .when(F.col("c_mktsegment") == "BUILDING", F.lit("01"))
                  .when(F.col("c_mktsegment") == "FURNITURE", F.lit("03"))
                  .when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit("05"))
                  .otherwise(F.lit("x")),
    }
    return c.select(*[(cols[n] if n in cols else F.lit(None).cast("string")).alias(n)
                      for n in schemas.COMPANY_LAYOUT])


def orders_sectors(t: Tables) -> DataFrame:
    """Sector dimension derived from the orders' priorities."""
    return (t.orders.select(F.col("o_orderpriority").alias("codigo")).distinct()
              .select("codigo", F.substring_index("codigo", "-", -1).alias("descricao")))


def orders_municipalities(t: Tables) -> DataFrame:
    return t.nation.select(F.lpad(_s(F.col("n_nationkey")), 4, "0").alias("codigo_municipio"),
                           F.col("n_name").alias("nome"))


def orders_place_candidates(t: Tables) -> DataFrame:
    """Place candidates keyed by company (``user_id`` = customer key), ranked
    by (ts, event_id); the payload is a place search's response: no place for
    every seventh event, else the place followed by another."""
    e = t.events
    k = F.get_json_object("props", "$.k").cast("int")
    place = F.struct(
        _s(F.col("event_id")).alias("id"),
        F.concat(F.lit("Rua "), F.col("event_type"), F.lit(", "), _s(F.col("user_id"))).alias("formattedAddress"),
        F.col("event_type").alias("internationalPhoneNumber"),
        F.when(F.col("event_type") == "purchase", F.concat(F.lit("site-"), _s(F.col("event_id"))))
         .alias("websiteUri"),
        (k / 10).alias("rating"),
        k.alias("userRatingCount"))
    other = place.withField("id", F.concat(F.lit("other-"), _s(F.col("event_id"))))
    places = F.when(F.col("event_id") % 7 == 3, F.filter(F.array(place), lambda p: F.lit(False))) \
              .otherwise(F.array(place, other))
    payload = F.to_json(F.struct(places.alias("places")))
    return e.select(F.lpad(_s(F.col("user_id")), 8, "0").alias("cnpj_basico"),
                    F.col("ts").alias("ordem_ts"), F.col("event_id").alias("ordem_id"),
                    F.col("event_type"), payload.alias("payload"))
