"""Query registry: one callable ``(spark, sf_dir) -> DataFrame`` per key of
SURVEY §7.6, binding the driver tables to the operators' roles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql import types as T

from .. import bindings as B
from .. import schemas
from ..operators import dashboard as D
from ..operators import growth as G
from ..operators import insight as I
from ..operators import leads as L
from ..operators import quality as Q
from ..operators import region as RG
from ..operators import registry as R
from ..session import configure, scratch_path, staged
from ..sinks import writes as W
from ..sources import shards as S

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        return fn(B.Tables(spark, sf_dir))
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    QUERIES[fn.__name__] = run
    return run


# ------------------------------------------------------------------ growth (G)

def _active_g(t: B.Tables) -> DataFrame:
    return B.growth_establishments(t, active_only=True)


def _stats_g(t: B.Tables) -> DataFrame:
    return G.growth_stats(_active_g(t))


def _ranking_g(t: B.Tables) -> DataFrame:
    return G.growth_ranking(_stats_g(t), B.growth_sectors(t), B.growth_municipalities(t))


@query
def monthly_openings(t):
    return G.monthly_openings(_active_g(t))


@query
def trailing_mean(t):
    return G.trailing_mean(G.monthly_openings(_active_g(t)))


@query
def growth_stats(t):
    """K5: the statistics as the table they are written to holds them."""
    root = scratch_path(t.spark, "estatisticas")
    W.refresh(t.spark, root, {"estatisticas_crescimento": _stats_g(t)})
    return W.read_current(t.spark, root, "estatisticas_crescimento")


@query
def growth_ranking(t):
    r = _ranking_g(t)
    return r.select("posicao", "cnae_codigo", "codigo_municipio", "ano_mes", "total_aberturas",
                    "variacao_pct", F.col("cnaes.descricao").alias("cnae_descricao"),
                    F.col("municipios.nome").alias("municipio_nome"))


@query
def format_variation(t):
    from ..functions.fmt import format_variation as fmt
    return _stats_g(t).select("cnae_codigo", "codigo_municipio", "ano_mes", "variacao_pct",
                              fmt("variacao_pct").alias("variacao_fmt"))


@query
def growth_chart(t):
    return D.growth_chart(_ranking_g(t))


@query
def growth_axis_bound(t):
    return D.growth_axis_bound(D.growth_chart(_ranking_g(t)))


@query
def dashboard_kpis(t):
    return D.dashboard_kpis(_active_g(t), _ranking_g(t))


def _top5_g(t):
    return G.latest_month_top(_stats_g(t), B.growth_sectors(t), B.growth_municipalities(t))


@query
def latest_month_top5(t):
    return _top5_g(t)


@query
def insight_snapshot(t):
    return I.snapshot_rows(I.insight_snapshot(_top5_g(t)))


@query
def lead_ranking(t):
    return L.lead_ranking(_active_g(t), B.growth_companies(t),
                          B.growth_municipalities(t), _stats_g(t))


@query
def companies_keep_first(t):
    li = t.lineitem
    key = ["l_orderkey", "l_linenumber"]
    return R.keep_first(li, key, [c for c in li.columns if c not in key])


@query
def pk_violations(t):
    return Q.union_checks(
        Q.pk_violations(B.growth_establishments(t), ["cnpj"], "estabelecimentos"),
        Q.pk_violations(_stats_g(t), ["cnae_codigo", "codigo_municipio", "ano_mes"],
                        "estatisticas_crescimento"),
        Q.pk_violations(B.growth_municipalities(t), ["codigo_municipio"], "municipios"),
        Q.pk_violations(B.orders_sectors(t), ["codigo"], "cnaes"),
        Q.pk_violations(t.customer.select(F.col("c_nationkey").alias("codigo")), ["codigo"], "natureza_juridica"),
        Q.pk_violations(B.orders_raw_companies(t), ["cnpj_basico"], "empresas"),
        Q.pk_violations(_enrichment_o(t), ["cnpj"], "leads_enriquecidos"),
        Q.pk_violations(_insight_log(t), ["id"], "insights_ia"))


@query
def region_filter(t):
    codes = RG.region_codes(B.growth_municipalities(t), B.DRIVER_REGION)
    return RG.filter_region(B.growth_establishments(t), codes)


def _staged_shards(t) -> str:
    path = scratch_path(t.spark, "estabelecimentos_shards")
    W.counted_write(B.growth_establishments(t), path, partition_by=["shard"])
    return path


@query
def parquet_roundtrip(t):
    return t.spark.read.parquet(_staged_shards(t))


@query
def union_shards(t):
    return S.union_shards(t.spark, _staged_shards(t)).drop("arquivo", "linha")


# Batch of the batch-scan query (a user's choice).
BATCH = "1997"


@query
def scan_batch(t):
    """One ``lote=`` partition of a staged history, pruned when planned."""
    path = scratch_path(t.spark, "estabelecimentos_lotes")
    lote = F.date_format("data_inicio_atividade", "yyyy").alias("lote")
    W.counted_write(B.growth_establishments(t).select("*", lote), path, partition_by=["lote"])
    return S.union_shards(t.spark, path, batch=BATCH).withColumn("lote", F.col("lote").cast("string")).drop("arquivo", "linha")


@query
def shard_counts(t):
    return S.shard_counts(S.union_shards(t.spark, _staged_shards(t)))


@query
def load_overwrite(t):
    root = scratch_path(t.spark, "warehouse")
    est = _active_g(t)
    cols = ["cnpj", "cnpj_basico", "situacao_cadastral", "data_inicio_atividade",
            "cnae_principal", "codigo_municipio"]
    W.refresh(t.spark, root, {"estabelecimentos": est, "empresas": B.growth_companies(t)},
              columns={"estabelecimentos": cols}, cascade={"leads_enriquecidos": schemas.ENRICHMENT})
    return W.read_current(t.spark, root, "estabelecimentos")


# ------------------------------------------------------------------ orders (O)

def _est_o(t):
    return R.establishments_final(B.orders_raw_establishments(t))


def _companies_o(t):
    return R.companies_final(B.orders_raw_companies(t), _est_o(t))


def _enrichment_o(t, half: int | None = None):
    cand = B.orders_place_candidates(t)
    if half is not None:
        cand = cand.where(F.col("ordem_id") % 2 == half)
    return L.place_first_match(_est_o(t), cand, key="cnpj_basico", rank=("ordem_ts", "ordem_id"))


def _recent_o(t):
    return L.recent_leads(_est_o(t), _companies_o(t), B.orders_sectors(t),
                          B.orders_municipalities(t), _enrichment_o(t))


def _display_o(t):
    return L.leads_display(_recent_o(t))


# Search text of the leads-search queries (a user's input).
SEARCH_TEXT = "nation_2"


@query
def establishments_final(t):
    return _est_o(t)


@query
def compose_key(t):
    from ..functions.parse import compose_key as ck
    raw = B.orders_raw_establishments(t)
    return raw.select("cnpj_basico", "cnpj_ordem", "cnpj_dv",
                      ck("cnpj_basico", "cnpj_ordem", "cnpj_dv").alias("cnpj"))


@query
def parse_registry_date(t):
    from ..functions.parse import parse_registry_date as prd
    raw = B.orders_raw_establishments(t)
    return raw.select(F.col("data_inicio_atividade").alias("data_raw"),
                      F.length("data_inicio_atividade").alias("tamanho"),
                      prd("data_inicio_atividade").alias("data"))


@query
def parse_capital(t):
    from ..functions.parse import parse_capital as pc
    raw = B.orders_raw_companies(t)
    return raw.select("cnpj_basico", F.col("capital_social").alias("capital_raw"),
                      pc("capital_social").alias("capital_social"))


@query
def companies_semi(t):
    return R.companies_semi(R.typed_companies(B.orders_raw_companies(t)), _est_o(t))


@query
def place_first_match(t):
    return _enrichment_o(t)


@query
def enrichment_upsert(t):
    root = scratch_path(t.spark, "enrichment")
    for half in (0, 1):  # all events, in two batches
        out = W.upsert_table(t.spark, root, "leads_enriquecidos", _enrichment_o(t, half), "cnpj",
                             schemas.ENRICHMENT_STORED, touch="enriquecido_em")
    # the clock column is left out of the comparable result
    return out.select(*schemas.ENRICHMENT.fieldNames())


@query
def reference_upsert(t):
    from ..constants import STATE_DEFAULT
    root = scratch_path(t.spark, "reference")
    schema = "codigo_municipio string, nome string, uf string"
    # Stored states, some not the default; the upsert lists code and name only.
    existing = B.orders_municipalities(t).withColumn(
        "uf", F.when(F.col("codigo_municipio").cast("int") % 2 == 1, F.lit("SC")).otherwise(F.lit(STATE_DEFAULT)))
    W.upsert_table(t.spark, root, "municipios", existing, "codigo_municipio", T.StructType.fromDDL(schema))
    c = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    known = c.select(
        F.lpad(F.col("c_nationkey").cast("string"), 4, "0").alias("codigo_municipio"),
        F.concat(F.col("n_name"), F.lit(" / "), F.col("c_mktsegment")).alias("nome"),
        F.col("c_custkey").alias("seq"))
    new = t.supplier.select(
        F.concat(F.lit("N"), F.lpad(F.col("s_nationkey").cast("string"), 4, "0")).alias("codigo_municipio"),
        F.col("s_name").alias("nome"), F.col("s_suppkey").alias("seq"))
    return W.upsert_table(t.spark, root, "municipios", known.unionByName(new), "codigo_municipio",
                          T.StructType.fromDDL(schema), seq="seq", defaults={"uf": STATE_DEFAULT})


@query
def recent_leads(t):
    r = _recent_o(t)
    return r.select("posicao", "cnpj", "nome_fantasia", "data_inicio_atividade", "situacao_cadastral",
                    F.col("empresas.razao_social").alias("empresa_razao_social"),
                    F.col("empresas.porte").alias("empresa_porte"),
                    F.col("cnaes.descricao").alias("cnae_descricao"),
                    F.col("municipios.nome").alias("municipio_nome"),
                    F.col("leads_enriquecidos.endereco_formatado").alias("enr_endereco"),
                    F.col("leads_enriquecidos.telefone_places").alias("enr_telefone"),
                    F.col("leads_enriquecidos.website").alias("enr_website"),
                    F.col("leads_enriquecidos.rating_google").alias("enr_rating"))


@query
def leads_display(t):
    return _display_o(t)


@query
def leads_search(t):
    return L.leads_search(_display_o(t), SEARCH_TEXT)


@query
def leads_search_count(t):
    return L.leads_search(_display_o(t), SEARCH_TEXT).agg(F.count(F.lit(1)).alias("total"))


@query
def leads_sorted(t):
    return L.leads_sorted(_display_o(t), "empresa", ascending=True)


@query
def leads_export(t):
    folder = scratch_path(t.spark, "exports")
    frame = L.leads_export_frame(_recent_o(t))
    path = W.export_csv(frame.drop("linha"), folder, order="posicao")
    back = (t.spark.read.option("sep", ";").option("header", True).option("quote", '"')
                  .option("escape", '"').csv(path))
    names = ["cnpj", "razao_social", "setor", "municipio", "data_abertura", "telefone"]
    back = back.select(*[F.col(f"`{h}`").alias(n) for h, n in zip(schemas.EXPORT_HEADER, names)])
    line = F.array_join(F.array(*[F.coalesce(F.col(n), F.lit("")) for n in names]), ";")
    # The file is one page, read by one task: its line numbers are the order.
    return back.withColumns({"linha": line, "posicao": (F.monotonically_increasing_id() + 1).cast("int")})


@query
def lead_search_text(t):
    return L.search_texts(_est_o(t), _companies_o(t), B.orders_municipalities(t))


def _municipality_names_o(t):
    # Municipality rows as all establishments see them, active or not (derived,
    # so the resolution reads data that grows with the tables).
    return B.orders_raw_establishments(t).join(B.orders_municipalities(t), "codigo_municipio").select("codigo_municipio", "nome")


@query
def region_codes(t):
    return RG.region_codes(_municipality_names_o(t), B.DRIVER_REGION)


@query
def region_missing(t):
    return RG.region_missing(_municipality_names_o(t), B.DRIVER_REGION)


@query
def fk_violations(t):
    est, stats = _est_o(t), _stats_g(t)
    comp = R.companies_final(B.orders_raw_companies(t, B.DROPPED_SEGMENT_O), est)
    return Q.union_checks(
        Q.fk_violations(comp, "natureza_juridica", B.orders_municipalities(t), "codigo_municipio", "empresas"),
        Q.fk_violations(stats, "cnae_codigo", B.growth_sectors(t), "codigo", "estatisticas_crescimento"),
        Q.fk_violations(stats, "codigo_municipio", B.growth_municipalities(t), "codigo_municipio",
                        "estatisticas_crescimento"),
        Q.fk_violations(est, "cnpj_basico", comp, "cnpj_basico", "estabelecimentos"),
        Q.fk_violations(est, "cnae_principal", B.orders_sectors(t), "codigo", "estabelecimentos"),
        Q.fk_violations(est, "codigo_municipio", B.orders_municipalities(t), "codigo_municipio",
                        "estabelecimentos"),
        Q.fk_violations(_enrichment_o(t), "cnpj", est, "cnpj", "leads_enriquecidos"))


def _not_null_tables(t) -> dict:
    """The eight tables; some descriptions and models are left out, so that the check has what to find."""
    code = F.col("c_nationkey")
    nature = t.customer.select(code.cast("string").alias("codigo"),
                               F.when(code % 6 != 2, F.col("c_mktsegment")).alias("descricao"))
    return {"municipios": B.orders_municipalities(t), "cnaes": B.orders_sectors(t), "natureza_juridica": nature,
            "empresas": _companies_o(t), "estabelecimentos": _est_o(t), "estatisticas_crescimento": _stats_g(t),
            "leads_enriquecidos": _enrichment_o(t),
            "insights_ia": _insight_log(t).withColumn("modelo", F.when(F.col("id") % 50 != 3, F.col("modelo")))}


@query
def not_null_violations(t):
    return Q.declared_not_null(_not_null_tables(t))


@query
def domain_violations(t):
    from ..constants import SIZE_DOMAIN, STATUS_DOMAIN
    from ..functions.parse import parse_capital as pc
    est = _est_o(t)
    typed = R.typed_establishments(B.orders_raw_establishments(t))
    comp = _companies_o(t)
    return Q.union_checks(
        Q.row_checks(est, "estabelecimentos", [("cnpj", Q.too_long("cnpj", 14)),
                                               ("cep", Q.too_long("cep", 8)),
                                               ("cnae_principal", Q.too_long("cnae_principal", 7)),
                                               ("codigo_municipio", Q.too_long("codigo_municipio", 7))]),
        Q.row_checks(typed, "estabelecimentos", [("situacao_cadastral",
                                                  Q.outside("situacao_cadastral", STATUS_DOMAIN))]),
        Q.row_checks(comp, "empresas", [("natureza_juridica", Q.too_long("natureza_juridica", 4)),
                                        ("porte", Q.outside("porte", SIZE_DOMAIN)),
                                        ("capital_social", Q.not_numeric("capital_social", 15, 2))]),
        # On the text as it arrives, where a number can still fail to fit.
        Q.row_checks(B.orders_raw_companies(t), "empresas_brutas", [
            ("capital_social", F.col("capital_social").isNotNull() & pc("capital_social").isNull())]))


def _insight_log(t):
    e = t.events
    return e.select(F.col("event_id").alias("id"), F.col("event_type").alias("titulo"),
                    F.col("props").alias("conteudo"), F.col("props").alias("baseado_em"),
                    F.col("event_type").alias("modelo"), F.col("ts").alias("gerado_em"))


@query
def insight_log_append(t):
    path = scratch_path(t.spark, "insights_ia")
    log = _insight_log(t)
    W.append(log.where(F.col("id") % 2 == 0), path)
    W.append(log.where(F.col("id") % 2 == 1), path)
    return t.spark.read.parquet(path)


@query
def latest_insight(t):
    return I.latest_insight(_insight_log(t)).select("id", "titulo", "gerado_em")


# --------------------------------------------------------------- documents (D)

@query
def normalize_name(t):
    from ..functions.text import normalize_name as nn
    return t.documents.select("doc_id", nn("text").alias("nome_normalizado"))


@query
def normalize_name_udf(t):
    from ..functions.text import normalize_name_udf as nnu
    return t.documents.select("doc_id", nnu("text").alias("nome_normalizado"))


@query
def truncate_label(t):
    from ..functions.text import truncate_label as tl
    from ..constants import CHART_LABEL_WIDTH, KPI_LABEL_WIDTH
    return t.documents.select("doc_id", tl("text", CHART_LABEL_WIDTH).alias("rotulo_26"),
                              tl("text", KPI_LABEL_WIDTH).alias("rotulo_22"))


DOC_LAYOUT = ("doc_id", "text", "lang", "source", "n_chars")


def _doc_types(df):
    return df.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "lang", "source",
                     F.col("n_chars").cast("bigint").alias("n_chars"))


@query
def scan_delimited(t):
    from ..sources.delimited import scan_delimited as scan, write_delimited
    path = scratch_path(t.spark, "documentos_csv")
    write_delimited(t.documents.select(*[F.col(c).cast("string") for c in DOC_LAYOUT]), path)
    return _doc_types(scan(t.spark, path, DOC_LAYOUT))


@query
def scan_zip(t):
    from ..session import local_dir
    from ..sources.zipsource import scan_zip as scan, write_zip_shards
    folder = local_dir(scratch_path(t.spark, "documentos_zip"))
    write_zip_shards(t.documents.select(*[F.col(c).cast("string") for c in DOC_LAYOUT]), folder,
                     "Documentos", 4)
    return _doc_types(scan(t.spark, folder, DOC_LAYOUT))


# ------------------------------------------------------------ raw text by ranges

@query
def scan_ranges(t):
    """S1 as ``scan_delimited``, for files of any size: quoted line breaks and split files."""
    from ..sources.delimited import write_delimited
    from ..sources.records import scan_ranges as scan
    path = scratch_path(t.spark, "documentos_faixas")
    write_delimited(t.documents.select(*[F.col(c).cast("string") for c in DOC_LAYOUT]), path, encoding="UTF-8")
    return _doc_types(scan(t.spark, path, DOC_LAYOUT, encoding="UTF-8"))


RAW_LAYOUT = ("cnpj", "cnpj_basico", "data")


def _raw_shards(t) -> str:
    """Raw text shards of the G establishments, each in order of its keys; every ninth name breaks its line."""
    key, number = F.col("l_orderkey"), F.col("l_linenumber")
    name = F.concat(key.cast("string"), F.when(key % 9 == 0, F.lit("\n;")).otherwise(F.lit("-")), number.cast("string"))
    line = F.concat(F.lit('"'), name, F.lit('";"'), F.col("l_suppkey").cast("string"), F.lit('";"'),
                    F.col("l_shipdate").cast("date").cast("string"), F.lit('"'))
    order = ["shard", "l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate"]
    path = scratch_path(t.spark, "registros_texto")
    width = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    (t.lineitem.withColumn("shard", key % B.SHARDS_G).repartitionByRange(width, *order).sortWithinPartitions(*order)
      .select(line.alias("value"), "shard").write.partitionBy("shard").text(path))
    return path


def _numbered(t):
    from ..sources.records import scan_ranges as scan
    rows = scan(t.spark, _raw_shards(t), RAW_LAYOUT, encoding="UTF-8", per_folder=True)
    return rows.withColumn("shard", F.regexp_extract("arquivo", "shard=([0-9]+)/", 1).cast("long"))


@query
def record_numbers(t):
    """The number of every record in its shard, whatever ranges and files it was read from."""
    return _numbered(t).select("shard", "linha", *RAW_LAYOUT)


@query
def text_keep_first(t):
    """A5/C7 over raw text: the first record of each company in (shard, record) order."""
    return S.keep_first_record(_numbered(t), ["cnpj_basico"]).select("cnpj_basico", "shard", "cnpj", "data")


def _landed_with_rejected(t) -> tuple[str, T.StructType]:
    """Text of the orders with planted short, long and unreadable records, accepted and rejected parted: folder, columns."""
    from ..sources.records import scan_ranges as scan, with_reason
    key = F.col("o_orderkey")
    name = F.concat(F.lit("PEDIDO "), key.cast("string"), F.when(key % 3 == 0, F.lit("\nsala; \"\"x\"\"")).otherwise(F.lit("")))
    head = F.concat(F.lit('"'), key.cast("string"), F.lit('";"'), name, F.lit('"'))
    whole = F.concat(head, F.lit(';"'), F.date_format("o_orderdate", "yyyyMMdd"), F.lit('"'))
    line = (F.when(key % 97 == 1, head).when(key % 97 == 2, F.concat(whole, F.lit(';"sobra"')))
             .when(key % 97 == 3, F.concat(F.lit("### "), key.cast("string"))).otherwise(whole))
    raw, out = scratch_path(t.spark, "pedidos_texto"), scratch_path(t.spark, "pedidos_aceitos")
    t.orders.select(line.alias("value"), (key % B.SHARDS_G).alias("shard")).write.partitionBy("shard").text(raw)
    rows = scan(t.spark, raw, ("pedido", "nome", "data"), encoding="UTF-8", keep_corrupt=True)
    shard = F.regexp_extract("arquivo", "shard=(-?[0-9]+)/", 1).cast("long")
    parted = with_reason(rows.withColumn("shard", shard), 3)
    W.land_parted(parted, out)
    return out, T.StructType(parted.schema.fields + [T.StructField("rejeitado", T.StringType())])


@query
def rejected_counts(t):
    """Records read, accepted and rejected by reason, per shard and in all."""
    return S.record_counts(t.spark.read.parquet(_landed_with_rejected(t)[0]))


@query
def rejected_records(t):
    """C17: the rejected records with their text and reason; accepted ones are typed as usual."""
    path, schema = _landed_with_rejected(t)
    landed = t.spark.read.schema(schema).parquet(path)       # without any record there is no file that tells the columns
    return landed.where("rejeitado = 'true'").select("shard", "motivo", F.col("_corrupt_record").alias("texto"))


# ------------------------------------------------------- order, clocks, batches

@query
def leads_positions(t):
    """T4/T7 for the whole table: position and page of every active establishment, newest first."""
    from ..operators.order import positions
    est = R.establishments_final(B.orders_raw_establishments(t)).select(
        "cnpj", "cnpj_basico", "nome_fantasia", "data_inicio_atividade")
    order = [F.col("data_inicio_atividade").desc_nulls_last(), F.col("cnpj").asc_nulls_last(),
             F.col("cnpj_basico").asc_nulls_last(), F.col("nome_fantasia").asc_nulls_last()]
    return positions(est, order)


@query
def growth_incremental(t):
    """R4 in three batches of months, each from the carried state alone."""
    from . import jobs
    root = scratch_path(t.spark, "incremental")
    est = _active_g(t)
    year = F.year("data_inicio_atividade")
    for part in (year < 1995, year.between(1995, 1996), year > 1996):
        jobs.advance_growth(t.spark, root, est.where(part))
    return W.read_current(t.spark, root, "estatisticas_crescimento").select(*schemas.GROWTH_STATS.fieldNames())


@query
def upsert_clock(t):
    """rows whose clock an upsert moved: K8 moves the incoming keys', K7 none."""
    root = scratch_path(t.spark, "relogio")

    def stored():
        return W.read_current(t.spark, root, "leads_enriquecidos").select("cnpj", "enriquecido_em")

    def told(name, before, after):
        both = before.withColumnRenamed("enriquecido_em", "antes").join(after, "cnpj")
        return both.agg(F.lit(name).alias("operador"), F.count_if(F.col("enriquecido_em") > F.col("antes")).alias("movidos"),
                        F.count_if(F.col("enriquecido_em") == F.col("antes")).alias("parados"))

    def put(rows, touch):
        W.upsert_table(t.spark, root, "leads_enriquecidos", rows, "cnpj", schemas.ENRICHMENT_STORED, touch=touch)
        return staged(stored(), "relogio")

    first = put(_enrichment_o(t, 0), "enriquecido_em")
    second = put(_enrichment_o(t, 1), "enriquecido_em")
    third = put(_enrichment_o(t, 0), None)
    return told("K8", first, second).unionByName(told("K7", second, third))


@query
def export_named(t):
    """The export of a day carries the day in its name; here the newest order date."""
    day = t.orders.agg(F.max("o_orderdate").cast("date").cast("string")).first()[0]
    frame = R.typed_companies(B.orders_raw_companies(t)).select("cnpj_basico", "razao_social", "natureza_juridica")
    path = W.export_csv(frame, scratch_path(t.spark, "exports"), header=("CNPJ", "Razão Social", "Natureza"), day=day)
    back = t.spark.read.option("sep", ";").option("header", True).csv(path)
    folder = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    return back.select(folder.alias("nome")).groupBy("nome").agg(F.count(F.lit(1)).alias("linhas"))


# Search text of the search over all leads (a user's input).
SEARCH_ALL = "#00000012"


@query
def leads_search_all(t):
    """W8 over every active lead: a trigram index, then the exact check."""
    from ..operators import search_index as SI
    est = _est_o(t)
    display = L.leads_display(L.all_leads(est, _companies_o(t), B.orders_sectors(t), B.orders_municipalities(t),
                                          _enrichment_o(t)))
    return SI.search(t.spark, SI.build_index(t.spark, display), SEARCH_ALL)
