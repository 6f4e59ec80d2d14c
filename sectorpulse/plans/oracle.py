"""Independent ANSI SQL (DuckDB dialect) for every query key.

The driver tables are pre-registered views. Each statement restates the
role binding of ``bindings.py`` and the operator's semantics from scratch,
so it checks the Spark plans rather than mirroring them.
"""

from __future__ import annotations

# ---------------------------------------------------------------- bindings
EST_G = """est_g AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS cnpj,
         l_suppkey AS cnpj_basico,
         CAST(CASE WHEN l_linestatus = 'O' THEN 2 ELSE 8 END AS SMALLINT) AS situacao_cadastral,
         CAST(l_shipdate AS DATE) AS data_inicio_atividade,
         p_type AS cnae_principal,
         s_nationkey AS codigo_municipio,
         CAST(l_orderkey % 4 AS INTEGER) AS shard
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey)"""

STATS_G = EST_G + """,
m AS (
  SELECT cnae_principal AS cnae_codigo, codigo_municipio,
         CAST(date_trunc('month', data_inicio_atividade) AS DATE) AS ano_mes,
         CAST(count(*) AS INTEGER) AS total_aberturas
  FROM est_g WHERE situacao_cadastral = 2 AND data_inicio_atividade IS NOT NULL
  GROUP BY 1, 2, 3),
w AS (
  SELECT *, CAST(sum(total_aberturas) OVER win AS BIGINT) AS s, count(total_aberturas) OVER win AS n,
         avg(total_aberturas) OVER win AS media
  FROM m WINDOW win AS (PARTITION BY cnae_codigo, codigo_municipio ORDER BY ano_mes
                        ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING)),
stats AS (
  SELECT cnae_codigo, codigo_municipio, ano_mes, total_aberturas,
         CASE WHEN s IS NULL OR s = 0 THEN NULL
              ELSE CAST(CAST(sign(CAST(total_aberturas AS BIGINT) * n - s)
                             * ((2 * abs((CAST(total_aberturas AS BIGINT) * n - s) * 10000) + s) // (2 * s))
                        AS DECIMAL(18,0)) * 0.01 AS DECIMAL(6,2)) END AS variacao_pct
  FROM w),
cnaes_g AS (SELECT DISTINCT p_type AS codigo, lower(p_type) AS descricao FROM part),
mun_g AS (SELECT n_nationkey AS codigo_municipio, n_name AS nome FROM nation),
ranking AS (
  SELECT CAST(row_number() OVER (ORDER BY variacao_pct DESC, cnae_codigo, codigo_municipio, ano_mes) AS INTEGER) AS posicao, *
  FROM stats WHERE variacao_pct IS NOT NULL AND total_aberturas >= 5
  ORDER BY variacao_pct DESC, cnae_codigo, codigo_municipio, ano_mes LIMIT 8),
ranking_named AS (
  SELECT r.*, c.descricao AS cnae_descricao, mu.nome AS municipio_nome
  FROM ranking r LEFT JOIN cnaes_g c ON c.codigo = r.cnae_codigo
                 LEFT JOIN mun_g mu ON mu.codigo_municipio = r.codigo_municipio)"""


ORACLE: dict[str, str] = {}

ORACLE["monthly_openings"] = f"""WITH {STATS_G}
SELECT cnae_codigo, codigo_municipio, ano_mes, total_aberturas FROM m"""

ORACLE["trailing_mean"] = f"""WITH {STATS_G}
SELECT cnae_codigo, codigo_municipio, ano_mes, total_aberturas,
       s AS soma_janela, n AS n_janela, media AS media_movel_6m FROM w"""

ORACLE["growth_stats"] = f"""WITH {STATS_G}
SELECT * FROM stats"""

ORACLE["growth_ranking"] = f"""WITH {STATS_G}
SELECT posicao, cnae_codigo, codigo_municipio, ano_mes, total_aberturas, variacao_pct,
       cnae_descricao, municipio_nome FROM ranking_named"""


def fmt_variation_sql(x: str) -> str:
    """pt-BR signed percentage, one decimal, em dash for NULL."""
    return (f"CASE WHEN {x} IS NULL THEN '—' ELSE "
            f"(CASE WHEN {x} > 0 THEN '+' WHEN {x} < 0 THEN '-' ELSE '' END) || "
            f"translate(format('{{:,.1f}}', CAST(abs(round({x}, 1)) AS DOUBLE)), ',.', '.,') || '%' END")


def trunc_sql(x: str, n: int) -> str:
    return f"CASE WHEN length({x}) > {n} THEN substr({x}, 1, {n - 1}) || '…' ELSE {x} END"


def norm_sql(x: str) -> str:
    """NFKD-to-ASCII, strip (Python whitespace), upper."""
    ws = " || ".join(f"chr({c})" for c in (32, 9, 10, 11, 12, 13, 28, 29, 30, 31))
    return f"upper(trim(regexp_replace(strip_accents({x}), '[^\\x00-\\x7F]', '', 'g'), {ws}))"


REGION_IN = "('NATION_1', 'NATION_4', 'NATION_9', 'NATION_16', 'NATION_23', 'NATION_40')"

ORACLE["format_variation"] = f"""WITH {STATS_G}
SELECT cnae_codigo, codigo_municipio, ano_mes, variacao_pct,
       {fmt_variation_sql('variacao_pct')} AS variacao_fmt FROM stats"""

CHART = """chart AS (
  SELECT posicao,
         COALESCE(cnae_descricao, 'CNAE ' || CAST(cnae_codigo AS VARCHAR)) AS setor_completo,
         COALESCE(municipio_nome, 'Município ' || CAST(codigo_municipio AS VARCHAR)) AS municipio,
         COALESCE(variacao_pct, CAST(0 AS DECIMAL(6,2))) AS variacao_pct, total_aberturas
  FROM ranking_named)"""

ORACLE["growth_chart"] = f"""WITH {STATS_G}, {CHART}
SELECT posicao, {trunc_sql('setor_completo', 26)} AS setor, setor_completo, municipio, variacao_pct,
       total_aberturas, CASE WHEN variacao_pct >= 0 THEN 'up' ELSE 'down' END AS direcao,
       {fmt_variation_sql('variacao_pct')} AS rotulo
FROM chart"""

ORACLE["growth_axis_bound"] = f"""WITH {STATS_G}, {CHART}
SELECT CAST(ceil(greatest(CAST(1 AS DECIMAL(10,2)), COALESCE(max(abs(variacao_pct)), CAST(1 AS DECIMAL(10,2))))
                 * CAST(1.15 AS DECIMAL(3,2))) AS BIGINT) AS eixo_max FROM chart"""

ORACLE["dashboard_kpis"] = f"""WITH {STATS_G},
k AS (SELECT count(*) AS total, count(DISTINCT codigo_municipio) AS mc FROM est_g WHERE situacao_cadastral = 2),
f AS (SELECT * FROM ranking_named WHERE posicao = 1)
SELECT k.total AS total_estabelecimentos, replace(format('{{:,}}', k.total), ',', '.') AS total_fmt,
       COALESCE((SELECT {trunc_sql('cnae_descricao', 22)} FROM f), '—') AS setor_destaque,
       (SELECT {fmt_variation_sql('variacao_pct')} FROM f) AS variacao_destaque,
       k.mc AS municipios_cobertos, least(k.total, 500) AS leads_carregados
FROM k"""

TOP5 = """top5 AS (
  SELECT CAST(row_number() OVER (ORDER BY variacao_pct DESC, st.cnae_codigo, st.codigo_municipio, ano_mes) AS INTEGER) AS posicao,
         c.descricao AS setor, mu.nome AS municipio, total_aberturas, variacao_pct,
         st.cnae_codigo, st.codigo_municipio, ano_mes
  FROM stats st JOIN cnaes_g c ON c.codigo = st.cnae_codigo
                JOIN mun_g mu ON mu.codigo_municipio = st.codigo_municipio
  WHERE ano_mes = (SELECT max(ano_mes) FROM stats) AND variacao_pct IS NOT NULL
  ORDER BY posicao LIMIT 5)"""

ORACLE["latest_month_top5"] = f"""WITH {STATS_G}, {TOP5}
SELECT * FROM top5"""

ORACLE["insight_snapshot"] = f"""WITH {STATS_G}, {TOP5}
SELECT posicao, setor, municipio, total_aberturas, CAST(variacao_pct AS VARCHAR) AS variacao_pct FROM top5"""

ORACLE["lead_ranking"] = f"""WITH {STATS_G}
SELECT e.cnpj, s_name AS razao_social, mu.nome AS municipio, st.cnae_codigo, st.codigo_municipio,
       st.ano_mes, st.variacao_pct
FROM est_g e JOIN supplier ON s_suppkey = e.cnpj_basico
             JOIN mun_g mu ON mu.codigo_municipio = e.codigo_municipio
             JOIN stats st ON st.cnae_codigo = e.cnae_principal AND st.codigo_municipio = e.codigo_municipio
WHERE e.situacao_cadastral = 2
ORDER BY st.variacao_pct DESC NULLS LAST, st.cnae_codigo, st.codigo_municipio, st.ano_mes,
         e.cnpj, s_name, mu.nome
LIMIT 50"""

ORACLE["companies_keep_first"] = """SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_partkey NULLS FIRST, l_suppkey NULLS FIRST, l_quantity NULLS FIRST,
             l_extendedprice NULLS FIRST, l_discount NULLS FIRST, l_tax NULLS FIRST,
             l_returnflag NULLS FIRST, l_linestatus NULLS FIRST, l_shipdate NULLS FIRST) AS rn
  FROM lineitem) WHERE rn = 1"""

ORACLE["region_filter"] = f"""WITH {EST_G}
SELECT * FROM est_g WHERE codigo_municipio IN (
  SELECT n_nationkey FROM nation WHERE {norm_sql('n_name')} IN {REGION_IN})"""

ORACLE["parquet_roundtrip"] = f"""WITH {EST_G} SELECT * FROM est_g"""

ORACLE["union_shards"] = f"""WITH {EST_G} SELECT *, 'shard=' || CAST(shard AS VARCHAR) AS shard_nome FROM est_g"""

ORACLE["scan_batch"] = f"""WITH {EST_G}
SELECT *, '1997' AS lote, 'lote=1997' AS shard_nome FROM est_g WHERE year(data_inicio_atividade) = 1997"""

ORACLE["shard_counts"] = f"""WITH {EST_G}
SELECT shard_nome, count(*) AS linhas
FROM (SELECT 'shard=' || CAST(shard AS VARCHAR) AS shard_nome FROM est_g)
GROUP BY ROLLUP (shard_nome)"""

ORACLE["load_overwrite"] = f"""WITH {EST_G}
SELECT cnpj, cnpj_basico, situacao_cadastral, data_inicio_atividade, cnae_principal, codigo_municipio
FROM est_g WHERE situacao_cadastral = 2"""

# ------------------------------------------------------------------ orders (O)
RAW_O = """raw_o AS (
  SELECT lpad(CAST(o_custkey AS VARCHAR), 8, '0') AS cnpj_basico,
         lpad(CAST(o_orderkey % 10000 AS VARCHAR), 4, '0') AS cnpj_ordem,
         CASE WHEN o_orderkey % 50 = 7 THEN NULL
              ELSE lpad(CAST((o_orderkey // 10000) % 100 AS VARCHAR), 2, '0') END AS cnpj_dv,
         CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE 'PEDIDO ' || CAST(o_orderkey AS VARCHAR) END AS nome_fantasia,
         CASE WHEN o_orderstatus = 'O' THEN '02' WHEN o_orderstatus = 'F' THEN '08' ELSE '04' END
           AS situacao_cadastral,
         strftime(o_orderdate, '%Y%m%d') AS data_situacao_cadastral,
         CASE WHEN o_orderkey % 10 = 3 THEN '0' WHEN o_orderkey % 100 = 9 THEN '20240231'
              WHEN o_orderkey % 100 = 19 THEN '00000000' WHEN o_orderkey % 100 = 29 THEN ''
              ELSE strftime(o_orderdate, '%Y%m%d') END AS data_inicio_atividade,
         o_orderpriority AS cnae_principal,
         lpad(CAST(o_orderkey % 100000000 AS VARCHAR), 8, '0') AS cep,
         lpad(CAST(c_nationkey AS VARCHAR), 4, '0') AS codigo_municipio
  FROM orders JOIN customer ON o_custkey = c_custkey)"""


def parse_date_sql(x: str) -> str:
    return f"CASE WHEN length({x}) = 8 THEN CAST(try_strptime({x}, '%Y%m%d') AS DATE) END"


BASE_O = RAW_O + f""",
est_o AS (
  SELECT cnpj_basico || cnpj_ordem || cnpj_dv AS cnpj, cnpj_basico, nome_fantasia,
         TRY_CAST(situacao_cadastral AS SMALLINT) AS situacao_cadastral,
         {parse_date_sql('data_situacao_cadastral')} AS data_situacao,
         {parse_date_sql('data_inicio_atividade')} AS data_inicio_atividade,
         cnae_principal, codigo_municipio,
         CAST(NULL AS VARCHAR) AS logradouro, CAST(NULL AS VARCHAR) AS numero,
         CAST(NULL AS VARCHAR) AS bairro, cep,
         CAST(NULL AS VARCHAR) AS telefone, CAST(NULL AS VARCHAR) AS email
  FROM raw_o WHERE TRY_CAST(situacao_cadastral AS SMALLINT) = 2),
raw_c AS (
  SELECT lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS cnpj_basico, c_name AS razao_social,
         lpad(CAST(c_nationkey AS VARCHAR), 4, '0') AS natureza_juridica,
         replace(CAST(CAST(c_acctbal AS DECIMAL(15,2)) AS VARCHAR), '.', ',')
           || CASE WHEN c_custkey % 13 = 5 THEN ',00' ELSE '' END AS capital_social,
         CASE WHEN c_custkey % 17 = 3 THEN '07' WHEN c_mktsegment = 'BUILDING' THEN '01'
              WHEN c_mktsegment = 'FURNITURE' THEN '03' WHEN c_mktsegment = 'HOUSEHOLD' THEN '05'
              ELSE 'x' END AS porte
  FROM customer),
comp_typed AS (
  SELECT cnpj_basico, razao_social, natureza_juridica, TRY_CAST(porte AS SMALLINT) AS porte,
         TRY_CAST(regexp_replace(capital_social, '^([^,]*),', '\\1.') AS DECIMAL(15,2)) AS capital_social
  FROM raw_c),
comp_o AS (SELECT * FROM comp_typed c WHERE EXISTS (SELECT 1 FROM est_o e WHERE e.cnpj_basico = c.cnpj_basico)),
cnaes_o AS (SELECT DISTINCT o_orderpriority AS codigo, split_part(o_orderpriority, '-', 2) AS descricao FROM orders),
mun_o AS (SELECT lpad(CAST(n_nationkey AS VARCHAR), 4, '0') AS codigo_municipio, n_name AS nome FROM nation),
cand AS (
  SELECT lpad(CAST(user_id AS VARCHAR), 8, '0') AS cnpj_basico, event_id, ts, event_type, user_id,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events),
first_cand AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cnpj_basico ORDER BY ts, event_id) AS rn FROM cand)
  WHERE rn = 1)"""


def enrichment_sql(cand: str) -> str:
    return f"""SELECT e.cnpj, CAST(c.event_id AS VARCHAR) AS place_id,
         'Rua ' || c.event_type || ', ' || CAST(c.user_id AS VARCHAR) AS endereco_formatado,
         c.event_type AS telefone_places,
         CASE WHEN c.event_type = 'purchase' THEN 'site-' || CAST(c.event_id AS VARCHAR) END AS website,
         CAST(c.k / 10 AS DECIMAL(2,1)) AS rating_google, c.k AS total_avaliacoes
  FROM est_o e JOIN {cand} c ON c.cnpj_basico = e.cnpj_basico
  WHERE c.event_id % 7 <> 3"""


def first_of(half: int) -> str:
    return (f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cnpj_basico ORDER BY ts, event_id) AS rn "
            f"FROM cand WHERE event_id % 2 = {half}) WHERE rn = 1)")


RECENT_O = BASE_O + f""",
enr_o AS ({enrichment_sql('first_cand')}),
top_o AS (
  SELECT cnpj, cnpj_basico, nome_fantasia, data_inicio_atividade, situacao_cadastral, cnae_principal,
         codigo_municipio FROM est_o
  ORDER BY data_inicio_atividade DESC NULLS LAST, cnpj ASC NULLS LAST LIMIT 500),
recent AS (
  SELECT CAST(row_number() OVER (ORDER BY t.data_inicio_atividade DESC NULLS LAST, t.cnpj ASC NULLS LAST) AS INTEGER)
           AS posicao, t.cnpj, t.nome_fantasia, t.data_inicio_atividade, t.situacao_cadastral,
         c.razao_social AS empresa_razao_social, c.porte AS empresa_porte,
         s.descricao AS cnae_descricao, m.nome AS municipio_nome,
         r.endereco_formatado AS enr_endereco, r.telefone_places AS enr_telefone,
         r.website AS enr_website, r.rating_google AS enr_rating
  FROM top_o t LEFT JOIN comp_o c ON c.cnpj_basico = t.cnpj_basico
               LEFT JOIN cnaes_o s ON s.codigo = t.cnae_principal
               LEFT JOIN mun_o m ON m.codigo_municipio = t.codigo_municipio
               LEFT JOIN enr_o r ON r.cnpj = t.cnpj),
display AS (
  SELECT posicao, cnpj, data_inicio_atividade,
         COALESCE(empresa_razao_social, nome_fantasia, '—') AS empresa,
         COALESCE(cnae_descricao, '—') AS setor,
         COALESCE(municipio_nome, '—') AS municipio,
         strftime(data_inicio_atividade, '%d/%m/%Y') AS aberta_em,
         COALESCE(enr_telefone, 'Não enriquecido') AS contato
  FROM recent),
found AS (
  SELECT * FROM display
  WHERE COALESCE(contains(lower(empresa), 'nation_2'), false) OR COALESCE(contains(lower(setor), 'nation_2'), false)
     OR COALESCE(contains(lower(municipio), 'nation_2'), false)
     OR COALESCE(contains(lower(aberta_em), 'nation_2'), false)
     OR COALESCE(contains(lower(contato), 'nation_2'), false))"""

ORACLE["establishments_final"] = f"WITH {BASE_O} SELECT * FROM est_o"

ORACLE["compose_key"] = f"""WITH {RAW_O}
SELECT cnpj_basico, cnpj_ordem, cnpj_dv, cnpj_basico || cnpj_ordem || cnpj_dv AS cnpj FROM raw_o"""

ORACLE["parse_registry_date"] = f"""WITH {RAW_O}
SELECT data_inicio_atividade AS data_raw, CAST(length(data_inicio_atividade) AS INTEGER) AS tamanho,
       {parse_date_sql('data_inicio_atividade')} AS data FROM raw_o"""

ORACLE["parse_capital"] = f"""WITH {BASE_O}
SELECT r.cnpj_basico, r.capital_social AS capital_raw, t.capital_social
FROM raw_c r JOIN comp_typed t ON t.cnpj_basico = r.cnpj_basico"""

ORACLE["companies_semi"] = f"WITH {BASE_O} SELECT * FROM comp_o"

ORACLE["place_first_match"] = f"WITH {BASE_O} {enrichment_sql('first_cand')}"

ORACLE["enrichment_upsert"] = f"""WITH {BASE_O},
ex AS ({enrichment_sql(first_of(0))}),
inc AS ({enrichment_sql(first_of(1))})
SELECT * FROM inc
UNION ALL
SELECT * FROM ex WHERE NOT EXISTS (SELECT 1 FROM inc WHERE inc.cnpj = ex.cnpj)"""

UF_O = "CASE WHEN CAST({}.codigo_municipio AS INTEGER) % 2 = 1 THEN 'SC' ELSE 'RS' END"
ORACLE["reference_upsert"] = f"""WITH {BASE_O},
inc AS (
  SELECT codigo_municipio, nome FROM (
    SELECT lpad(CAST(c_nationkey AS VARCHAR), 4, '0') AS codigo_municipio,
           n_name || ' / ' || c_mktsegment AS nome,
           row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey DESC) AS rn
    FROM customer JOIN nation ON c_nationkey = n_nationkey) WHERE rn = 1)
SELECT i.codigo_municipio, i.nome, {UF_O.format('i')} AS uf FROM inc i
UNION ALL
SELECT codigo, nome, 'RS' FROM (
  SELECT 'N' || lpad(CAST(s_nationkey AS VARCHAR), 4, '0') AS codigo, s_name AS nome,
         row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey DESC) AS rn FROM supplier) WHERE rn = 1
UNION ALL
SELECT m.codigo_municipio, m.nome, {UF_O.format('m')} FROM mun_o m
WHERE NOT EXISTS (SELECT 1 FROM inc WHERE inc.codigo_municipio = m.codigo_municipio)"""

ORACLE["recent_leads"] = f"WITH {RECENT_O} SELECT * FROM recent"

ORACLE["leads_display"] = f"WITH {RECENT_O} SELECT * FROM display"

ORACLE["leads_search"] = f"WITH {RECENT_O} SELECT * FROM found"

ORACLE["leads_search_count"] = f"WITH {RECENT_O} SELECT count(*) AS total FROM found"

ORACLE["leads_sorted"] = f"""WITH {RECENT_O}
SELECT * EXCLUDE (posicao), CAST(row_number() OVER (ORDER BY empresa ASC NULLS LAST, cnpj ASC NULLS LAST) AS INTEGER) AS posicao FROM display"""

ORACLE["leads_export"] = f"""WITH {RECENT_O}
SELECT posicao, cnpj, empresa_razao_social AS razao_social, cnae_descricao AS setor, municipio_nome AS municipio,
       CAST(data_inicio_atividade AS VARCHAR) AS data_abertura, enr_telefone AS telefone,
       concat_ws(';', COALESCE(cnpj, ''), COALESCE(empresa_razao_social, ''), COALESCE(cnae_descricao, ''),
                 COALESCE(municipio_nome, ''), COALESCE(CAST(data_inicio_atividade AS VARCHAR), ''),
                 COALESCE(enr_telefone, '')) AS linha
FROM recent"""

ORACLE["lead_search_text"] = f"""WITH {BASE_O}
SELECT e.cnpj, c.razao_social || ', ' || m.nome || ', RS, Brasil' AS texto_busca
FROM est_o e JOIN comp_o c ON c.cnpj_basico = e.cnpj_basico
             JOIN mun_o m ON m.codigo_municipio = e.codigo_municipio"""

ORACLE["region_codes"] = f"""WITH {BASE_O}
SELECT DISTINCT e.codigo_municipio FROM raw_o e JOIN mun_o m ON m.codigo_municipio = e.codigo_municipio
WHERE {norm_sql('m.nome')} IN {REGION_IN}"""

ORACLE["region_missing"] = f"""WITH {BASE_O},
wl AS (SELECT unnest(['NATION_1', 'NATION_4', 'NATION_9', 'NATION_16', 'NATION_23', 'NATION_40'])
       AS nome_normalizado),
fnd AS (SELECT DISTINCT {norm_sql('m.nome')} AS nome_normalizado
        FROM raw_o e JOIN mun_o m ON m.codigo_municipio = e.codigo_municipio)
SELECT nome_normalizado FROM wl WHERE nome_normalizado NOT IN (SELECT nome_normalizado FROM fnd)"""


def fk_sql(table: str, child: str, fk: str, parent: str, pk: str) -> str:
    return (f"SELECT '{table}' AS tabela, '{fk}' AS coluna, CAST(x.{fk} AS VARCHAR) AS valor, count(*) AS ocorrencias "
            f"FROM {child} x WHERE x.{fk} IS NOT NULL "
            f"AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{pk} = x.{fk}) GROUP BY x.{fk}")


ORACLE["fk_violations"] = f"""WITH {BASE_O}, {STATS_G}, enr_o AS ({enrichment_sql('first_cand')}),
comp_fk AS (SELECT * FROM comp_o WHERE cnpj_basico IN (
  SELECT lpad(CAST(c_custkey AS VARCHAR), 8, '0') FROM customer WHERE c_mktsegment IS DISTINCT FROM 'AUTOMOBILE'))
{fk_sql('empresas', 'comp_fk', 'natureza_juridica', 'mun_o', 'codigo_municipio')}
UNION ALL {fk_sql('estatisticas_crescimento', 'stats', 'cnae_codigo', 'cnaes_g', 'codigo')}
UNION ALL {fk_sql('estatisticas_crescimento', 'stats', 'codigo_municipio', 'mun_g', 'codigo_municipio')}
UNION ALL {fk_sql('estabelecimentos', 'est_o', 'cnpj_basico', 'comp_fk', 'cnpj_basico')}
UNION ALL {fk_sql('estabelecimentos', 'est_o', 'cnae_principal', 'cnaes_o', 'codigo')}
UNION ALL {fk_sql('estabelecimentos', 'est_o', 'codigo_municipio', 'mun_o', 'codigo_municipio')}
UNION ALL {fk_sql('leads_enriquecidos', 'enr_o', 'cnpj', 'est_o', 'cnpj')}"""


def nn_sql(table: str, src: str, col: str) -> str:
    return (f"SELECT '{table}' AS tabela, '{col}' AS coluna, CAST(NULL AS VARCHAR) AS valor, n AS ocorrencias "
            f"FROM (SELECT count(*) FILTER (WHERE {col} IS NULL) AS n FROM {src}) WHERE n > 0")


NN_COLUMNS = {
    "municipios": ("mun_o", ["codigo_municipio", "nome"]), "cnaes": ("cnaes_o", ["codigo", "descricao"]),
    "natureza_juridica": ("nat", ["codigo", "descricao"]), "empresas": ("comp_o", ["cnpj_basico", "razao_social"]),
    "estabelecimentos": ("est_o", ["cnpj", "cnpj_basico", "situacao_cadastral", "data_inicio_atividade", "codigo_municipio"]),
    "estatisticas_crescimento": ("stats", ["cnae_codigo", "codigo_municipio", "ano_mes", "total_aberturas"]),
    "leads_enriquecidos": ("enr_o", ["cnpj"]),
    "insights_ia": ("log", ["id", "titulo", "conteudo", "baseado_em", "modelo", "gerado_em"])}


def dom_sql(table: str, src: str, col: str, bad: str) -> str:
    return (f"SELECT '{table}' AS tabela, '{col}' AS coluna, CAST({col} AS VARCHAR) AS valor, count(*) AS ocorrencias "
            f"FROM {src} WHERE {bad} GROUP BY CAST({col} AS VARCHAR)")


BAD_CAPITAL = ("capital_social IS NOT NULL AND "
               "TRY_CAST(regexp_replace(capital_social, '^([^,]*),', '\\1.') AS DECIMAL(15,2)) IS NULL")
ORACLE["domain_violations"] = f"""WITH {BASE_O},
typed AS (SELECT TRY_CAST(situacao_cadastral AS SMALLINT) AS situacao_cadastral FROM raw_o)
{dom_sql('estabelecimentos', 'est_o', 'cnpj', 'length(cnpj) > 14')}
UNION ALL {dom_sql('estabelecimentos', 'est_o', 'cep', 'length(cep) > 8')}
UNION ALL {dom_sql('estabelecimentos', 'est_o', 'cnae_principal', 'length(cnae_principal) > 7')}
UNION ALL {dom_sql('estabelecimentos', 'est_o', 'codigo_municipio', 'length(codigo_municipio) > 7')}
UNION ALL {dom_sql('estabelecimentos', 'typed', 'situacao_cadastral',
                   'situacao_cadastral IS NOT NULL AND situacao_cadastral NOT IN (1, 2, 3, 4, 8)')}
UNION ALL {dom_sql('empresas', 'comp_o', 'natureza_juridica', 'length(natureza_juridica) > 4')}
UNION ALL {dom_sql('empresas', 'comp_o', 'porte', 'porte IS NOT NULL AND porte NOT IN (1, 3, 5)')}
UNION ALL {dom_sql('empresas', 'comp_o', 'capital_social',
                   'capital_social IS NOT NULL AND TRY_CAST(capital_social AS DECIMAL(15,2)) IS NULL')}
UNION ALL {dom_sql('empresas_brutas', 'raw_c', 'capital_social', BAD_CAPITAL)}"""



def pk_sql(table: str, src: str, *key: str) -> str:
    text = "concat_ws('|', " + ", ".join(f"CAST({k} AS VARCHAR)" for k in key) + ")"
    return (f"SELECT '{table}' AS tabela, '{','.join(key)}' AS coluna, {text} AS valor, count(*) AS ocorrencias "
            f"FROM {src} GROUP BY {', '.join(key)} HAVING count(*) > 1")


ORACLE["pk_violations"] = f"""WITH {BASE_O}, {STATS_G}, enr_o AS ({enrichment_sql('first_cand')}),
nat AS (SELECT c_nationkey AS codigo FROM customer), log AS (SELECT event_id AS id FROM events)
{pk_sql('estabelecimentos', 'est_g', 'cnpj')}
UNION ALL {pk_sql('estatisticas_crescimento', 'stats', 'cnae_codigo', 'codigo_municipio', 'ano_mes')}
UNION ALL {pk_sql('municipios', 'mun_g', 'codigo_municipio')}
UNION ALL {pk_sql('cnaes', 'cnaes_o', 'codigo')}
UNION ALL {pk_sql('natureza_juridica', 'nat', 'codigo')}
UNION ALL {pk_sql('empresas', 'raw_c', 'cnpj_basico')}
UNION ALL {pk_sql('leads_enriquecidos', 'enr_o', 'cnpj')}
UNION ALL {pk_sql('insights_ia', 'log', 'id')}"""

INSIGHT_LOG = """SELECT event_id AS id, event_type AS titulo, props AS conteudo, props AS baseado_em,
       event_type AS modelo, ts AS gerado_em FROM events"""

ORACLE["insight_log_append"] = INSIGHT_LOG

ORACLE["latest_insight"] = """SELECT event_id AS id, event_type AS titulo, ts AS gerado_em FROM events
ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST LIMIT 1"""

# --------------------------------------------------------------- documents (D)
ORACLE["normalize_name"] = f"SELECT doc_id, {norm_sql('text')} AS nome_normalizado FROM documents"
ORACLE["normalize_name_udf"] = ORACLE["normalize_name"]
ORACLE["truncate_label"] = (f"SELECT doc_id, {trunc_sql('text', 26)} AS rotulo_26, "
                            f"{trunc_sql('text', 22)} AS rotulo_22 FROM documents")
ORACLE["scan_delimited"] = "SELECT doc_id, text, lang, source, n_chars FROM documents"
ORACLE["scan_zip"] = ORACLE["scan_delimited"]

ORACLE["not_null_violations"] = f"""WITH {BASE_O}, {STATS_G}, enr_o AS ({enrichment_sql('first_cand')}),
nat AS (SELECT c_nationkey AS codigo, CASE WHEN c_nationkey % 6 <> 2 THEN c_mktsegment END AS descricao FROM customer),
log AS (SELECT event_id AS id, event_type AS titulo, props AS conteudo, props AS baseado_em,
               CASE WHEN event_id % 50 <> 3 THEN event_type END AS modelo, ts AS gerado_em FROM events)
{' UNION ALL '.join(nn_sql(name, src, c) for name, (src, cols) in NN_COLUMNS.items() for c in cols)}"""

# ------------------------------------------------------------ raw text by ranges
ORACLE["scan_ranges"] = ORACLE["scan_delimited"]

RAW_G = """raw_g AS (
  SELECT l_orderkey % 4 AS shard,
         row_number() OVER (PARTITION BY l_orderkey % 4 ORDER BY l_orderkey, l_linenumber, l_suppkey, l_shipdate) - 1 AS linha,
         CAST(l_orderkey AS VARCHAR) || CASE WHEN l_orderkey % 9 = 0 THEN chr(10) || ';' ELSE '-' END
             || CAST(l_linenumber AS VARCHAR) AS cnpj,
         CAST(l_suppkey AS VARCHAR) AS cnpj_basico, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS data
  FROM lineitem)"""

ORACLE["record_numbers"] = f"WITH {RAW_G} SELECT shard, linha, cnpj, cnpj_basico, data FROM raw_g"

ORACLE["text_keep_first"] = f"""WITH {RAW_G}
SELECT cnpj_basico, shard, cnpj, data FROM raw_g
QUALIFY row_number() OVER (PARTITION BY cnpj_basico ORDER BY shard, linha) = 1"""

REJECTED = """kinds AS (
  SELECT o_orderkey % 4 AS shard, CASE o_orderkey % 97 WHEN 1 THEN 'curto' WHEN 2 THEN 'longo' WHEN 3 THEN 'solto' ELSE '' END AS kind,
         '"' || CAST(o_orderkey AS VARCHAR) || '";"PEDIDO ' || CAST(o_orderkey AS VARCHAR)
             || CASE WHEN o_orderkey % 3 = 0 THEN chr(10) || 'sala; ""x""' ELSE '' END || '"' AS head,
         strftime(o_orderdate, '%Y%m%d') AS ymd, o_orderkey
  FROM orders)"""

ORACLE["rejected_counts"] = f"""WITH {REJECTED}
SELECT shard, count(*) AS lidos, count(*) FILTER (WHERE kind = '') AS aceitos,
       count(*) FILTER (WHERE kind IN ('curto', 'solto')) AS curtos, count(*) FILTER (WHERE kind = 'longo') AS longos,
       CAST(0 AS BIGINT) AS ilegiveis
FROM kinds GROUP BY ROLLUP (shard)"""

ORACLE["rejected_records"] = f"""WITH {REJECTED}
SELECT shard, CASE kind WHEN 'longo' THEN 'campos a mais' ELSE 'campos a menos' END AS motivo,
       CASE kind WHEN 'curto' THEN head WHEN 'longo' THEN head || ';"' || ymd || '";"sobra"'
                 ELSE '### ' || CAST(o_orderkey AS VARCHAR) END AS texto
FROM kinds WHERE kind <> ''"""

# ------------------------------------------------------- order, clocks, batches
ORACLE["leads_positions"] = f"""WITH {BASE_O}
SELECT cnpj, cnpj_basico, nome_fantasia, data_inicio_atividade, posicao, (posicao - 1) // 500 + 1 AS pagina
FROM (SELECT *, row_number() OVER (ORDER BY data_inicio_atividade DESC NULLS LAST, cnpj NULLS LAST, cnpj_basico NULLS LAST,
                                   nome_fantasia NULLS LAST) AS posicao FROM est_o)"""

ORACLE["growth_incremental"] = ORACLE["growth_stats"]

ORACLE["upsert_clock"] = f"""WITH {BASE_O},
ex AS (SELECT * FROM ({enrichment_sql(first_of(0))}) WHERE cnpj IS NOT NULL),
inc AS (SELECT * FROM ({enrichment_sql(first_of(1))}) WHERE cnpj IS NOT NULL)
SELECT 'K8' AS operador, count(*) FILTER (WHERE cnpj IN (SELECT cnpj FROM inc)) AS movidos,
       count(*) FILTER (WHERE cnpj NOT IN (SELECT cnpj FROM inc)) AS parados FROM ex
UNION ALL SELECT 'K7', 0, (SELECT count(*) FROM (SELECT cnpj FROM ex UNION SELECT cnpj FROM inc))"""

ORACLE["export_named"] = """SELECT 'leads_' || CAST((SELECT CAST(max(o_orderdate) AS DATE) FROM orders) AS VARCHAR) AS nome,
       count(*) AS linhas FROM customer"""

DISPLAY_ALL = BASE_O + f""",
enr_o AS ({enrichment_sql('first_cand')}),
display_all AS (
  SELECT t.cnpj, t.data_inicio_atividade, COALESCE(c.razao_social, t.nome_fantasia, '—') AS empresa,
         COALESCE(s.descricao, '—') AS setor, COALESCE(m.nome, '—') AS municipio,
         strftime(t.data_inicio_atividade, '%d/%m/%Y') AS aberta_em, COALESCE(r.telefone_places, 'Não enriquecido') AS contato
  FROM est_o t LEFT JOIN comp_o c ON c.cnpj_basico = t.cnpj_basico
               LEFT JOIN cnaes_o s ON s.codigo = t.cnae_principal
               LEFT JOIN mun_o m ON m.codigo_municipio = t.codigo_municipio
               LEFT JOIN enr_o r ON r.cnpj = t.cnpj)"""

ORACLE["leads_search_all"] = f"""WITH {DISPLAY_ALL}
SELECT * FROM display_all
WHERE contains(lower(empresa || chr(1) || setor || chr(1) || municipio || chr(1) || COALESCE(aberta_em, '') || chr(1) || contato),
               '#00000012')"""
