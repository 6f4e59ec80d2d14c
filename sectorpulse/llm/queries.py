"""Queries of this subpackage on the given tables: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (ann_rpforest, chat_format, conversation_repair, conversation_trie, decontam_index, dedup_cpsjoin,
               html_mincut, license_tfidf, mix_pivotal, pack_cutting_stock, quality_pu, shard_rendezvous, topk_columnar)
from .common import prepare, read_table, staged

SHARDS = 16
LAW = "key"


def vocabulary() -> str:
    """Place of the word vocabulary file (a public tokenizer, not part of the repository)."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality_pu.score_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return scored.select("doc_id", quality_pu.held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= quality_pu.THRESHOLD).cast("int").alias("predicted"))


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    probe = spark.sql("""SELECT CAST(-7 AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, role,
                                '</s>[INST] ok [/INST]' AS text
                         FROM VALUES (0, 'user'), (1, 'assistant') AS t(turn, role)""")
    out = chat_format.format_conversations(rows.unionByName(probe))
    turns = chat_format.read_turns(F.col("formatted"))
    lines = F.transform("__turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return (out.withColumns({"__turns": turns, "__loss": chat_format.loss_text(F.col("segments"))})
               .select("conv_id", F.size("__turns").cast("long").alias("n_turns"),
                       F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
                       F.length("__loss").cast("long").alias("loss_chars"),
                       F.sha2("__loss", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars")))


def op3_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mix_pivotal.plan_mix(read_table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op4_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    return html_mincut.extract(pages, ["page_id", "url"]).withColumn("n_chars", F.length("text").cast("long"))


def op5_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_cutting_stock.pack(read_table(spark, sf_dir, "documents"), vocabulary()).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("long").alias("id"), F.col("embedding").cast("array<double>").alias("vector"))


def op6_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _vectors(spark, sf_dir).where(ann_rpforest.searchable(F.col("vector")) & F.col("id").isNotNull())
    found = ann_rpforest.nearest(rows.where("id % 100 = 0"), rows, 10)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op7_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files: the path is source/lang/doc_id; in a source and language, a document that is
    nothing but a license notice stands for its directory's license file."""
    docs = read_table(spark, sf_dir, "documents")
    name = F.concat(F.lit("doc-"), F.col("doc_id").cast("string"))
    files = docs.select("doc_id", F.concat_ws("/", F.coalesce("source", F.lit("unknown")),
                                              F.coalesce("lang", F.lit("unknown")),
                                              F.coalesce(name, F.lit("doc-"))).alias("path"), "text")
    return license_tfidf.scan(files, "doc_id", "path", "text", by_content=True)


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_cpsjoin.near_duplicates(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id", "kept")


def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _vectors(spark, sf_dir).where(topk_columnar.usable(F.col("vector")) & F.col("id").isNotNull())
    rows = rows.withColumn("vector", topk_columnar.integral(F.col("vector")))
    found = topk_columnar.top_k(rows.where("id % 20 = 0"), rows, 20)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op10_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    docs = read_table(spark, sf_dir, "documents").select(
        "doc_id", (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"))
    placed = shard_rendezvous.assign_shards(docs, "doc_id", [1.0] * SHARDS)
    placed = shard_rendezvous.assign_shards(placed, "doc_id", [1.0] * (SHARDS + 1), "grown_shard")
    slotted = shard_rendezvous.with_slots(staged(placed, "shards"), "shard", ["doc_id", "text_crc32", "size"])
    return slotted.select("doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot", "grown_shard")


def op11_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.conversation_trie(read_table(spark, sf_dir, "conversations"))


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return conversation_repair.repair(conversation_repair.faults(conversation_repair.damaged(rows)), rows)


def op13_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam_index.decontaminate(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


QUERIES = {
    "op1_quality": op1_quality, "op2_chat_format": op2_chat_format, "op3_mix": op3_mix, "op4_html": op4_html,
    "op5_pack": op5_pack, "op6_ann": op6_ann, "op7_license": op7_license, "op8_near_dedup": op8_near_dedup,
    "op9_top_k": op9_top_k, "op10_shard": op10_shard, "op11_trie": op11_trie,
    "op12_repair": op12_repair, "op13_decontaminate": op13_decontaminate}

CONTROL = r"<\\*(\|\w*\|>|/?s>|</?SYS>>)|\[\\*/?INST\]"


def crc32_sql(text: str) -> str:
    """CRC-32 of an ASCII text in SQL, bit by bit."""
    return f"""xor(list_reduce(
        list_prepend(4294967295::UBIGINT, list_transform(range(1, length({text}) + 1),
                                                         lambda i: ascii(substr({text}, i, 1))::UBIGINT)),
        lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)::UBIGINT[]),
                                 lambda x, y: xor(x >> 1, (x & 1) * 3988292384::UBIGINT))), 4294967295::UBIGINT)"""


ORACLE: dict[str, str] = {
    # Each turn adds its text and escapes; each run of one role a header and an end mark.
    "op2_chat_format": rf"""
        WITH rows AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
        marked AS (
            SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before,
                   length(text) + len(regexp_extract_all(text, '{CONTROL}')) AS shown,
                   length(role) + len(regexp_extract_all(role, '{CONTROL}')) AS shown_role FROM rows)
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), ''))
                   AS loss_sha256,
               CAST(sum(shown + CASE WHEN before IS NOT DISTINCT FROM role THEN 11
                                     ELSE 12 + shown_role + 10 + 11 END) AS BIGINT) AS formatted_chars
        FROM marked GROUP BY conv_id""",
    "op8_near_dedup": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x20\x09-\x0D]+') AS w FROM documents),
        sets AS (
            SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_distinct(
                list_transform(range(1, len(w) - 3), lambda i: array_to_string(list_slice(w, i, i + 4), ' '))) END AS s
            FROM words),
        single AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
        links AS (
            SELECT a.doc_id AS x, b.doc_id AS y FROM single a JOIN single b USING (shingle) WHERE a.doc_id <> b.doc_id
            GROUP BY 1, 2, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
        reach AS (SELECT doc_id, doc_id AS root FROM sets
                  UNION SELECT y, root FROM reach JOIN links ON x = doc_id)
        SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, min(root) AS component_id, doc_id = min(root) AS kept
        FROM sets JOIN reach USING (doc_id) GROUP BY doc_id, s""",
    "op9_top_k": """
        WITH good AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM good q JOIN good c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v))
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
               vec_id, score
        FROM scored QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 20""",
    # Prefixes as lists of turn digests; a subtree's sums by joining each node to its own prefixes.
    "op11_trie": f"""
        WITH rows AS (
            SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
                                      coalesce(text, '')) AS place
            FROM conversations WHERE conv_id IS NOT NULL),
        ids AS (SELECT c, {crc32_sql("CAST(c AS VARCHAR)")} % 9 AS h FROM (SELECT DISTINCT conv_id AS c FROM rows)),
        made AS (
            SELECT c, place, role, text FROM ids JOIN rows ON conv_id = c - c % 5 AND place <= h
            UNION ALL SELECT c, place + 9, role, text FROM ids JOIN rows ON conv_id = c AND place > h),
        paths AS (
            SELECT c, coalesce(list(sha256(length(role) || ':' || role || text) ORDER BY place)
                               FILTER (WHERE place IS NOT NULL), []) AS t,
                   list(octet_length(encode(text)) ORDER BY place) AS b
            FROM ids LEFT JOIN made USING (c) GROUP BY c),
        prefixes AS (
            SELECT c, d, list_slice(t, 1, d) AS p, t, CASE WHEN d = 0 THEN 0 ELSE b[d] END AS bytes
            FROM paths, unnest(range(len(t) + 1)) AS u(d)),
        nodes AS (
            SELECT p, any_value(d) AS depth, min(c) AS conv_id, count(*) AS n_convs, count(DISTINCT t[d + 1]) AS n_children,
                   (count(*) - 1) * any_value(bytes) AS saved,
                   sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE len(t) = d), ''))
                       AS ends_sha256
            FROM prefixes GROUP BY p),
        sums AS (
            SELECT list_slice(p, 1, k) AS p, count(*) FILTER (WHERE n_children = 0) AS n_leaves,
                   CAST(sum(saved) AS BIGINT) AS saved_tokens
            FROM nodes, unnest(range(depth + 1)) AS u(k) GROUP BY 1)
        SELECT n.conv_id, n.depth, u.conv_id AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves, s.saved_tokens,
               n.ends_sha256
        FROM nodes n JOIN sums s USING (p) LEFT JOIN nodes u ON n.depth > 0 AND u.p = list_slice(n.p, 1, n.depth - 1)""",
    # One row after the other for all conversations, the least (cost, audit) of each state kept.
    "op12_repair": rf"""
        WITH RECURSIVE hurt AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   {crc32_sql("(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))")} % 20
                       AS kind
            FROM conversations),
        rows AS (
            SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, copy,
                   CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
            FROM hurt, (VALUES (0), (1)) AS t(copy) WHERE kind <> 0 AND (copy = 0 OR kind = 3)),
        placed AS (
            SELECT *, row_number() OVER w AS i, left(role, 1) AS x, lag(left(role, 1)) OVER w AS x_before,
                   regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS bare,
                   row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen
            FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)),
        faulty AS (
            SELECT *, CASE WHEN bare = '' THEN 'blank' WHEN seen > 1 THEN 'duplicate'
                           WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM placed),
        told AS (
            SELECT o.conv_id, count(i) AS n,
                   CAST(coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS BIGINT) AS gaps,
                   count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
                   count(*) FILTER (WHERE fault = 'truncated') AS truncated,
                   count(*) FILTER (WHERE x_before || x NOT IN ('su', 'ua', 'au')) AS illegal
            FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM o.conv_id
            GROUP BY o.conv_id),
        gap(q0, q1, spent, letters, lines) AS (VALUES
            ('', '', 0, '', ''), ('s', 's', 0, '', ''), ('u', 'u', 0, '', ''), ('a', 'a', 0, '', ''),
            ('', 'u', 3, 'I', chr(10) || 'user:'), ('s', 'u', 3, 'I', chr(10) || 'user:'),
            ('a', 'u', 3, 'I', chr(10) || 'user:'), ('u', 'a', 3, 'I', chr(10) || 'assistant:'),
            ('', 'a', 6, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'),
            ('s', 'a', 6, 'II', chr(10) || 'user:' || chr(10) || 'assistant:')),
        edit(letter, q1, q2, spent) AS (VALUES
            ('D', '', '', 4), ('D', 's', 's', 4), ('D', 'u', 'u', 4), ('D', 'a', 'a', 4),
            ('R', '', 'u', 3), ('R', 's', 'u', 3), ('R', 'u', 'a', 3), ('R', 'a', 'u', 3),
            ('K', '', 's', 0), ('K', '', 'u', 0), ('K', 's', 'u', 0), ('K', 'u', 'a', 0), ('K', 'a', 'u', 0)),
        walk AS (
            SELECT conv_id, CAST(0 AS BIGINT) AS i, '' AS q, {{'cost': 0, 'audit': '', 'lines': ''}} AS best FROM told
            UNION ALL
            SELECT w.conv_id, w.i + 1, e.q2, min({{
                'cost': w.best.cost + g.spent + e.spent + CASE WHEN e.letter <> 'D' AND f.fault = 'truncated' THEN 3 ELSE 0 END,
                'audit': w.best.audit || g.letters || e.letter,
                'lines': w.best.lines || g.lines || CASE e.letter WHEN 'D' THEN '' WHEN 'K' THEN
                    chr(10) || f.role || ':' || f.text ELSE
                    chr(10) || CASE e.q2 WHEN 'u' THEN 'user' ELSE 'assistant' END || ':' || f.text END}})
            FROM walk w JOIN gap g ON g.q0 = w.q JOIN edit e ON e.q1 = g.q1
                 JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1
                 AND (e.letter = 'D' OR f.fault NOT IN ('blank', 'duplicate') AND (e.letter = 'R' OR f.x = e.q2))
            GROUP BY w.conv_id, w.i, e.q2),
        ended AS (
            SELECT w.conv_id, min({{'cost': w.best.cost + g.spent, 'audit': w.best.audit || g.letters,
                                   'lines': w.best.lines || g.lines}}) AS best
            FROM walk w JOIN told t ON t.conv_id IS NOT DISTINCT FROM w.conv_id AND t.n = w.i
                 JOIN gap g ON g.q0 = w.q AND g.q1 IN ('', 'a')
            GROUP BY w.conv_id)
        SELECT t.conv_id, gaps, blank, duplicate, truncated, illegal, CAST(best.cost AS BIGINT) AS cost, best.audit AS audit,
               sha256(substr(best.lines, 2)) AS repaired_sha256
        FROM told t JOIN ended e ON e.conv_id IS NOT DISTINCT FROM t.conv_id""",
    # Windows as texts of their words, found at every place of every document.
    "op13_decontaminate": r"""
        WITH words AS (
            SELECT row_number() OVER () AS r, doc_id,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        items AS (
            SELECT CAST(item_id AS VARCHAR) AS item,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
        windows AS (
            SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(list_slice(w, s, s + least(len(w), 10) - 1), ' ') AS t
            FROM items, unnest(range(1, greatest(len(w) - 9, least(len(w), 1)) + 1)) AS u(s)),
        found AS (
            SELECT r, s, n, item
            FROM (SELECT r, s, n, array_to_string(list_slice(w, s, s + n - 1), ' ') AS t
                  FROM words, (SELECT DISTINCT n FROM windows) AS k, unnest(range(1, len(w) - n + 2)) AS u(s)) AS placed
                 JOIN windows USING (n, t)),
        hits AS (SELECT r, count(DISTINCT pos) AS n_hit
                 FROM (SELECT r, unnest(range(s, s + n)) AS pos FROM found) GROUP BY r),
        named AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
                  FROM (SELECT DISTINCT r, item FROM found) GROUP BY r)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM words LEFT JOIN hits USING (r) LEFT JOIN named USING (r)""",
}
