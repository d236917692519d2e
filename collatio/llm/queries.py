"""Queries over the driver's tables that show the operators of this subpackage, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from collatio.llm import chat_format, decontaminate, exact_dedup, fill_middle, filter_audit, html_extract, langid, license_scan, line_dedup, near_dedup, packing, quality, sentence_pieces
from collatio.llm.shared import held_out, load


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(load(spark, sf_dir, "pages"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, load(spark, sf_dir, "labels")))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(load(spark, sf_dir, "documents"), ngram=2)


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(load(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    found = langid.identify(docs.select("doc_id", "text"), langid.train(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "ambiguous")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.drop_repeated_lines(load(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_removed", "text")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(load(spark, sf_dir, "documents"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark")).drop("hits")


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(chat_format.probe(spark))
    return chat_format.digests(chat_format.format_turn_rows(rows))


def chat_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of `conversations` as records of eight layouts, with ids beside them, as parts and as empty lists, read as canonical turns."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    kind = F.pmod(F.col("conv_id") + F.col("turn"), F.lit(8))
    one = F.array(F.struct(role.alias("role"), text.alias("content"), F.col("turn").alias("weight")))
    parts = F.array(F.struct(role.alias("role"), F.array(F.struct(F.lit("text").alias("type"), text.alias("text")), F.struct(F.lit("image").alias("type"), F.lit("").alias("text"))).alias("content")))
    shapes = (
        F.struct(role.alias("role"), text.alias("text"), F.col("conv_id").alias("id")),
        F.struct(one.alias("messages"), F.col("conv_id").alias("id")),
        F.struct(parts.alias("messages")),
        F.struct(F.array(F.struct(role.alias("from"), text.alias("value"))).alias("conversations"), F.lit("s").alias("system")),
        F.struct(text.alias("prompt"), role.alias("completion"), F.lit(1).alias("n")),
        F.struct(text.alias("instruction"), role.alias("input"), F.lit("o").alias("output")),
        F.struct(F.slice(one, 1, 0).alias("messages")),
        F.struct(text.alias("body"), role.alias("by")),
    )
    made = None
    for i, shape in enumerate(shapes):
        made = F.when(kind == i, F.to_variant_object(shape)) if made is None else made.when(kind == i, F.to_variant_object(shape))
    rows = load(spark, sf_dir, "conversations").select("conv_id", "turn", made.alias("record"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return chat_format.canonical_turns(rows, "record").select("conv_id", "turn", "layout", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"))


def op9_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(load(spark, sf_dir, "documents"), tokenizer_path())


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_middle.transform(load(spark, sf_dir, "documents"))
    hashes = F.sha2("output", 256).alias("output_sha256"), F.sha2(fill_middle.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256")
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *hashes)


def piece_model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = piece_model_path()
    read = sentence_pieces.decode(sentence_pieces.encode(load(spark, sf_dir, "documents"), model), model)
    ids = F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256)
    return read.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), ids.alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_html_extract, op2_exact_dedup, op3_quality, op4_near_dedup, op5_license_scan, op6_language_id, op7_decontaminate, op8_chat_format, op9_pack, op10_line_dedup, op11_filter_audit, op12_fill_middle, op13_sentencepiece, chat_layouts)
    return {f.__name__: f for f in found}


OP2_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC) = 1 AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

OP7_SQL = r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), 13) AS n, w[i:i + least(len(w), 13) - 1] AS g
        FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM iw WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
dg AS (SELECT doc_id, n, i, w[i:i + n - 1] AS g FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, sizes WHERE len(w) >= n)),
hit AS (SELECT doc_id, dg.n, i, item_id FROM dg JOIN win ON dg.n = win.n AND dg.g = win.g),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, n, i FROM hit)) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""

OP8_SQL = """
WITH c AS (SELECT conv_id, coalesce(turn, -4611686018427387904) AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
w AS (SELECT *, length(replace(replace(replace(role || text, '&', '&amp;'), '<', '&lt;'), '[', '&#91;')) + 16 AS chars FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM w GROUP BY conv_id
"""

CHAT_LAYOUTS_SQL = """
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, ((conv_id + turn) % 8 + 8) % 8 AS kind FROM conversations),
n AS (SELECT *, CASE WHEN role IN ('human', 'prompter') THEN 'user' WHEN role IN ('gpt', 'bot', 'model', 'ai') THEN 'assistant' ELSE role END AS named FROM c)
SELECT conv_id, turn, ['turn', 'messages', 'messages', 'system_conversations', 'prompt', 'instruction_input', 'messages', NULL][kind + 1] AS layout,
       CAST(CASE WHEN kind IN (0, 1, 2) THEN 1 WHEN kind IN (3, 4, 5) THEN 2 WHEN kind = 6 THEN 0 END AS BIGINT) AS n_turns,
       CASE WHEN kind IN (0, 1, 2) THEN sha256(named || chr(10) || text || chr(10))
            WHEN kind = 3 THEN sha256('system' || chr(10) || 's' || chr(10) || named || chr(10) || text || chr(10))
            WHEN kind = 4 THEN sha256('user' || chr(10) || text || chr(10) || 'assistant' || chr(10) || role || chr(10))
            WHEN kind = 5 THEN sha256('user' || chr(10) || text || CASE WHEN text <> '' AND role <> '' THEN chr(10) || chr(10) ELSE '' END || role || chr(10) || 'assistant' || chr(10) || 'o' || chr(10))
            WHEN kind = 6 THEN sha256('') END AS turns_sha256
FROM n
"""

OP11_SQL = r"""
WITH docs AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
lab AS (SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic FROM labels GROUP BY doc_id),
marks AS (SELECT part, coalesce(good, false) AS good, coalesce(lab.toxic, false) AS toxic,
                 map {'A': len(w) < 100, 'B': 100 * len(list_distinct(w)) < 80 * len(w), 'C': 100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 10 * length(t),
                      'D': regexp_matches(t, '[#$%&*|]'), 'E': coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)} AS fails
          FROM docs LEFT JOIN lab USING (doc_id)),
bins AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM marks GROUP BY part, fails),
l(f) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders AS (SELECT a.f || b.f || c.f || d.f || e.f AS o FROM l a, l b, l c, l d, l e WHERE a.f NOT IN (b.f, c.f, d.f, e.f) AND b.f NOT IN (c.f, d.f, e.f) AND c.f NOT IN (d.f, e.f) AND d.f <> e.f),
steps AS (SELECT o, s, o[s] AS f, list_transform(range(1, s), lambda i: o[i]) AS earlier, list_filter(['A', 'B', 'C', 'D', 'E'], lambda x: x <> o[s]) AS others FROM orders, range(1, 6) AS r(s)),
met AS (SELECT part, o, s, f, n, good, toxic, fails[f] AS own, len(list_filter(earlier, lambda x: fails[x])) > 0 AS before, len(list_filter(others, lambda x: fails[x])) > 0 AS other FROM bins, steps),
found AS (SELECT part, o AS filter_order, s AS step, any_value(f) AS f, sum(CASE WHEN NOT own AND NOT before THEN n ELSE 0 END) AS kept, sum(CASE WHEN own AND NOT before THEN n ELSE 0 END) AS removed,
                 sum(CASE WHEN own AND before THEN n ELSE 0 END) AS redundant, sum(CASE WHEN own AND NOT other THEN n ELSE 0 END) AS unique_fails,
                 sum(CASE WHEN own AND NOT before THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN own AND NOT before THEN toxic ELSE 0 END) AS toxic_lost FROM met GROUP BY part, o, s)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM found
"""

OP12_SQL = """
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
nums AS (SELECT *, CAST('0x' || h[1:8] AS BIGINT) % (n + 1) AS c1, CAST('0x' || h[9:16] AS BIGINT) % (n + 1) AS c2, CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM docs),
cut AS (SELECT *, least(c1, c2) AS a, greatest(c1, c2) AS b,
               CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM nums),
parts AS (SELECT *, substring(t, 1, a) AS p, substring(t, a + 1, b - a) AS m, substring(t, b + 1) AS s FROM cut)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(a AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(b - a AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256
FROM parts
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_exact_dedup": OP2_SQL, "op7_decontaminate": OP7_SQL, "op8_chat_format": OP8_SQL, "chat_layouts": CHAT_LAYOUTS_SQL, "op11_filter_audit": OP11_SQL, "op12_fill_middle": OP12_SQL}
