"""Registered queries of the training-data operators, and the SQL they must equal."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skylag.llm import (
    conversations, decontaminate, exact_dedup, extract, filter_audit, language, line_dedup, neighbours, ngram_lm, packing, phrase_dedup, simhash,
    suffix_dedup)

QUERIES = {}
ORACLES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


@query
def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), capacity=4096)


@query
def op3_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op4_phrase_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = phrase_dedup.dedup_phrases(table(spark, sf_dir, "documents"), window=35)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@query
def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = ngram_lm.score(table(spark, sf_dir, "documents"), ~ngram_lm.held_out())
    return scored.withColumn("held_out", F.coalesce(ngram_lm.held_out(), F.lit(False))).drop("learned")


@query
def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = suffix_dedup.dedup_bytes(table(spark, sf_dir, "documents"), window=200)
    return kept.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query
def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


@query
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(table(spark, sf_dir, "documents"), min_docs=5, min_chars=40)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predict(table(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score")


@query
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repaired(table(spark, sf_dir, "conversations"))


@query
def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


@query
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLES["op8_line_dedup"] = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS i FROM documents),
keyed AS (
  SELECT doc_id, i, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
counted AS (
  SELECT k, max(doc_id) AS keep FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT keyed.doc_id, i, line, counted.k IS NOT NULL AND keyed.doc_id <> keep AS gone
  FROM keyed LEFT JOIN counted ON keyed.k = counted.k)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(CASE WHEN NOT gone THEN line END, chr(10) ORDER BY i), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

ORACLES["op11_conversation_repair"] = """
WITH RECURSIVE raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
hashed AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295, [CAST(ascii(x) AS BIGINT) FOR x IN string_split(k, '')]),
    lambda c, b: list_reduce(list_prepend(xor(c, b), [CAST(0 AS BIGINT) FOR z IN range(8)]),
      lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)), 4294967295) % 20 AS fault FROM raw),
damaged AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
         CASE fault WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(range(CASE fault WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM hashed),
placed AS (
  SELECT *, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS shown,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i FROM damaged),
marked AS (
  SELECT conv_id, turn, role, text, i, shown = '' AS blank,
         shown <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS duplicate,
         right(shown, 1) NOT IN ('.', '!', '?') AS stopless,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair FROM placed),
summed AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
         count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (NOT blank AND NOT duplicate AND stopless) AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n FROM marked GROUP BY conv_id),
moves(place, initial, then_place) AS (VALUES (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
inserts AS (
  SELECT place AS a, place AS b, 0 AS cost, '' AS audit, '' AS said FROM moves
  UNION ALL SELECT place, then_place, 5, 'I', CASE initial WHEN 'u' THEN 'user:' ELSE 'assistant:' END || chr(10) FROM moves
  UNION ALL SELECT m.place, o.then_place, 10, 'II', CASE m.initial WHEN 'u' THEN 'user:' || chr(10) || 'assistant:' ELSE 'assistant:' || chr(10) || 'user:' END || chr(10)
  FROM moves m JOIN moves o ON m.then_place = o.place),
edits AS (
  SELECT conv_id, i, 0 AS a, 0 AS b, 2 AS cost, 'D' AS audit, '' AS said FROM marked
  UNION ALL SELECT conv_id, i, place, place, 2, 'D', '' FROM marked, moves WHERE place > 0
  UNION ALL SELECT conv_id, i, place, then_place, CASE WHEN stopless THEN 5 ELSE 0 END, 'K', role || ':' || text || chr(10)
  FROM marked, moves WHERE NOT blank AND NOT duplicate AND left(role, 1) = initial
  UNION ALL SELECT conv_id, i, 0, 1, CASE WHEN stopless THEN 5 ELSE 0 END, 'K', role || ':' || text || chr(10)
  FROM marked WHERE NOT blank AND NOT duplicate AND left(role, 1) = 's'
  UNION ALL SELECT conv_id, i, place, then_place, CASE WHEN stopless THEN 6 ELSE 1 END, 'R',
         CASE initial WHEN 'u' THEN 'user:' ELSE 'assistant:' END || text || chr(10)
  FROM marked, moves WHERE NOT blank AND NOT duplicate),
paths AS (
  SELECT DISTINCT conv_id, 0 AS i, 0 AS place, 0 AS cost, '' AS audit, '' AS said FROM marked
  UNION ALL
  SELECT conv_id, i, place, b.cost, b.audit, b.said FROM (
    SELECT p.conv_id, e.i, e.b AS place, min(struct_pack(cost := p.cost + x.cost + e.cost, audit := p.audit || x.audit || e.audit,
                                                         said := p.said || x.said || e.said)) AS b
    FROM paths p JOIN inserts x ON x.a = p.place JOIN edits e ON e.conv_id IS NOT DISTINCT FROM p.conv_id AND e.i = p.i + 1 AND e.a = x.b
    GROUP BY p.conv_id, e.i, e.b)),
ended AS (
  SELECT p.conv_id, min(struct_pack(cost := p.cost + x.cost, audit := p.audit || x.audit, said := p.said || x.said)) AS b
  FROM paths p JOIN summed s ON s.conv_id IS NOT DISTINCT FROM p.conv_id AND s.n = p.i JOIN inserts x ON x.a = p.place
  WHERE x.b IN (0, 3) GROUP BY p.conv_id)
SELECT ids.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(b.cost, 0) AS BIGINT) AS cost,
       coalesce(b.audit, '') AS audit, sha256(coalesce(left(b.said, length(b.said) - 1), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) ids LEFT JOIN summed ON summed.conv_id IS NOT DISTINCT FROM ids.conv_id
LEFT JOIN ended ON ended.conv_id IS NOT DISTINCT FROM ids.conv_id
"""

ORACLES["op12_exact_dedup"] = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS raw, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS t FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER w = 1 AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t ORDER BY length(raw) DESC, doc_id NULLS LAST)
"""

ORACLES["op13_filter_audit"] = """
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words FROM documents),
good AS (SELECT DISTINCT doc_id FROM labels WHERE quality = 1),
toxic AS (SELECT DISTINCT doc_id FROM labels WHERE toxic = 1),
judged AS (
  SELECT part, len(words) < 200 AS a, 100 * list_unique(words) < 50 * len(words) AS b,
         100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 2 * length(t) AS c,
         regexp_matches(t, '[#$%&*|]') AS d, coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS e,
         coalesce(doc_id IN (SELECT doc_id FROM good WHERE doc_id IS NOT NULL), false) AS good,
         coalesce(doc_id IN (SELECT doc_id FROM toxic WHERE doc_id IS NOT NULL), false) AS toxic FROM d),
masks AS (
  SELECT part, a, b, c, d, e, good, toxic, CAST(a AS INT) + CAST(b AS INT) + CAST(c AS INT) + CAST(d AS INT) + CAST(e AS INT) AS fails,
         count(*) AS n FROM judged GROUP BY ALL),
letters(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders AS (
  SELECT p.x || q.x || r.x || s.x || t.x AS o FROM letters p, letters q, letters r, letters s, letters t
  WHERE q.x <> p.x AND r.x NOT IN (p.x, q.x) AND s.x NOT IN (p.x, q.x, r.x) AND t.x NOT IN (p.x, q.x, r.x, s.x)),
hits AS (
  SELECT masks.*, o, least(CASE WHEN a THEN instr(o, 'A') ELSE 9 END, CASE WHEN b THEN instr(o, 'B') ELSE 9 END,
    CASE WHEN c THEN instr(o, 'C') ELSE 9 END, CASE WHEN d THEN instr(o, 'D') ELSE 9 END, CASE WHEN e THEN instr(o, 'E') ELSE 9 END) AS hit
  FROM masks, orders),
steps AS (
  SELECT *, substr(o, s, 1) AS f, CASE substr(o, s, 1) WHEN 'A' THEN a WHEN 'B' THEN b WHEN 'C' THEN c WHEN 'D' THEN d ELSE e END AS failing
  FROM hits, range(1, 6) r(s)),
counted AS (
  SELECT part, o, s, f, sum(CASE WHEN hit > s THEN n ELSE 0 END) AS kept, sum(CASE WHEN hit = s THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN failing AND hit < s THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN failing AND fails = 1 THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN hit = s AND good THEN n ELSE 0 END) AS good_lost,
         sum(CASE WHEN hit = s AND toxic THEN n ELSE 0 END) AS toxic_lost FROM steps GROUP BY part, o, s, f)
SELECT part, o AS filter_order, CAST(s AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley FROM counted
"""
