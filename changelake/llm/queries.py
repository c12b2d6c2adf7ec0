"""One query per training-data operator over its whole table, with DuckDB SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path
from . import bpe, chat, decontamination, hmm, html_extract, langid, merkle, neardup, periods, quality, substrings, toxicity, warc
from .common import pick, read_table

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def tokenizer_file() -> str:
    """The tokenizer the queries use; the operator takes any file of the kind as a parameter."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query
def op2_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "warc")
    manifest = warc.write_warc(read_table(spark, sf_dir, "pages"), folder)
    records = warc.read_warc(spark, folder, manifest, with_payload=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op3_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_digest(read_table(spark, sf_dir, "documents"), tokenizer_file())


@query
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.quality_verdicts(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query
def op7_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    table = pick(read_table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text")
    planted = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], table.schema)
    return chat.chat_digest(chat.chat_windows(table.unionByName(planted)))


ORACLE_SQL["op4_quality_rules"] = r"""
WITH words AS (
  SELECT rowid AS r, doc_id, source, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM (SELECT row_number() OVER () AS rowid, * FROM documents)
), win AS (
  SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM words WHERE len(w) >= 3)
), hit AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM win) WHERE c > 1
), rep AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM hit) GROUP BY r
), counts AS (
  SELECT words.r, doc_id, source, CAST(len(w) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(l) AS BIGINT) AS n_lines, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words
  FROM words LEFT JOIN rep ON rep.r = words.r
), ruled AS (
  SELECT *, (n_words < 50 OR n_repeat_words > 0.5 * n_words) AS base_failed,
         (n_symbols > 0.1 * n_words OR n_dup_lines > 0.3 * n_lines) AS soft_failed FROM counts
), per AS (
  SELECT source, count(*) AS n, sum(CAST(base_failed OR soft_failed AS INT)) AS failed FROM ruled GROUP BY source
), m AS (
  SELECT sum(failed) / sum(n) AS mean, avg((failed / n) ** 2) - avg(failed / n) ** 2 AS seen, avg(1.0 / n) AS inv FROM per
), prior AS (
  SELECT mean, greatest(1.0, CASE WHEN seen - mean * (1 - mean) * inv > 0
         THEN least(10000.0, mean * (1 - mean) / (seen - mean * (1 - mean) * inv) - 1) ELSE 10000.0 END) AS weight FROM m
), hosts AS (SELECT source, (failed + mean * weight) / (n + weight) AS rate FROM per, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND rate < 0.8 AND NOT (soft_failed AND rate >= 0.005) AS kept
FROM ruled JOIN hosts ON ruled.source IS NOT DISTINCT FROM hosts.source
"""


@query
def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(read_table(spark, sf_dir, "documents"), neardup.NearDupParams(words=2)).drop("text_hash")


@query
def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.removal_digest(read_table(spark, sf_dir, "documents"))


@query
def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.decontaminate(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "contaminated", "n_items", "items")


@query
def op8_hmm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score_texts(read_table(spark, sf_dir, "documents"))


@query
def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(read_table(spark, sf_dir, "pages"))


@query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods.run_digest(periods.periodic_runs(periods.plant_runs(read_table(spark, sf_dir, "documents"))))


@query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.document_manifest(read_table(spark, sf_dir, "documents"))


def _leaf_sql(**columns: str) -> str:
    """A leaf in DuckDB SQL; ``columns`` replaces the expression of a column."""
    texts = [f"CAST({columns.get(c, c)} AS VARCHAR)" for c in merkle.LEAF]
    return "sha256(concat(" + ", ".join(f"coalesce(strlen({t}) || ':' || {t}, '-')" for t in texts) + "))"


# crc32 of the decimal id, bit by bit: one step of eight shifts for each digit
_CRC_STEP = "x"
for _ in range(8):
    _CRC_STEP = f"list_transform({_CRC_STEP}, lambda v: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)"

ORACLE_SQL["op13_merkle_manifest"] = f"""
WITH RECURSIVE byte AS (
  SELECT r AS b, unnest({_CRC_STEP}) AS t FROM (SELECT r, [r] AS x FROM range(256) AS z(r))
), crc AS (
  SELECT doc_id, 0 AS k, CAST(4294967295 AS BIGINT) AS v FROM (SELECT DISTINCT doc_id FROM documents)
  UNION ALL
  SELECT doc_id, k + 1, xor(v >> 8, byte.t) FROM crc JOIN byte
    ON byte.b = xor(v & 255, CAST(ord(substr(CAST(doc_id AS VARCHAR), k + 1, 1)) AS BIGINT))
  WHERE k < length(coalesce(CAST(doc_id AS VARCHAR), ''))
), picked AS (
  SELECT doc_id, arg_max(xor(v, 4294967295), k) % 7 = 0 AS hit FROM crc GROUP BY doc_id
), leaves AS (
  SELECT documents.doc_id, lang, {_leaf_sql(doc_id="documents.doc_id")} AS leaf,
         CASE WHEN hit AND n_chars IS NOT NULL THEN {_leaf_sql(doc_id="documents.doc_id", n_chars="CAST(n_chars AS HUGEINT) + 1")} ELSE {_leaf_sql(doc_id="documents.doc_id")} END AS told
  FROM documents JOIN picked ON picked.doc_id IS NOT DISTINCT FROM documents.doc_id
), ranked AS (
  SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM leaves
), node AS (
  SELECT 0 AS lv, g, i, leaf AS h, count(*) OVER (PARTITION BY g) AS n FROM ranked
  UNION ALL
  SELECT lv + 1, g, i // 2, sha256(string_agg(h, '' ORDER BY i)), (max(n) + 1) // 2 FROM node WHERE n > 1 GROUP BY lv, g, i // 2
), subs AS (SELECT g, h FROM node WHERE n = 1
), top AS (
  SELECT 0 AS lv, g AS i, h, count(*) OVER () AS n FROM subs
  UNION ALL
  SELECT lv + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (max(n) + 1) // 2 FROM top WHERE n > 1 GROUP BY lv, i // 2
), every AS (
  SELECT g, lv, i, h, n, max(CASE WHEN n = 1 THEN lv END) OVER (PARTITION BY g) AS last FROM node
), steps AS (
  SELECT ranked.doc_id, ranked.g, ranked.i AS leaf_at, every.lv, s.h AS sib, every.i % 2 AS slot
  FROM ranked JOIN every ON every.g = ranked.g AND every.i = ranked.i >> every.lv AND every.n > 1
  LEFT JOIN node s ON s.g = every.g AND s.lv = every.lv AND s.i = xor(every.i, 1)
  UNION ALL
  SELECT ranked.doc_id, ranked.g, ranked.i, subs_last.last + 1 + a.lv, s.h, a.i % 2
  FROM ranked JOIN (SELECT DISTINCT g, last FROM every) subs_last ON subs_last.g = ranked.g
  JOIN top a ON a.i = ranked.g >> a.lv AND a.n > 1
  LEFT JOIN top s ON s.lv = a.lv AND s.i = xor(a.i, 1)
), proofs AS (
  SELECT g, leaf_at, sha256(coalesce(string_agg(sib, '' ORDER BY lv), '')) AS proof_sha256,
         list(struct_pack(sib := sib, slot := slot) ORDER BY lv) AS way FROM steps GROUP BY g, leaf_at
), folded AS (
  SELECT g, i, told AS h, 1 AS k FROM ranked
  UNION ALL
  SELECT folded.g, folded.i, sha256(CASE WHEN way[k].slot = 1 THEN concat(way[k].sib, h) ELSE concat(h, way[k].sib) END), k + 1
  FROM folded JOIN proofs ON proofs.g = folded.g AND proofs.leaf_at = folded.i WHERE k <= len(way)
), ends AS (SELECT g, i, arg_max(h, k) AS folded_root FROM folded GROUP BY g, i
), whole AS (SELECT h AS root FROM top WHERE n = 1)
SELECT ranked.doc_id, ranked.leaf, subs.h AS subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256,
       folded_root, folded_root = root AS verified
FROM ranked JOIN subs ON subs.g = ranked.g JOIN ends ON ends.g = ranked.g AND ends.i = ranked.i
LEFT JOIN proofs ON proofs.g = ranked.g AND proofs.leaf_at = ranked.i CROSS JOIN whole
"""


@query
def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(read_table(spark, sf_dir, "documents")).drop("spans")
