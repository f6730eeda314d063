"""One query per operator, with production parameters over its whole table, and DuckDB SQL where SQL can say it."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (decontaminate, gear_dedup, html_text, line_dedup, merkle, mixing, periodic, perspectives, quality, simhash, token_count,
               token_file, vector_lsh)
from .common import table


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gear_dedup.repeated_passages(table(spark, sf_dir, "documents"))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_pages(table(spark, sf_dir, "pages"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_file.token_files(spark, docs, tokenizer_path("byte_bpe_50k.json")).select("doc_id", "start", "n_tokens", "ids_crc32")


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.plan_mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_lsh.near_vectors(table(spark, sf_dir, "embeddings"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def held_out():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2


def op7_quality_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ranking = quality.learn(docs, table(spark, sf_dir, "labels").where(~held_out()))
    scored = quality.score(docs, ranking)
    return scored.select("doc_id", held_out().alias("held_out"), F.col("quality_score").alias("score"),
                         (F.col("quality_score") >= ranking.cut).cast("int").alias("predicted"))


def op8_chat_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perspectives.rotate(table(spark, sf_dir, "conversations"))


def op9_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, threshold=2, seed=42)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.without_common_lines(table(spark, sf_dir, "documents"), shortest=40, least_docs=5, digest_only=True)
    return found.select("doc_id", "n_lines", "n_dropped", "kept_sha256")


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.document_runs(table(spark, sf_dir, "documents"), planted=True)


MANIFEST = ("doc_id", "source", "lang", "n_chars", "text")


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    tampered = F.when(chosen, merkle.leaf_digest([*MANIFEST[:-1], lowered]))
    found = merkle.manifest(docs, MANIFEST, group="lang", order="doc_id", candidate=tampered, arity=8)
    return found.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root",
                        (F.col("folded_root") == F.col("root")).alias("verified"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_substring_dedup, op2_html_extraction, op3_token_files, op4_source_mixing, op5_embedding_dedup,
        op6_decontamination, op7_quality_ranking, op8_chat_perspectives, op9_simhash_dedup, op10_token_counts, op11_line_dedup,
        op12_periodic_runs, op13_merkle_manifest)}

#: Queries without SQL are tested against brute force in tests/llm.
ORACLE: dict[str, str] = {
    "op4_source_mixing": r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
ranked AS (
  SELECT source, source_size, source_size * 3 AS stop,
         ([5, 2, 1])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight FROM per),
levels AS (
  SELECT *, row_number() OVER by_stop AS n,
         (sum(source_size) OVER () * 1.0::DOUBLE - coalesce(sum(stop) OVER (by_stop ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (by_stop ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS own_level
  FROM ranked WINDOW by_stop AS (ORDER BY stop::DOUBLE / weight, source NULLS LAST)),
level AS (SELECT arg_min(own_level, n) AS lv FROM levels WHERE own_level * weight <= stop),
targets AS (
  SELECT source, source_size,
         CASE WHEN lv IS NULL THEN stop::DOUBLE ELSE least(stop::DOUBLE, lv * weight) END AS target FROM levels, level),
rated AS (
  SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source)
SELECT doc_id, size, source_size, target,
       size * (floor(rate)::BIGINT + CASE WHEN
         ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE
         < rate - floor(rate) THEN 1 ELSE 0 END) AS taken
FROM rated""",
    "op8_chat_perspectives": r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS speaker, coalesce(text, '') AS said,
         CASE WHEN conv_id IS NULL THEN row_number() OVER () END AS alone FROM conversations),
own AS (SELECT DISTINCT conv_id, alone, speaker AS perspective FROM t WHERE speaker <> 'system'),
views AS (
  SELECT t.*, perspective, CASE WHEN speaker = perspective THEN 'assistant' WHEN speaker = 'system' THEN 'system' ELSE 'user' END AS role
  FROM t JOIN own ON t.conv_id IS NOT DISTINCT FROM own.conv_id AND t.alone IS NOT DISTINCT FROM own.alone),
named AS (SELECT *, CASE WHEN role = 'user' THEN speaker END AS name FROM views),
headed AS (SELECT *, '<|' || role || coalesce(' ' || name, '') || '|>' || chr(10) AS head FROM named),
shown AS (SELECT *, head || said || '<|end|>' || chr(10) AS segment FROM headed),
placed AS (
  SELECT *, row_number() OVER w - 1 AS seq,
         coalesce(sum(length(segment)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM shown WINDOW w AS (PARTITION BY conv_id, alone, perspective ORDER BY turn NULLS FIRST, speaker, said))
SELECT conv_id, perspective, seq, turn, role, name, segment, start, start + length(head) AS mask_start,
       start + length(head) + CASE WHEN role = 'assistant' THEN length(said) ELSE 0 END AS mask_end
FROM placed""",
    "op11_line_dedup": r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS number FROM documents),
keyed AS (
  SELECT doc_id, number, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
common AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT keyed.*, common.key IS NOT NULL AND keeper <> doc_id AS gone FROM keyed LEFT JOIN common USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY number) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id""",
    "op13_merkle_manifest": r"""
WITH RECURSIVE ids AS (SELECT DISTINCT doc_id FROM documents),
bytes AS (SELECT doc_id, flatten(list_transform(range(1, length(doc_id::VARCHAR) + 1),
            lambda i: [ascii(substr(doc_id::VARCHAR, i, 1))::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])) AS steps FROM ids),
crc AS (
  SELECT doc_id, xor(list_reduce(list_prepend(4294967295::BIGINT, steps),
           lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, (c & 1) * 3988292384) END), 4294967295::BIGINT) AS crc FROM bytes),
parts AS (
  SELECT doc_id, lang, text,
         coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id::VARCHAR, '-') || coalesce(strlen(source) || ':' || source, '-')
         || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars::VARCHAR, '-') AS head,
         translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lowered FROM documents),
leaves AS (
  SELECT parts.doc_id, lang, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         CASE WHEN crc % 3 = 0 THEN sha256(head || coalesce(strlen(lowered) || ':' || lowered, '-'))
              ELSE sha256(head || coalesce(strlen(text) || ':' || text, '-')) END AS candidate
  FROM parts JOIN crc ON parts.doc_id = crc.doc_id),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS pos FROM leaves),
inner_nodes AS (
  SELECT 0 AS level, lang, pos, leaf AS digest, count(*) OVER (PARTITION BY lang) AS total FROM placed
  UNION ALL
  SELECT any_value(level) + 1, lang, pos // 8, sha256(string_agg(digest, '' ORDER BY pos)), (any_value(total) + 7) // 8
  FROM inner_nodes WHERE total > 1 GROUP BY lang, pos // 8),
subroots AS (
  SELECT lang, level AS height, digest AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place
  FROM inner_nodes WHERE total = 1),
outer_nodes AS (
  SELECT 0 AS level, place AS pos, subroot AS digest, count(*) OVER () AS total FROM subroots
  UNION ALL
  SELECT any_value(level) + 1, pos // 8, sha256(string_agg(digest, '' ORDER BY pos)), (any_value(total) + 7) // 8
  FROM outer_nodes WHERE total > 1 GROUP BY pos // 8),
root AS (SELECT digest AS root, level AS top FROM outer_nodes WHERE total = 1),
inner_runs AS (
  SELECT level, lang, pos // 8 AS run, list(digest ORDER BY pos) AS run_digests FROM inner_nodes WHERE total > 1 GROUP BY level, lang, pos // 8),
outer_runs AS (SELECT level, pos // 8 AS run, list(digest ORDER BY pos) AS run_digests FROM outer_nodes WHERE total > 1 GROUP BY level, pos // 8),
climb AS (
  SELECT doc_id, placed.lang, 0 AS level, pos, candidate AS folded, '' AS proof, height, place, false AS above
  FROM placed JOIN subroots ON placed.lang IS NOT DISTINCT FROM subroots.lang
  UNION ALL
  SELECT doc_id, lang, CASE WHEN turn THEN 0 ELSE level + 1 END, CASE WHEN turn THEN place ELSE pos // 8 END,
         CASE WHEN turn THEN folded ELSE
           sha256(list_aggregate(run_digests[1:(pos % 8)::INT], 'string_agg', '').coalesce('') || folded
                  || list_aggregate(run_digests[(pos % 8)::INT + 2:], 'string_agg', '').coalesce('')) END,
         CASE WHEN turn THEN proof ELSE
           proof || list_aggregate(run_digests[1:(pos % 8)::INT], 'string_agg', '').coalesce('')
                 || list_aggregate(run_digests[(pos % 8)::INT + 2:], 'string_agg', '').coalesce('') END,
         height, place, above OR turn
  FROM (SELECT climb.*, NOT above AND climb.level = height AS turn, coalesce(i.run_digests, o.run_digests) AS run_digests, top
        FROM climb CROSS JOIN root
        LEFT JOIN inner_runs i ON NOT above AND climb.level < height AND i.level = climb.level
             AND i.lang IS NOT DISTINCT FROM climb.lang AND i.run = climb.pos // 8
        LEFT JOIN outer_runs o ON above AND o.level = climb.level AND o.run = climb.pos // 8) AS c
  WHERE NOT above OR level < top)
SELECT placed.doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM placed JOIN climb ON placed.doc_id = climb.doc_id JOIN subroots ON placed.lang IS NOT DISTINCT FROM subroots.lang
CROSS JOIN root WHERE climb.above AND climb.level = top""",
}
