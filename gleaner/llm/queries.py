"""The queries opN_* with their production parameters, and their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm import chat, contamination, importance, mixing, passages, quality_rules, simhash, toxicity, urls, warc
from gleaner.scratch import Scratch
from gleaner.session import table


def op1_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


OP2_SQL = r"""
WITH RECURSIVE own AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('mix-1:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))) AS ord
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT AS weight
  FROM own GROUP BY source),
rounds AS (
  SELECT 0 AS i, 0.0::DOUBLE AS lvl
  UNION ALL
  SELECT i + 1, (SELECT (((SELECT sum(source_size) FROM sources)::DOUBLE * 1.0
      - coalesce(sum(CASE WHEN weight * r.lvl > source_size * 3 THEN source_size * 3 END), 0)::DOUBLE)
      / sum(CASE WHEN weight * r.lvl > source_size * 3 THEN 0 ELSE weight END)::DOUBLE) FROM sources)
  FROM rounds r WHERE i < 60),
level AS (SELECT arg_max(lvl, i) AS lvl FROM rounds),
targets AS (
  SELECT source, source_size,
         CASE WHEN weight * lvl > source_size * 3 THEN (source_size * 3)::DOUBLE ELSE weight * lvl END AS target
  FROM sources, level),
parts AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS whole FROM targets),
placed AS (
  SELECT o.doc_id, o.source, o.size, p.source_size, p.target, p.whole, p.target - p.whole * p.source_size AS part,
         coalesce(sum(o.size) OVER (PARTITION BY o.source ORDER BY o.ord, o.doc_id, o.size
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM own o JOIN parts p ON o.source IS NOT DISTINCT FROM p.source),
counted AS (
  SELECT *, (whole + CASE WHEN size > 0 AND 2 * before + size <= 2 * part THEN 1 ELSE 0 END)::BIGINT AS copies FROM placed)
SELECT doc_id, size, source_size, target, copies * size AS taken, source, copies FROM counted
"""


def op3_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The model is counted on half of the conversations (by hash) and parses all."""
    scratch = Scratch(spark, "chat")
    raw = scratch.write(chat.build_transcripts(table(spark, sf_dir, "conversations"), unmarked=12), "transcripts")
    held_out = F.pmod(F.xxhash64("conv_id", F.lit(5)), F.lit(2)) == 1
    model = chat.fit(raw.where(~held_out))
    return chat.parse_transcripts(raw.withColumn("held_out", held_out), model, ["conv_id", "part", "deal", "held_out"], truth=F.col("truth"))


def op4_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_spans(table(spark, sf_dir, "documents"), min_line=25, min_run=42, threshold=0.8, shingle=5).drop("rk")


def op5_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.severity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), limit=20_000)


def op6_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), limit=20_000, seed=11)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, sf_dir, "documents"), shingle=3, seed=42, distance=3)


def op8_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf_dir, "pages"), urls.RULES)


def op9_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), threshold=0.8, shingle=5).drop("rk")


OP9_SQL = r"""
WITH d AS (
  SELECT DISTINCT doc_id, text, string_split(trim(regexp_replace(lower(text), '[^\p{L}\p{N}]+', ' ', 'g')), ' ') AS w FROM documents),
b AS (
  SELECT DISTINCT item_id, text, string_split(trim(regexp_replace(lower(text), '[^\p{L}\p{N}]+', ' ', 'g')), ' ') AS w FROM benchmark),
bi AS (SELECT item_id, text, unnest(range(1, len(w) - 3)) AS i, w FROM b WHERE len(w) >= 5),
bs AS (SELECT DISTINCT item_id, text, array_to_string(w[i:i+4], ' ') AS s FROM bi),
bn AS (SELECT item_id, text, count(*) AS n_item FROM bs GROUP BY ALL),
di AS (SELECT doc_id, text, unnest(range(1, len(w) - 3)) AS i, w FROM d WHERE len(w) >= 5),
ds AS (SELECT DISTINCT doc_id, text, array_to_string(w[i:i+4], ' ') AS s FROM di)
SELECT ds.doc_id, bs.item_id, count(*)::BIGINT AS n_shared, max(n_item)::BIGINT AS n_item, count(*) / max(n_item) AS containment
FROM ds JOIN bs ON ds.s = bs.s JOIN bn ON bs.item_id IS NOT DISTINCT FROM bn.item_id AND bs.text = bn.text
GROUP BY ds.doc_id, ds.text, bs.item_id, bs.text
HAVING count(*) >= 0.8 * max(n_item) - 1e-9
"""


def op10_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "warc")
    archives = scratch.place("archives")
    warc.write_archives(table(spark, sf_dir, "pages"), archives, scratch, min_bytes=1000)
    return warc.resolve_revisits(warc.read_archives(spark, archives), scratch)


OP10_SQL = """
WITH p AS (
  SELECT page_id, coalesce(strlen(html), 0)::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS original FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM original AND original IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM original AND original IS NOT NULL THEN original END AS refers_to
FROM m
"""

QUERIES = {
    f.__name__: f
    for f in (op1_divergence, op2_mix_sources, op3_transcripts, op4_passages, op5_severity, op6_importance, op7_simhash, op8_urls, op9_contamination, op10_warc_revisits)
}
ORACLES = {"op2_mix_sources": OP2_SQL, "op9_contamination": OP9_SQL, "op10_warc_revisits": OP10_SQL}
