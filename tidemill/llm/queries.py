"""The queries opN_* and their SQL, thin digests of the operators' results."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm import bpe, mixing, pq_dedup, quality, rp_forest, simhash, token_files, toxicity, url_filter, warc
from tidemill.llm.common import text_id_crc


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _classified(docs: DataFrame, score, held_out) -> DataFrame:
    scored = docs.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), score("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = quality.fit(docs, read(spark, sf_dir, "labels"))
    return _classified(docs, quality.scorer(spark, model), text_id_crc() % 3 == 1)


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(spark, read(spark, sf_dir, "pages"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read(warc.write(spark, read(spark, sf_dir, "pages")))


#: A SHA-1 has 40 hexadecimal digits; each five are four digits of base 32.
OP3_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload) AS first FROM p)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         CAST(1 + ((CAST('0x' || substr(hex, CAST(5 * (i // 4) + 1 AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31) AS BIGINT), 1)), '') AS payload_digest,
       CASE WHEN page_id = first OR first IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM f
"""


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.plan(spark, read(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


OP4_SQL = r"""
WITH docs AS (
  SELECT doc_id, source,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         (CAST(CAST('0x' || substr(md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), 'null:' || md5(coalesce(text, '')))), 1, 12) AS BIGINT) AS DOUBLE) + 0.5) / 281474976710656.0 AS u
  FROM documents),
sizes AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, CAST(3 * sum(size) AS BIGINT) AS cap,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w, row_number() OVER (ORDER BY source NULLS LAST) AS rnk
  FROM docs GROUP BY source),
levels AS (
  SELECT *, CAST(cap AS DOUBLE) / w AS full_at,
         CAST(sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0) AS DOUBLE)
           / CAST(sum(w) OVER () - coalesce(sum(w) OVER before, 0) AS DOUBLE) AS level
  FROM sizes WINDOW before AS (ORDER BY CAST(cap AS DOUBLE) / w, rnk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size,
         least(CAST(cap AS DOUBLE), (SELECT level FROM levels WHERE level <= full_at ORDER BY full_at, rnk LIMIT 1) * w) AS target
  FROM levels),
parts AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM targets),
rests AS (SELECT *, target - CAST(whole * source_size AS DOUBLE) AS rest FROM parts),
odds AS (
  SELECT *, CASE WHEN source_size > 0 AND rest / source_size > 0 AND rest / source_size < 1
                 THEN (rest / source_size) / (1 - rest / source_size) END AS odds FROM rests),
ranked AS (
  SELECT d.doc_id, d.size, o.source_size, o.target, o.whole, o.rest, o.odds,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY (u / (1 - u)) / odds, d.doc_id NULLS FIRST
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM docs d JOIN odds o ON d.source IS NOT DISTINCT FROM o.source)
SELECT doc_id, size, source_size, target,
       CAST((whole + CASE WHEN odds IS NOT NULL AND CAST(start AS DOUBLE) + size / 2.0 <= rest THEN 1 ELSE 0 END) * size AS BIGINT) AS taken
FROM ranked
"""


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.encode(spark, read(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, digests=True)


def op6_pq_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pq_dedup.components(spark, read(spark, sf_dir, "embeddings"))
    return found.withColumn("kept", F.col("vec_id") == F.col("component_id"))


#: All pairs of a label: for small tables.
OP6_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS (
  SELECT *, sqrt(list_dot_product(e, e)) AS n FROM v
  WHERE e IS NOT NULL AND label IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.98),
reach(node, other) AS (
  SELECT vec_id, vec_id FROM v UNION SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.other),
c AS (SELECT node, min(other) AS component_id FROM reach GROUP BY node),
k AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT v.vec_id, CAST(coalesce(k.n, 0) AS BIGINT) AS n_links, c.component_id, v.vec_id = c.component_id AS kept
FROM v JOIN c ON c.node = v.vec_id LEFT JOIN k ON k.a = v.vec_id
"""


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = simhash.components(spark, read(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return named.select("doc_id", digits.alias("fingerprint"), "component_id")


def op8_rp_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rp_forest.search(spark, read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    return _classified(docs, toxicity.scorer(spark, model), text_id_crc() % 5 == 0)


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = token_files.write(spark, read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return token_files.digests(token_files.read(spark, folder))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_url_filter": op2_url_filter,
    "op3_warc": op3_warc,
    "op4_mixing": op4_mixing,
    "op5_bpe": op5_bpe,
    "op6_pq_dedup": op6_pq_dedup,
    "op7_simhash": op7_simhash,
    "op8_rp_forest": op8_rp_forest,
    "op9_toxicity": op9_toxicity,
    "op10_token_files": op10_token_files,
}

ORACLES: dict[str, str] = {"op3_warc": OP3_SQL, "op4_mixing": OP4_SQL, "op6_pq_dedup": OP6_SQL}
