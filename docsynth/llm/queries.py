"""The dealt operators bound to the driver's tables, with SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsynth.llm import bpe, dialogue, jaccard, langid, minhash, mixing, negatives, neighbours, packing, quality, secretscan, substring, warc
from docsynth.llm.arrays import reachable

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, path: str, name: str) -> DataFrame:
    return reachable(spark).read.parquet(f"{path}/{name}.parquet")


@query
def op1_bpe(spark: SparkSession, path: str) -> DataFrame:
    return bpe.digest(table(spark, path, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op2_language_id(spark: SparkSession, path: str) -> DataFrame:
    return langid.predict(table(spark, path, "documents"))


@query
def op3_secret_scan(spark: SparkSession, path: str) -> DataFrame:
    return secretscan.report(table(spark, path, "documents"))


@query
def op8_mixing(spark: SparkSession, path: str) -> DataFrame:
    return mixing.report(table(spark, path, "documents"))


ORACLE["op8_mixing"] = r"""
WITH d AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS digest,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM d GROUP BY source),
w AS (SELECT *, CAST([5, 2, 1][CAST(place % 3 + 1 AS INTEGER)] AS BIGINT) AS weight, CAST(3 * source_size AS BIGINT) AS most FROM s),
r AS (SELECT *, row_number() OVER o AS rank,
        (CAST(sum(source_size) OVER () AS BIGINT) - CAST(coalesce(sum(most) OVER b, 0) AS BIGINT))
        / (CAST(sum(weight) OVER () AS BIGINT) - CAST(coalesce(sum(weight) OVER b, 0) AS BIGINT)) AS level
      FROM w WINDOW o AS (ORDER BY CAST(most AS DOUBLE) / weight, place), b AS (ORDER BY CAST(most AS DOUBLE) / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT min(rank) AS open FROM r WHERE most > weight * level),
t AS (SELECT source, source_size, place, CASE WHEN open IS NULL OR rank < open THEN CAST(most AS DOUBLE) ELSE weight * (SELECT level FROM r WHERE rank = open) END AS target FROM r, f),
p AS (SELECT d.*, source_size, place, target, CAST(floor(target + 0.5) AS BIGINT) AS total,
        CAST(coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY digest, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
q AS (SELECT *, CASE WHEN source_size > 0 THEN total // source_size ELSE 0 END AS rounds, [-0.5, 0.5, 0.0][CAST(place % 3 + 1 AS INTEGER)]::DOUBLE AS slope FROM p),
k AS (SELECT *, CAST(rounds * size + greatest(0, least(size, total - rounds * source_size - start)) AS BIGINT) AS taken,
        least(1.0::DOUBLE, start / total) AS share FROM q)
SELECT doc_id, size, source_size, target, taken,
  CASE WHEN taken > 0 THEN CASE WHEN slope = 0 THEN share ELSE (sqrt((1 - slope) * (1 - slope) + 4 * slope * share) - (1 - slope)) / (2 * slope) END END AS position
FROM k"""


@query
def op9_quality_rules(spark: SparkSession, path: str) -> DataFrame:
    return quality.rules(table(spark, path, "documents"), table(spark, path, "labels"))


@query
def op4_jaccard_join(spark: SparkSession, path: str) -> DataFrame:
    return jaccard.join(table(spark, path, "documents")).drop("row")


@query
def op5_substring_dedup(spark: SparkSession, path: str) -> DataFrame:
    return substring.report(table(spark, path, "documents"))


@query
def op6_nearest_neighbours(spark: SparkSession, path: str) -> DataFrame:
    return neighbours.search(table(spark, path, "embeddings"), F.col("id") % 20 == 0)


ORACLE["op6_nearest_neighbours"] = """
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS n, CAST(vec_id AS BIGINT) AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (
  SELECT q.n, q.id AS query_id, c.id AS vec_id, list_inner_product(q.v, c.v) AS score
  FROM v q JOIN v c ON q.id % 20 = 0 AND q.n <> c.n AND len(q.v) = len(c.v)),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20"""


@query
def op7_warc_fixity(spark: SparkSession, path: str) -> DataFrame:
    """The replica is the pages with rot in some: a byte changed at a place set by the id, or the end of the body lost."""
    pages = table(spark, path, "pages")
    html, ident = F.col("html"), F.col("page_id")
    at = (ident % 50 + 1).cast("int")
    changed = F.overlay(html, F.lit("\x01"), at)
    lost = html.substr(F.lit(1), F.length(html) - 7)
    return warc.report(pages, F.when((ident % 97 == 5) & (F.length(html) >= 60), changed).when((ident % 131 == 7) & (F.length(html) >= 60), lost).otherwise(F.coalesce(html, F.lit(""))))


ORACLE["op7_warc_fixity"] = r"""
WITH k AS (SELECT *, md5(CAST(page_id AS VARCHAR) || ' ' || url) AS m FROM pages),
r AS (SELECT page_id, url, html, page_id // 1000 AS file,
        'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:uuid:'
        || m[1:8] || '-' || m[9:12] || '-' || m[13:16] || '-' || m[17:20] || '-' || m[21:32] || '>' || chr(13) || chr(10)
        || 'WARC-Date: 2024-01-01T00:00:00Z' || chr(13) || chr(10) || 'WARC-Target-URI: ' || url || chr(13) || chr(10)
        || 'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: ' || CAST(strlen(html) AS VARCHAR)
        || chr(13) || chr(10) || chr(13) || chr(10) || html || chr(13) || chr(10) || chr(13) || chr(10) AS bytes
      FROM k)
SELECT page_id, file,
  CAST(coalesce(sum(strlen(bytes)) OVER (PARTITION BY file ORDER BY page_id, url ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset",
  CAST(strlen(bytes) AS BIGINT) AS length, sha256(bytes) AS digest,
  length(html) >= 60 AND (page_id % 97 = 5 OR page_id % 131 = 7) AS damaged
FROM r"""


@query
def op10_packing(spark: SparkSession, path: str) -> DataFrame:
    return packing.pack(table(spark, path, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op11_hard_negatives(spark: SparkSession, path: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, path, "embeddings"), F.col("id") % 100 == 0, label=label)


ORACLE["op11_hard_negatives"] = """
WITH v AS (
  SELECT CAST(vec_id AS BIGINT) AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.id AS anchor_id, c.id, a.label = c.label AS same, CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
  FROM v a JOIN v c ON a.id % 100 = 0 AND a.id <> c.id AND len(a.v) = len(c.v)),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT s.same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.id)
QUALIFY row_number() OVER w <= 10"""


@query
def op12_conversation_repair(spark: SparkSession, path: str) -> DataFrame:
    return dialogue.report(table(spark, path, "conversations"))


@query
def op13_minhash(spark: SparkSession, path: str) -> DataFrame:
    return minhash.groups(table(spark, path, "documents"))
