"""The operators over their whole tables, with the settings they would have in production."""

from __future__ import annotations

from collections.abc import Callable
from fractions import Fraction

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from twinledger.llm import bpe, langid, licences, mixing, negatives, packing, pii, polyhash, simhash, spelling, topk, toxicity, wavelet
from twinledger.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(work: Callable[[SparkSession, str], DataFrame]):
    QUERIES[work.__name__] = work
    return work


@query
def op1_exact_top_k(spark, folder):
    vectors = topk.whole_numbers(table(spark, folder, "embeddings"))
    return topk.top_k(vectors, F.col("vec_id") % 50 == 0, k=5)


ORACLES["op1_exact_top_k"] = """
WITH v AS (
  SELECT DISTINCT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS vector
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
    CAST(list_sum([p[1] * p[2] FOR p IN list_zip(q.vector, c.vector)]) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.vector) = len(q.vector)
  WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@query
def op2_best_fit_packing(spark, folder):
    docs = table(spark, folder, "documents")
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), size=2048, end_id=0)


@query
def op3_token_files(spark, folder):
    docs = table(spark, folder, "documents")
    return wavelet.round_trip(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)


@query
def op4_byte_bpe(spark, folder):
    docs = table(spark, folder, "documents")
    return bpe.digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


@query
def op5_license_scan(spark, folder):
    return licences.scan(table(spark, folder, "documents"))


@query
def op6_simhash(spark, folder):
    return simhash.near_duplicates(table(spark, folder, "documents"), size=3, radius=3)


@query
def op7_toxicity(spark, folder):
    docs = table(spark, folder, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, folder, "labels")), threshold=0.3)


@query
def op8_personal_data(spark, folder):
    found = pii.scan(table(spark, folder, "documents"))
    counts = [f"n_{k}" for k in pii.KINDS]
    digest = F.sha2(F.col("base_spans").cast("binary"), 256).alias("base_sha256")
    return found.select("doc_id", *counts, digest, "spans")


@query
def op9_language(spark, folder):
    docs = table(spark, folder, "documents")
    return langid.predict(docs, langid.fit(docs))


@query
def op10_fingerprints(spark, folder):
    return polyhash.fingerprints(table(spark, folder, "documents"))


@query
def op11_mix_sources(spark, folder):
    mixed = mixing.mix(table(spark, folder, "documents"), weights=(3, 1, 2), share=Fraction(3, 2), epochs=2)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


ORACLES["op11_mix_sources"] = r"""
WITH docs AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    md5('11:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')) AS key
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    [3, 1, 2][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS BIGINT)] AS weight
  FROM docs GROUP BY source
), ordered AS (
  -- in the order in which rising water reaches the caps: words and weights left for a source if all before it are clamped
  SELECT *, 1.5 * sum(source_size) OVER () - 2 * (sum(source_size) OVER w - source_size) AS free,
    sum(weight) OVER () - (sum(weight) OVER w - weight) AS weights, row_number() OVER w AS place
  FROM sources
  WINDOW w AS (ORDER BY source_size / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)
), level AS (
  SELECT CAST(free AS DOUBLE) AS free, CAST(weights AS DOUBLE) AS weights
  FROM ordered WHERE 2 * source_size * weights > weight * free ORDER BY place LIMIT 1
), aimed AS (
  SELECT s.*, CASE WHEN l.free IS NULL OR 2 * s.source_size * l.weights <= s.weight * l.free THEN CAST(2 * s.source_size AS DOUBLE)
    ELSE s.weight * l.free / l.weights END AS target
  FROM sources s LEFT JOIN level l ON true
), whole AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM aimed
), placed AS (
  SELECT d.*, w.source_size, w.target, w.whole, w.target - w.whole * w.source_size AS rest,
    sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key ROWS UNBOUNDED PRECEDING) - d.size AS before
  FROM docs d JOIN whole w ON d.source IS NOT DISTINCT FROM w.source
)
SELECT doc_id, size, source_size, target,
  CAST(size * (whole + CASE WHEN before + size <= rest OR before <= rest AND rest > 0 AND rest - before >= size / 2 THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM placed
"""


@query
def op12_hard_negatives(spark, folder):
    vectors = negatives.whole_numbers(table(spark, folder, "embeddings"))
    noisy = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(vectors.withColumn("label", noisy), F.col("vec_id") % 100 == 0)


ORACLES["op12_hard_negatives"] = """
WITH v AS (
  SELECT row_number() OVER () AS row, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS vector
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), pairs AS (
  SELECT a.row, a.vec_id AS anchor_id, c.vec_id AS other, c.row AS other_row, c.label = a.label AS same,
    CAST(list_sum([p[1] * p[2] FOR p IN list_zip(a.vector, c.vector)]) AS BIGINT) AS score
  FROM v a JOIN v c ON c.vec_id <> a.vec_id AND len(c.vector) = len(a.vector)
  WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY row ORDER BY score DESC, other, other_row) AS place FROM pairs WHERE same)
  WHERE place <= 5
), ranked AS (
  SELECT p.anchor_id, p.other AS positive_id, n.other AS negative_id, p.score AS positive_score, n.score AS negative_score,
    row_number() OVER (PARTITION BY p.row, p.place ORDER BY n.score DESC, n.other) AS rank
  FROM positives p JOIN pairs n ON n.row = p.row AND NOT n.same
  WHERE 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 10
"""


@query
def op13_spelling_variants(spark, folder):
    return spelling.variants(table(spark, folder, "documents"), least=7, times=2, ratio=10, every=31)


@query
def pipeline(spark, folder):
    return corpus_pipeline.run(spark, folder)


if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
