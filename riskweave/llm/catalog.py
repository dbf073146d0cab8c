"""Registered queries of the training-data operators: each applies its operator,
with production parameters, to its whole table. Operators that SQL cannot express
(hashes, seeded rounding, learned models) have no oracle; their tests compare with
brute force."""

from __future__ import annotations

import corpus_pipeline

from . import centroids, html, language, lexical, mixing, packing, pii, quality, sharding, simhash, tokenids, topk, toxicity
from .common import read

QUERIES = {
    "op1_topk_search": lambda spark, sf_dir: topk.search(read(spark, sf_dir, "embeddings")),
    "op2_language_id": lambda spark, sf_dir: language.identify(read(spark, sf_dir, "documents")),
    "op3_best_fit_packing": lambda spark, sf_dir: packing.pack(read(spark, sf_dir, "documents")),
    "op4_quality_rules": lambda spark, sf_dir: quality.quality_rules(read(spark, sf_dir, "documents")),
    "op5_simhash_near_dedup": lambda spark, sf_dir: simhash.near_duplicates(read(spark, sf_dir, "documents")),
    "op6_source_mixing": lambda spark, sf_dir: mixing.copies(read(spark, sf_dir, "documents")).drop("copies", "lane", "second"),
    "op7_toxicity": lambda spark, sf_dir: toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")),
    "op8_pii_bootstrap": lambda spark, sf_dir: pii.extract(read(spark, sf_dir, "documents")).drop("row"),
    "op9_sharding": lambda spark, sf_dir: sharding.shard_documents(read(spark, sf_dir, "documents"), [1.0] * 40),
    "op10_html_extraction": lambda spark, sf_dir: html.extract(read(spark, sf_dir, "pages")),
    "op11_lexical_search": lambda spark, sf_dir: lexical.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")),
    "op12_centroid_clustering": lambda spark, sf_dir: centroids.cluster(read(spark, sf_dir, "embeddings")),
    "op13_token_ids": lambda spark, sf_dir: tokenids.round_trip(read(spark, sf_dir, "documents")),
    "pipeline": corpus_pipeline.run,
}

ORACLE = {
    "op1_topk_search": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
  WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id, score
FROM s QUALIFY rank <= 10""",
    "op11_lexical_search": lexical.oracle(),
    "op12_centroid_clustering": centroids.oracle(),
}
if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
