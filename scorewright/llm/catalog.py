"""The registered training-data queries and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from scorewright.llm import (dualtree, hostpaths, license_scan, merkle, mixing, pieces, rule_quality, sharding,
                             simhash, topk, vptree, warc, wavelet)
from scorewright.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.pack(table(spark, sf_dir, "documents"), n_shards=24)


@query
def op2_warc_writer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).drop("file")


SQL["op2_warc_writer"] = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS digest,
  row_number() OVER (PARTITION BY sha256(coalesce(html, '')) ORDER BY page_id NULLS LAST) AS nth FROM pages),
f AS (SELECT digest, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY digest)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
  CASE WHEN first IS NOT NULL AND nth > 1 THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN nth > 1 THEN first END AS refers_to
FROM p LEFT JOIN f USING (digest)"""


def tokenizer_path(name: str) -> str:
    """A vocabulary file of the installed public tokenizers."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


@query
def op3_wavelet_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wavelet.round_trip(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


@query
def op4_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op7_vantage_point_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vptree.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


@query
def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


SQL["op8_license_scan"] = license_scan.twin_sql()


@query
def op9_simhash_covering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


@query
def op6_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), max_ratio=2.0)


SQL["op6_temperature_mixing"] = mixing.twin_sql(max_ratio=2.0)


@query
def op10_uniform_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


SQL["op10_uniform_threshold"] = """
WITH e AS (SELECT row_number() OVER () AS r, vec_id,
             list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
           WHERE embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.r, q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score,
        row_number() OVER (PARTITION BY q.r ORDER BY list_dot_product(q.v, c.v) DESC, c.vec_id NULLS LAST, c.r) AS rank
      FROM e q JOIN e c ON q.r <> c.r AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0)
SELECT query_id, rank::INT AS rank, vec_id, score FROM s WHERE rank <= 5"""


@query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit(table(spark, sf_dir, "documents"))


SQL["op13_merkle_manifest"] = merkle.twin_sql()


@query
def op11_dual_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dualtree.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


SQL["op11_dual_tree_search"] = dualtree.twin_sql()


@query
def op12_host_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hostpaths.extract(table(spark, sf_dir, "pages"))
