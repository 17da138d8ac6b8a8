"""Queries of the numbered operators over the given tables, and the SQL that gives the same rows."""

from __future__ import annotations

import sys
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labtables.llm import (
    lexical,
    license_scan,
    neardup,
    packing,
    perplexity,
    quality,
    resampling,
    tokens,
    topk,
    toxicity,
    url_filters,
    vector_dedup,
    viterbi,
)
from labtables.llm.common import held_out

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# the Python functions of the operators travel with the job; executors need not have this package
cloudpickle.register_pickle_by_value(sys.modules["labtables.llm"])


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_quality")
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@query("op2_minhash")
def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), percent=85, bands=40, rows=6)


@query("op3_packing")
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack_documents(
        table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), public_tokenizers.PATTERN
    )


@query("op4_sentencepiece")
def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return viterbi.round_trip(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


@query("op5_token_counts")
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


COSINE_SQL = """
WITH RECURSIVE v AS (
    SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
u AS (SELECT vec_id, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS norm FROM v),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id
    WHERE a.norm > 0 AND b.norm > 0 AND list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.95),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings
          UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
parts AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY 1),
counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY 1)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM parts LEFT JOIN counts USING (vec_id)
"""

TOPK_SQL = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


@query("op6_cosine_dedup", COSINE_SQL)
def op6_cosine_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


@query("op7_topk", TOPK_SQL)
def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@query("op8_toxicity")
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@query("op9_url_filters", url_filters.oracle())
def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge_urls(table(spark, sf_dir, "pages"))


@query("op10_license_scan", license_scan.oracle())
def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents")).drop("blocks")


@query("op11_quality_rules")
def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perplexity.quality_rules(table(spark, sf_dir, "documents"))


@query("op12_ranked_search", lexical.oracle())
def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op13_resampling", resampling.oracle())
def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
