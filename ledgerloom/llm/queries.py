"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import (
    bpe,
    centroids,
    html_render,
    lang_id,
    license_scan,
    mixing,
    quality_rules,
    ranked_search,
    secret_scan,
    simhash,
    syncmers,
    topk,
    url_filter,
)
from ledgerloom.llm.common import table

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_spans(table(spark, sf_dir, "documents"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_tokens(table(spark, sf_dir, "documents"), TOKENIZER)


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_render.visible_text(table(spark, sf_dir, "pages"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_verdicts(table(spark, sf_dir, "documents"))


def op5_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    return lang_id.language_ids(table(spark, sf_dir, "documents"), held_out)


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_matches(table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.words_taken(table(spark, sf_dir, "documents"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.url_verdicts(table(spark, sf_dir, "pages"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op11_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.document_fingerprints(table(spark, sf_dir, "documents"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.centroid_clusters(table(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_secret_scan, op2_bpe, op3_html_text, op4_quality_rules, op5_top_k,
                                   op6_language_id, op7_license_scan, op8_mixing, op9_url_filter, op10_simhash,
                                   op11_syncmers, op12_ranked_search, op13_centroids, pipeline)}
ORACLE = {"op5_top_k": topk.ORACLE, "op7_license_scan": license_scan.oracle(), "op9_url_filter": url_filter.oracle(),
          "op12_ranked_search": ranked_search.ORACLE, "op13_centroids": centroids.oracle()}
