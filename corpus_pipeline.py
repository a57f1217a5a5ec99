"""The corpus pipeline: quality rules, near-duplicates, secrets, source mix, tokens.

Every stage takes all that the one before kept.  ``run`` writes each stage's rows to the folder that
the cluster shares (``spark.checkpoint.dir``) and reads them back, so a lost executor costs at most one
stage.  The stages up to the mix keep the columns of ``documents``; the last gives doc_id, source,
n_tokens, the digests of ids and decoded text, and the token ids.

Defined cases: nulls, empty and very long texts, ties, repeated rows, empty tables and extra columns are
treated as each stage's operator says; extra columns go along until the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm import bpe, mixing, quality_rules, secret_scan, simhash
from ledgerloom.llm.common import prepare, run_folder, table
from ledgerloom.llm.queries import TOKENIZER


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality rules reject."""
    prepare(spark)
    return quality_rules.keep_good(docs)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each near-duplicate group."""
    prepare(spark)
    return simhash.one_of_each_group(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets in the texts."""
    prepare(spark)
    return secret_scan.redact_secrets(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes documents, some of them twice, towards each source's target."""
    prepare(spark)
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encodes the texts."""
    prepare(spark)
    return bpe.bpe_tokens(docs, TOKENIZER, carry=("source",), with_ids=True)


STAGES = [("quality rules", quality), ("SimHash near-dedup", dedup), ("secret scans", secrets),
          ("source mix", mix), ("BPE encoding", tokens)]

#: Compression, fingerprints, guess costs and merges are beyond SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, folder = table(spark, sf_dir, "documents"), run_folder(spark, "corpus-pipeline")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
