"""From documents to packed sequences: quality rules, line dedup, near-dedup, secrets, packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from mediamix.llm import linededup, minhash, packing, quality, secrets
from mediamix.session import cut_lineage, release

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.accepted(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Runs of lines that occur earlier are cut out; documents of which nothing is left go."""
    return linededup.deduped(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return minhash.first_of_each_group(docs, percent=80)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by their kind."""
    return secrets.redact(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents with their sequence and offset."""
    return packing.pack_documents(docs, VOCABULARY)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("secret_scans", secret_scans),
    ("best_fit_packing", best_fit_packing),
]

#: Histogram distances, subword ids and packing are beyond SQL; tests hold the stages
#: against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written as Parquet and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        done = cut_lineage(stage(spark, docs, sf_dir))
        release(docs)  # the table that the stage before wrote
        docs = done
    return docs
