"""From raw documents to token ids: each stage works on all that the one before it kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterloom.llm import bpe, jaccard, mixing, secret_scan, toxicity
from meterloom.llm.common import broadcast_if_small, documents_like, read, stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain does not reject."""
    scored = toxicity.toxicity(docs, read(spark, sf_dir, "labels"))
    return documents_like(scored.filter("NOT is_toxic"), docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id. Rows without
    an id, and documents without words, stay. Rows that share an id stay or go together."""
    groups = jaccard.jaccard_groups(docs)
    dropped = stage(
        groups.filter("component_id <> doc_id").select(F.col("doc_id").alias("_gone")).distinct(), "pipeline-dropped"
    )
    kept = docs.join(broadcast_if_small(dropped), F.col("doc_id") == F.col("_gone"), "left_anti")
    return documents_like(kept, docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets that the forest confirms replaced in their texts."""
    return documents_like(secret_scan.redact(docs, stage(secret_scan.scan(docs), "pipeline-secrets")), docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them: every one at least once, the smaller
    sources up to half as often again."""
    return documents_like(mixing.mix(docs, repetition=1.5), docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mixture, and the digest of their decoded bytes."""
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    done = bpe.round_trip(docs, ranks, public_tokenizers.PATTERN, keep_ids=True)
    return done.select("doc_id", "n_tokens", "ids", "decoded_sha256")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
    ("tokens", tokenize),
]

#: Trained models, iteration and tokenizer merges have no SQL form; tests/llm compares the
#: stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
