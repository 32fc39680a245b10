"""A corpus made ready for training: rejected, deduplicated, cleaned of secrets and packed.

Every stage takes and returns whole tables; all but the last return the columns of
documents. Stages are written as Parquet and read again, so a lost executor costs a
part of one stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from counterfoil.llm import exact_dedup, near_dedup, packing, quality, secrets
from counterfoil.llm.common import table, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    trusted = quality.trusted_ids(table(spark, sf_dir, "labels"))
    return quality.passed(docs, trusted)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest doc_id stays."""
    return exact_dedup.deduplicated(docs, keep="largest")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return near_dedup.deduplicated(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; secrets in their texts are replaced by a mark."""
    return secrets.redacted(docs).withColumn("n_chars", F.length("text").cast("long"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in the training sequences."""
    return packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1)


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_copies),
    ("near_dedup", near_copies),
    ("secret_scans", secret_scans),
    ("best_fit_packing", best_fit_packing),
]

# Hashed scores, sketches and token ids are beyond SQL; tests hold the stages against
# brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
