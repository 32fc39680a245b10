"""The operators as registered queries, over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from counterfoil.llm import (
    bpe,
    centroids,
    chat,
    exact_dedup,
    licenses,
    near_dedup,
    packing,
    quality,
    secrets,
    sharding,
    suffixes,
    token_files,
    vector_codes,
)
from counterfoil.llm.common import table
from counterfoil.llm.oracle import ORACLES  # noqa: F401

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    trusted = quality.trusted_ids(table(spark, folder, "labels"))
    docs = table(spark, folder, "documents")
    return quality.judged(docs, trusted, keep=["doc_id"]).select(
        "doc_id",
        "q_base.*",
        F.col("q_failed").alias("base_failed"),
        F.col("q_kept").alias("kept"),
        (F.col("q_ratio") / F.nullif("q_grams", F.lit(0)) / 1e6).alias("mean_log_ratio"),
    )


def op2_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations and conversation -7, by turn rows, formatted and read back."""
    told = "\\### Assistant: </turn> ok"
    own = "conv_id long, turn long, role string, text string"
    extra = spark.createDataFrame([(-7, 0, "user", told), (-7, 1, "assistant", told)], own)
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    rows = rows.unionByName(extra).select(
        "conv_id",
        F.to_json(
            F.struct("conv_id", "turn", "role", "text"), {"ignoreNullFields": "false"}
        ).alias("record"),
    )
    return chat.chat_digests(chat.formatted_chats(chat.canonical_turns(rows)))


def op3_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return bpe.round_trip_digests(table(spark, folder, "documents"), path)


def op4_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, folder, "documents"))
    return found.select(
        "doc_id",
        *(secrets.count_of("base", kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")),
        F.sha2(secrets.joined("base"), 256).alias("base_sha256"),
        secrets.joined("spans").alias("spans"),
    )


def op5_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.repeated_passages(table(spark, folder, "documents"))


def op6_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, folder, "documents"), keep="largest")


def op7_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return token_files.token_files(spark, table(spark, folder, "documents"), path, end_id=2)


def op8_license_scans(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses.scanned(table(spark, folder, "documents"), wrapped=True)
    places = F.concat(*(F.col(f"l_places.{label}") for label in licenses.PHRASES))
    base = F.array_compact(
        F.array(
            *(
                F.when(F.size(f"l_places.{label}") > 0, F.lit(label))
                for label in licenses.PHRASES
            )
        )
    )
    found = found.select("doc_id", "l_n_words", "l_hits", places.alias("places"), base.alias("base"))
    labels = F.array_union("base", F.transform("l_hits", lambda h: h["label"]))
    return found.select(
        "doc_id",
        F.col("l_n_words").alias("n_words"),
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places").cast("long").alias("first_word"),
        F.array_max("places").cast("long").alias("last_word"),
        F.array_join(F.sort_array("base"), ",").alias("base_labels"),
        F.array_join(F.sort_array(labels), ",").alias("labels"),
        F.coalesce(F.array_max(F.transform("l_hits", lambda h: h["score"])), F.lit(0.0)).alias(
            "score"
        ),
    )


def op9_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.packed(table(spark, folder, "documents"), path, end_id=1)


def op10_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_classes(table(spark, folder, "documents"))


def op11_sharding(spark: SparkSession, folder: str) -> DataFrame:
    placed = sharding.sharded(table(spark, folder, "documents"), columns=[])
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op12_centroid_clustering(spark: SparkSession, folder: str) -> DataFrame:
    found = centroids.clustered(table(spark, folder, "embeddings"))
    return found.select(
        "vec_id",
        "cluster",
        "distance",
        "cluster_inertia",
        "inertia",
        centroids.components_sha256("centroid").alias("centroid_sha256"),
    )


def op13_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    found, books = vector_codes.compressed(table(spark, folder, "embeddings"))
    digest = None if books is None else centroids.joined_sha256(books)
    return found.select(
        "vec_id", "code", "error", "label_error", F.lit(digest).cast("string").alias("codebooks_sha256")
    )


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_quality_rules,
        op2_chat_formatting,
        op3_bpe_round_trip,
        op4_secret_scans,
        op5_suffix_dedup,
        op6_exact_dedup,
        op7_token_files,
        op8_license_scans,
        op9_best_fit_packing,
        op10_near_dedup,
        op11_sharding,
        op12_centroid_clustering,
        op13_vector_codes,
    )
}
