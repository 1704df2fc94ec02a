"""The registered queries of the text operators, with SQL where SQL can say the same."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gamestate.llm import bpe, divergence, embeddings, fingerprints, language, licenses, lm, minhash, packing, pii, search, sharding, token_counts
from gamestate.llm.common import shared_dir, table

#: The key of the registered query, known to all. A user of the operator passes a secret one.
PUBLIC_KEY = b"documented key of the registered query"

Query = Callable[[SparkSession, str], DataFrame]


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(table(spark, sf_dir, "embeddings"), 0.9)


def op3_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))


def op4_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), 2048)


def op6_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    masked = pii.mask(table(spark, sf_dir, "documents"), PUBLIC_KEY)

    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    kinds = [number(k) for k, _, _ in pii.KINDS]
    return masked.select("doc_id", "text", "spans", F.size("spans").cast("long").alias("n_found"), *kinds)


def op7_minmax_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_groups(table(spark, sf_dir, "documents"), width=3, percent=85)


def op8_slot_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the map of each table stays in the shared folder, where later runs find and edit it
    path = f"{shared_dir(spark)}/slot-maps/documents-40-{hashlib.sha256(sf_dir.encode()).hexdigest()[:16]}"
    return sharding.shard_documents(table(spark, sf_dir, "documents"), path, 40)


def op9_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), 2048)


def conversation_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packing operator where its three limits differ: whole conversations with loss on what the assistant says."""
    return packing.pack_conversations(table(spark, sf_dir, "conversations"), public_tokenizers.path("byte_bpe_50k.json"))


def op10_language_fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify_pages(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


def op11_ngram_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(table(spark, sf_dir, "documents"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.ranked_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 50)


def queries() -> dict[str, Query]:
    every = (
        op1_license_scan,
        op2_embedding_near_dedup,
        op3_document_fingerprints,
        op4_bpe_round_trip,
        op5_token_counts,
        op6_pii_pseudonyms,
        op7_minmax_near_dedup,
        op8_slot_sharding,
        op9_vector_packing,
        op10_language_fusion,
        op11_ngram_score,
        op12_source_divergence,
        op13_ranked_search,
        conversation_packing,
    )
    return {f.__name__: f for f in every}


def oracle_sql() -> dict[str, str]:
    return {"op1_license_scan": licenses.oracle(), "op12_source_divergence": divergence.oracle(), "op13_ranked_search": search.oracle()}
