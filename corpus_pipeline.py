"""Corpus pipeline over documents: language ID, near-dedup, pseudonyms for personal data, packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gamestate.llm import language, minhash, packing, pii
from gamestate.llm.common import discard, materialize, table

#: The key of the pseudonyms where the session names none in spark.gamestate.pseudonymKey. It is known to all: set your own.
KEY = b"documented key of the registered pipeline"

#: SQL can't express the stages; tests/llm holds them against brute force.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found stay; texts without letters or in a language that no label names go."""
    return language.identify_documents(docs).where("accepted").select(*[f"`{c}`" for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the smallest doc_id. Rows without an id stay.

    Texts that share a doc_id are judged one by one; of rows that repeat id and text one stays.
    """
    return minhash.kept_rows(docs, width=5, percent=80).select(*[f"`{c}`" for c in docs.columns])


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and secrets in the texts give way to pseudonyms of the same length."""
    key = spark.conf.get("spark.gamestate.pseudonymKey", None)
    return pii.mask(docs, key.encode() if key else KEY).select(*[F.col(f"`{c}`") for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 2048 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), 2048)


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("pii", pseudonyms), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces that the last stage makes of documents. A stage's table is removed once the next one is written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        done = materialize(stage(spark, docs, sf_dir), name)
        discard(docs)
        docs = done
    return STAGES[-1][1](spark, docs, sf_dir)
