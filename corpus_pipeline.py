"""Corpus preparation: documents lose toxic ones, near copies, benchmark passages and secrets, and become token ids."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tripweave.llm import bpe, decontamination, near_duplicates, secrets, toxicity
from tripweave.llm.columns import read
from tripweave.session import fresh_folder, small_batches
from tripweave.sources.tables import read_table, write_table


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go."""
    return toxicity.remove_toxic(docs, read(spark, sf_dir, "labels"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the least doc_id."""
    return near_duplicates.remove_near_duplicates(docs)


def contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark windows are a twentieth or more go."""
    return decontamination.remove_contaminated(docs, read(spark, sf_dir, "benchmark"))


def secret(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are replaced by a mark, and ``n_chars`` follows."""
    return secrets.redact(docs, length="n_chars")


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, n_tokens, ids_sha256, decoded_sha256) of every document that is left."""
    return bpe.encode_texts(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", toxic),
    ("near_duplicates", near_copies),
    ("decontamination", contaminated),
    ("secrets", secret),
    ("encoding", encoded),
]

# Models and byte-level encoding cannot be said in SQL; tests/llm checks each stage by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over ``documents``; each is written below the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = _stored(spark, stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


def _stored(spark: SparkSession, docs: DataFrame, name: str) -> DataFrame:
    folder = fresh_folder(spark, f"stage-{name}")
    with small_batches(spark):
        write_table(docs, folder)
    return read_table(spark, folder, docs.schema)
