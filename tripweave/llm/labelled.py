"""Bounded samples of labelled documents for the classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.llm.columns import pick


def remainder(folds: int):
    """crc32(doc_id as text) mod ``folds``; null for a null id."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(folds)).cast("int")


def training_rows(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, most: int) -> DataFrame:
    """(text, label, part) of at most ``most`` labelled documents outside the held-out fold.

    The sample is the ids of ``labels`` with the least hashes, a documented bound; ``part`` in [0, 10) is
    drawn by another hash.  Null ids and null labels do not take part, nor do ids that are labelled both ways.
    An id that is repeated in ``labels`` counts once, and of several documents of one id the text with the least
    hash is taken, so there are never more rows than ids.  Only the bounded list of ids is broadcast to the documents.
    """
    known = F.col("doc_id").isNotNull() & F.col(label).isNotNull() & (remainder(folds) != held_out)
    value = F.col(label).cast("int")
    ids = (
        pick(labels, "doc_id", label)
        .where(known)
        .groupBy("doc_id")
        .agg(F.min(value).alias("label"), F.max(value).alias("other"))
        .where(F.col("label") == F.col("other"))
        .drop("other")
        .orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id")
        .limit(most)
    )
    part = F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(10)).cast("int").alias("part")
    # Repeats of an id are reduced in each task before they are shuffled.
    one = F.min_by(F.struct("text"), F.xxhash64("text")).alias("one")
    rows = pick(docs, "doc_id", "text").join(F.broadcast(ids), "doc_id").groupBy("doc_id", "label").agg(one)
    return rows.select("one.text", "label", part)
