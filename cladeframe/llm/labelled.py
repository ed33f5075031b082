"""Bounded samples of labelled rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS, HELD_OUT = 5, 0


def fold(doc_id: str | Column = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary") if isinstance(doc_id, str) else doc_id.cast("string").cast("binary")) % FOLDS


def sample(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """(doc_id, text, y) of at most `most` labelled documents outside the held-out fold: those with the smallest hash of
    their id. Labels that are null are left out; of several for one id the largest counts. The sample is bounded, and so
    is the table of it that goes to all tasks."""
    chosen = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).alias("y")).where(F.col("y").isNotNull() & F.col("doc_id").isNotNull())
    chosen = chosen.where(fold() != HELD_OUT).groupBy("doc_id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
