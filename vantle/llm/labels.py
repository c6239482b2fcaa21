"""Labelled training rows for the scorers: never from the held-out fifth, never more than a stated number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import texts_of

#: Labelled rows that a scorer learns from at most: the bound of what reaches the driver.
MAX_LABELLED = 12_000


def held_out(doc_id: str = "doc_id") -> Column:
    """The fifth of the documents whose labels no scorer may see."""
    return F.crc32(F.col(doc_id).cast("long").cast("string").cast("binary")) % 5 == 0


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str, most: int = MAX_LABELLED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, label 0/1) of at most ``most`` labelled documents outside the held-out fifth.

    They are the first by a hash of doc_id, so the choice has nothing to do with
    order, source or text. Repeated label rows count once, with the larger label;
    of repeated documents the least text counts.
    """
    given = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    given = given.filter(F.col("doc_id").isNotNull() & F.col("label").isNotNull()).filter(~F.coalesce(held_out(), F.lit(True)))
    chosen = given.groupBy("doc_id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    rows = texts_of(docs, id_col, text_col).join(F.broadcast(chosen), "doc_id")  # ``most`` bounds the broadcast
    return rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("label").alias("label"))
