"""Labelled rows to learn from: a bounded sample, never the held-out fifth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that no model learns from: crc32 of doc_id as text is divisible by 5. A NULL doc_id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, label: str, per_class: dict[int, int]) -> DataFrame:
    """doc_id, text and y of labelled rows that may be learned from, at most ``per_class`` of each label.

    Rows are taken in the order of a hash of doc_id. Of several labels of a doc_id the largest counts, of several texts the
    first in order, so that a doc_id which many rows repeat is one row here.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out())
    known = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    picked = None
    for y, most in per_class.items():
        some = known.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        picked = some if picked is None else picked.unionByName(some)
    # at most the sum of per_class rows
    found = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    return found.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("y").alias("y"))
