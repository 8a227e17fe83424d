"""Bounded labelled samples for fitting.

Every model here is fitted on at most ``limit`` labelled rows, those with the
least hash of their doc_id, so that a fit costs the same at any size. The bound
is a parameter of each operator. Repeated or contradictory labels of a document
count once, with the greatest value; null ids and labels are no labels. Of
documents that repeat a doc_id one is fitted on, that with the least hash of its
text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Labelled rows that a fit reads at most.
LIMIT = 20_000


def bounded_labels(labels: DataFrame, column: str, limit: int = LIMIT) -> DataFrame:
    """``label_id, label``: at most ``limit`` rows, safe to broadcast. Of more, a
    threshold on the hash lets through about as many before they are sorted."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(column).isNotNull())
    one = known.groupBy(F.col("doc_id").alias("label_id")).agg(F.max(column).cast("int").alias("label"))
    n = one.count()
    if n > limit:
        reach = int((1 << 62) * 0.98 * limit / n)
        one = one.where(F.xxhash64("label_id").bitwiseAND(F.lit((1 << 62) - 1)) <= reach)
    return one.orderBy(F.xxhash64("label_id").bitwiseAND(F.lit((1 << 62) - 1)), "label_id").limit(limit)


def with_label(docs: DataFrame, labels: DataFrame, column: str, limit: int = LIMIT) -> DataFrame:
    """``doc_id, text, label`` of docs; the sample is bounded and so is broadcast."""
    sample = bounded_labels(labels, column, limit)
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    return texts.join(F.broadcast(sample), texts.doc_id == sample.label_id, "left").drop("label_id")


def labelled_texts(docs: DataFrame, labels: DataFrame, column: str, limit: int = LIMIT) -> DataFrame:
    """``doc_id, text, label`` of the sample itself: one row for each label at most."""
    met = with_label(docs, labels, column, limit).where("label is not null")
    return met.groupBy("doc_id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text")).select("doc_id", "text", "label")
