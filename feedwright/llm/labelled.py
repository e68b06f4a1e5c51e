"""Labelled documents for the two classifiers, all or a bounded sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedwright.llm.bloom import where_in
from feedwright.llm.common import materialize


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo folds; null ids have no fold."""
    return F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(folds)).cast("int")


def _clean(labels: DataFrame, label: str, learnable: Column) -> DataFrame:
    """(doc_id, y) of ids with one label that may be learnt from."""
    return (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
        .where(F.col("y").isin(0, 1) & F.col("doc_id").isNotNull() & learnable)
        .groupBy("doc_id").agg(F.max("y").alias("y"), F.min("y").alias("least")).where("y = least").drop("least")
    )


def maybe_labelled(docs: DataFrame, labels: DataFrame, label: str, learnable: Column) -> tuple[DataFrame, DataFrame]:
    """(doc_id, text) of all labelled documents and a few others, and the labels (doc_id, y), an id once, under the rules of
    labelled_sample(); to be joined by what is made of the texts, so that no text travels."""
    clean = _clean(labels, label, learnable)
    may = where_in(docs.where("doc_id IS NOT NULL").withColumn("_h", F.xxhash64("doc_id")), clean.select(F.xxhash64("doc_id").alias("key")), "_h")
    return may.select("doc_id", "text"), clean


def labelled_documents(docs: DataFrame, labels: DataFrame, label: str, learnable: Column) -> DataFrame:
    """(doc_id, text, y) of all labelled documents, under the rules of labelled_sample(); only texts whose ids may be labelled travel."""
    may, clean = maybe_labelled(docs, labels, label, learnable)
    return may.join(clean, "doc_id").select("doc_id", "text", "y")


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learnable: Column, bound: int) -> DataFrame:
    """(doc_id, text, y) of labelled documents, chosen by a hash of the id so that about `bound` ids are.

    docs: (doc_id, text); labels: doc_id and `label`, 0 or 1.  Rows without a
    label, rows that aren't learnable and documents that are labelled both ways
    are left out; a label that is repeated counts once.
    """
    clean = _clean(labels, label, learnable)
    n = clean.count()
    rate = min(1.0, bound / max(n, 1))
    chosen = clean.where(F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 30)) < int(rate * (1 << 30)))
    # At most about `bound` rows of 12 bytes: a bounded broadcast.
    return materialize(docs.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "y"), "sample")
