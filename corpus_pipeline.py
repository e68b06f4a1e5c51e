"""Documents to tokens: the training-data operators as one pipeline.

Each stage takes (spark, docs, sf_dir) and returns the next documents; all but
the last return the columns of documents.  Every stage works on all that its
predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from feedwright.llm.bpe import round_trip
from feedwright.llm.common import discard, materialize, table
from feedwright.llm.jaccard_join import documents_without_near_copies
from feedwright.llm.labelled import fold
from feedwright.llm.line_dedup import documents_without_repeated_lines
from feedwright.llm.mixing import mixed_documents
from feedwright.llm.queries import tokenizer_path
from feedwright.llm.toxicity import documents_without_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects go."""
    return documents_without_toxic(docs, table(spark, sf_dir, "labels"), fold("doc_id", 3) != 1)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go; every document stays."""
    return documents_without_repeated_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return documents_without_near_copies(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Small sources are repeated, up to 1.5 times; every document is used."""
    return mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of the decoded text, one row per use of a document."""
    return round_trip(docs, tokenizer_path())


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("mixing", mixing),
    ("tokens", tokens),
]

#: The classifier and the forest aren't SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
        if before is not None:
            discard(before)  # its successor is written
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
