"""Shared plumbing of the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedwright.storage import discard, materialize, shared_dir

__all__ = ["SLICE_BYTES", "SMALL_SLICE_BYTES", "bounded_batches", "discard", "materialize", "own_key", "shared_dir", "table", "text_slices"]

#: Text bytes that a Python worker hashes at once; bounds its memory.
SLICE_BYTES = 2_000_000
#: The same where many numbers are made of each byte.
SMALL_SLICE_BYTES = 500_000
#: Bytes of an Arrow batch between Spark and a Python worker; either side holds some of them.
BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(df: DataFrame) -> DataFrame:
    """df, in a session that cuts Arrow batches by bytes: 10000 long rows are many.  The setting stays, as results are lazy."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df


def own_key(doc_id: str, text: str) -> Column:
    """A hash of a row's id and text: rows that share an id are told apart by it."""
    return F.xxhash64(F.coalesce(doc_id, F.lit(-1).cast("long")), F.col(doc_id).isNull(), text)


def text_slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each holds at most `limit` bytes of text, or one row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
        begin = total = 0
        for i, size in enumerate(sizes):
            if total and total + size > limit:
                yield batch.slice(begin, i - begin)
                begin, total = i, 0
            total += size
        if begin < batch.num_rows:
            yield batch.slice(begin)
