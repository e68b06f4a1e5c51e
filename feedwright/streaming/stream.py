"""Micro-batches: new articles into the bronze table, once each.

A batch is written before its state advances, and the table is keyed by URL, so
a batch that is replayed after a failure changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from feedwright.functions.text import normalize_link
from feedwright.sources.keyed import KeyedTable
from feedwright.sources.sinks import retried

POLL = "600 seconds"


def upsert_batches(stream: DataFrame, table: KeyedTable, writer: str, checkpoint: str, once: bool = True, after: Callable[[DataFrame, int], None] | None = None) -> StreamingQuery:
    """Upsert each micro-batch into a keyed table; empty batches write nothing.  after(batch, id) advances other state.

    `writer` names the stream, as its checkpoint does: the batch's number is part of what it writes, so a replayed
    batch replaces itself.  Streams of other names may write to the same table meanwhile.  A write that fails is
    tried again; buckets of many folders are gathered now and then."""

    def write(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        retried(lambda: table.upsert(batch, writer, batch_id))
        table.compact()
        if after is not None:
            after(batch, batch_id)

    started = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (started.trigger(availableNow=True) if once else started.trigger(processingTime=POLL)).start()


def first_seen(stream: DataFrame, link: str, at: str, lateness: str = "7 days") -> DataFrame:
    """Rows whose normalised link wasn't seen within the watermark: bounded state."""
    return stream.withColumn("norm", normalize_link(F.col(link))).withWatermark(at, lateness).dropDuplicatesWithinWatermark(["norm"])


def windowed_counts(stream: DataFrame, at: str, key: str, every: str = "1 hour", lateness: str = "2 hours") -> DataFrame:
    """Articles per outlet and window, late rows within the watermark counted."""
    return stream.withWatermark(at, lateness).groupBy(F.window(at, every), key).count()


def run_once(spark: SparkSession, query: StreamingQuery) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
