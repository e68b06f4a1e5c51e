"""A table with one row per key, written by any number of writers.

Plain Parquet folders: _writer=W/_bucket=B/_batch=N.  A batch is one dynamic
partition overwrite that touches nothing but its own folders, so a batch that is
replayed after a failure replaces itself, and writers neither wait for nor
overwrite each other.  Every row carries its writer and batch; of a key's rows the
last by the table's order stands, wherever and in whatever sequence they were
written.  That makes a row that is there twice harmless, and so compaction can
write what it has merged before it deletes what it has read.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Buckets of keys; a table keeps the number that it was made with.
BUCKETS = 64
#: Folders of a bucket before compaction gathers them.
COMPACT_AT = 8


class KeyedTable:
    """key: a column; order: columns, the last row of a key by them stands (then by batch and writer).

    Rows without a key are left out.  Columns whose names begin with an underscore are the table's own.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, key: str, order: Sequence[str], buckets: int = BUCKETS):
        if not order:
            raise ValueError("without an order the row that stands for a key would be arbitrary")
        self.spark, self.path, self.schema, self.key, self.order, self.buckets = spark, path.rstrip("/"), schema, key, tuple(order), buckets
        self.columns = [f.split()[0] for f in re.split(r",\s*(?![^<(]*[>)])", schema)]
        self._stored = f"{schema}, _origin string, _turn bigint"

    def _at(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(name)
        return path, path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())

    def _latest(self, rows: DataFrame) -> DataFrame:
        order = [*(F.col(c).desc_nulls_last() for c in self.order), F.desc("_turn"), F.desc("_origin")]
        w = Window.partitionBy("_bucket", self.key).orderBy(*order)
        return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")

    def _write(self, rows: DataFrame, writer: str) -> None:
        """rows have been dealt by bucket, so each bucket gets one file."""
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_bucket", "_batch").parquet(f"{self.path}/_writer={writer}")

    def upsert(self, rows: DataFrame, writer: str, batch: int) -> None:
        """Put in a batch of a writer; the same batch again replaces itself.  A writer's batches come one after another."""
        if not re.fullmatch(r"[A-Za-z0-9.-]+", writer):
            raise ValueError(f"{writer!r} is no name of a folder")
        bucket: Column = F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")
        marked = rows.select(*self.columns).where(F.col(self.key).isNotNull()).withColumns({"_bucket": bucket, "_origin": F.lit(writer), "_turn": F.lit(batch).cast("bigint")})
        self._write(self._latest(marked.repartition(self.buckets, "_bucket")).withColumn("_batch", F.lit(batch).cast("bigint")), writer)

    def folders(self) -> dict[int, list[str]]:
        """The folders of each bucket."""
        root, fs = self._at(f"{self.path}/_writer=*/_bucket=*/_batch=*")
        found: dict[int, list[str]] = {}
        for status in fs.globStatus(root) or ():
            name = status.getPath().toString()
            found.setdefault(int(re.search(r"/_bucket=(\d+)/", name)[1]), []).append(name)
        return found

    def _rows(self, folders: Sequence[str] = ()) -> DataFrame:
        """Stored rows: of some folders, or all."""
        reader = self.spark.read.schema(f"{self._stored}, _writer string, _bucket int, _batch bigint").option("basePath", self.path)
        return reader.parquet(*(folders or [self.path]))

    def read(self) -> DataFrame:
        """One row per key.  A reader that met a folder which compaction deletes meanwhile fails and reads again."""
        root, fs = self._at(self.path)
        if not fs.exists(root):
            return self.spark.createDataFrame([], self.schema)
        return self._latest(self._rows()).select(*self.columns)

    def compact(self, least: int = COMPACT_AT) -> list[int]:
        """Gather the buckets of `least` folders or more into one each; which they were.

        What was merged is written first, then what was read is deleted; between the two, and after a failure there,
        rows are stored twice and read once.  Rows keep the writer and batch that they came with.
        """
        due = {b: names for b, names in self.folders().items() if len(names) >= least}
        if due:
            read = [name for names in due.values() for name in names]
            merged = self._latest(self._rows(read).drop("_writer", "_batch").repartition(min(len(due), self.buckets), "_bucket"))
            self._write(merged.withColumn("_batch", F.lit(0).cast("bigint")), f"base-{uuid.uuid4().hex}")
            for name in read:
                path, fs = self._at(name)
                fs.delete(path, True)
        return sorted(due)
