"""Sinks: merged archives, upserts of frames, run audit.  Tables with one row per key are in keyed.py."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from typing import TypeVar

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from feedwright.functions.text import normalize_link
from feedwright.storage import discard, materialize

ARCHIVE_LIMIT = 2000
#: Times a write is tried.
ATTEMPTS = 3

T = TypeVar("T")


def retried(action: Callable[[], T], attempts: int = ATTEMPTS, sleep: Callable[[float], None] = time.sleep) -> T:
    """action(), again after 2, 4, ... seconds if it fails; the last failure is raised."""
    for attempt in range(1, attempts + 1):
        try:
            return action()
        except Exception:  # noqa: BLE001  whatever a store raises may pass
            if attempt == attempts:
                raise
            sleep(2**attempt)
    raise AssertionError("unreachable")


def last_by_key(new: DataFrame, key: str, order: Sequence[Column | str]) -> DataFrame:
    """Of each key the last row by `order`."""
    if not order:
        raise ValueError("without an order the row that stands for a key would be arbitrary")
    w = Window.partitionBy(key).orderBy(*[F.desc(o) if isinstance(o, str) else o for o in order])
    return new.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def upserted(current: DataFrame, new: DataFrame, key: str, order: Sequence[Column | str]) -> DataFrame:
    """current with the rows of new in place of those of the same key; of equal keys in new the last by `order` wins.

    Old rows are only anti-joined: the wide history isn't sorted."""
    last = last_by_key(new, key, order)
    return current.join(last.select(key), key, "left_anti").select(*current.columns).unionByName(last.select(*current.columns))


def merged_archive(new: DataFrame, old: DataFrame, keys: Sequence[str] = (), limit: int = ARCHIVE_LIMIT) -> DataFrame:
    """New rows first, then old rows whose normalised link isn't among the new; the first `limit` per key.

    Both have link and pos; new rows aren't compared with each other."""
    norm = lambda df, batch: df.withColumn("_norm", normalize_link(F.col("link"))).withColumn("_batch", F.lit(batch))
    fresh, rest = norm(new, 0), norm(old, 1)
    rest = rest.join(fresh.select(*keys, "_norm").distinct(), [*keys, "_norm"], "left_anti").select(*fresh.columns)
    every = fresh.unionByName(rest)
    if not keys:  # one list: only its first rows are numbered
        every = every.orderBy("_batch", "pos").limit(limit)
    w = Window.partitionBy(*keys).orderBy("_batch", "pos")
    return every.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= limit).withColumn("pos", F.col("_n") - 1).drop("_n", "_norm", "_batch")


RUNS = ("id string, run_type string, status string, started_at timestamp, finished_at timestamp, articles_in int, articles_out int, "
        "error_message string, github_run_id string, metadata string")


def archive_checkpoint(archive: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, link, title): what a merged archive makes the checkpoint, its first row."""
    first = F.min_by(F.struct("link", "title"), "pos")
    return (archive.groupBy(*keys) if keys else archive.groupBy()).agg(first.alias("v")).where("v IS NOT NULL").select(*keys, "v.*")


#: Defaults of a run (fixed values).
RUN_DEFAULTS = {"run_type": "scrape", "status": "running", "articles_in": 0, "articles_out": 0, "metadata": "{}"}


def with_run_defaults(rows: DataFrame, now: Column) -> DataFrame:
    """Rows of runs with what is missing, a column or a value, at its default."""
    out = rows
    for field in RUNS.split(", "):
        name, kind = field.split()
        value = F.col(name).cast(kind) if name in rows.columns else F.lit(None).cast(kind)
        default = now if name == "started_at" else F.lit(RUN_DEFAULTS.get(name)).cast(kind)
        out = out.withColumn(name, F.coalesce(value, default))
    return out.select(*[f.split()[0] for f in RUNS.split(", ")])


def with_runs(articles: DataFrame, runs: DataFrame) -> DataFrame:
    """articles with the status and times of the run that wrote them; null for rows of no run."""
    side = runs.select(F.col("id").alias("scrape_run_id"), F.col("status").alias("run_status"), F.col("started_at").alias("run_started_at"), F.col("finished_at").alias("run_finished_at"))
    return articles.join(side, "scrape_run_id", "left")


def open_run(spark: SparkSession, run_id: str, started_at: Column, run_type: str = "scrape") -> DataFrame:
    return spark.range(1).select(
        F.lit(run_id).alias("id"), F.lit(run_type).alias("run_type"), F.lit("running").alias("status"), started_at.alias("started_at"),
        F.lit(None).cast("timestamp").alias("finished_at"), F.lit(0).alias("articles_in"), F.lit(0).alias("articles_out"),
        F.lit(None).cast("string").alias("error_message"), F.lit(None).cast("string").alias("github_run_id"), F.lit("{}").alias("metadata"))


def close_run(run: DataFrame, finished_at: Column, articles_in: int, articles_out: int, error: str | None = None) -> DataFrame:
    """Closed as succeeded or, with an error, as failed."""
    return run.withColumns({"status": F.lit("failed" if error else "success"), "finished_at": finished_at, "articles_in": F.lit(articles_in),
                            "articles_out": F.lit(articles_out), "error_message": F.lit(error).cast("string")})


def written_and_counted(articles: DataFrame, to_bronze: Callable[[DataFrame], DataFrame], write: Callable[[DataFrame], None]) -> tuple[int, int]:
    """Write to_bronze(articles) and tell how many articles were read and rows written: both are counted by the
    write's own job, as rows pass.

    A task that is run again may pass its rows again before the count is taken; Spark then counts those of
    the attempt that succeeded.  to_bronze must read every article (no limit)."""
    read, made = Observation(), Observation()
    write(to_bronze(articles.observe(read, F.count(F.lit(1)).alias("n"))).observe(made, F.count(F.lit(1)).alias("n")))
    return read.get["n"], made.get["n"]


def audit_counts(articles: DataFrame, to_bronze: Callable[[DataFrame], DataFrame]) -> tuple[int, int]:
    """A dry run: rows read and rows that would be written, in one job that writes nothing."""
    return written_and_counted(articles, to_bronze, lambda rows: rows.write.format("noop").mode("overwrite").save())


def _at(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows under a path, none before the first write."""
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    there = root.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(root)
    return spark.read.schema(schema).parquet(path) if there else spark.createDataFrame([], schema)


def write_delta_and_archive(batch: DataFrame, path: str, outlet: str = "outlet_id", limit: int = ARCHIVE_LIMIT) -> None:
    """Two targets of one batch (outlet, pos, link, ...), path/archive and path/delta: an outlet's delta is exactly its
    part of the last batch that had one, its archive that part before what the archive held, `limit` rows at most.

    Only the folders of the batch's outlets are read and replaced.  The merged archive is written aside first, so
    nothing is read while it is replaced.  An outlet has one writer at a time."""
    spark = batch.sparkSession
    schema = StructType([f for f in batch.schema if f.name != outlet] + [batch.schema[outlet]])
    old = _at(spark, f"{path}/archive", schema).join(batch.select(outlet).distinct(), outlet, "left_semi")
    merged = materialize(merged_archive(batch.select(*schema.names), old.select(*schema.names), [outlet], limit), "archive")
    for rows, target in ((merged, "archive"), (batch, "delta")):
        dealt = rows.repartition(outlet)
        dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(outlet).parquet(f"{path}/{target}")
    discard(merged)
