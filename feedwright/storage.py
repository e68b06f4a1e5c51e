"""Tables in the folder that all executors share."""

from __future__ import annotations

import itertools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that every executor sees; a local one only where none is set, as in tests."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        context = spark.sparkContext
        root = context.getCheckpointDir()
        if not root:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            root = tempfile.mkdtemp(prefix="feedwright-")
            context.setCheckpointDir(root)
    return root.rstrip("/")


#: Tables written between two collections of the driver's garbage.
COLLECT_EVERY = 8
_written = itertools.count(1)


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends here and a
    lost executor costs only the tasks that read its files again.

    Spark lets go of broadcasts and shuffle files of finished rounds when the
    driver's garbage is collected, so that is asked for now and then."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/feedwright/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if next(_written) % COLLECT_EVERY == 0:
        spark._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files behind a table that materialize() returned."""
    spark = df.sparkSession
    jvm = spark._jvm
    for name in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
