"""Session settings and the shared scratch folder."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution sizes shuffles, turns small join sides into broadcasts by their measured
# size and splits skewed join partitions, even where that costs one more shuffle afterwards. The
# operators carry no join hints that would override it.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Folders of a table are listed by so many tasks at most, not by one for each folder.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "256",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A session without the setting uses a folder inside its warehouse, which is shared as well.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


#: With it Spark removes the shuffle files of a query when the query ends, not when the driver frees memory.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: Writers at work in a session, and what its setting was before the first of them.
_writers: dict[str, tuple[int, str | None]] = {}
_writers_lock = threading.Lock()


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """For a write after which nothing reads the frame's own shuffles again. Of the threads that write
    in one session the last one puts the setting back."""
    session = spark._jsparkSession.sessionUUID()
    with _writers_lock:
        writers, before = _writers.get(session) or (0, spark.conf.get(CLEANUP, None))
        _writers[session] = writers + 1, before
        spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        with _writers_lock:
            writers, before = _writers.pop(session)
            if writers > 1:
                _writers[session] = writers - 1, before
            elif before is None:
                spark.conf.unset(CLEANUP)
            else:
                spark.conf.set(CLEANUP, before)


def staged(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """The frame written to the shared folder and read back: its lineage ends there, and a lost
    executor recomputes nothing before it. So the shuffles that made it leave the disk."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with shuffles_removed(spark):
        df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def temporarily_staged(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """``staged`` for one use: the files are removed when the block ends without an error."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with shuffles_removed(spark):
        df.write.parquet(path)
    yield spark.read.schema(df.schema).parquet(path)
    remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly inside ``path``."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    return sorted(f.getPath().getName() for f in found if f.isDirectory())
