"""Shared plumbing of the corpus operators: table access, durable intermediates, checked broadcasts."""

from __future__ import annotations

import ctypes
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Explicit broadcasts happen only below this many rows of a few fixed-width columns; beyond it the same join shuffles.
BROADCAST_ROWS = 2_000_000
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.  Where none is named, a local session gets a temporary one; a cluster raises."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="gapwise-")
        spark.sparkContext.setCheckpointDir(path)
    return path


def stored(df: DataFrame, name: str = "step") -> DataFrame:
    """Writes an intermediate table to the shared folder and reads it back: lineage is cut, and lost executors lose nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")  # the table replaces the shuffle files that made it
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before) if before is not None else spark.conf.unset(_CLEANUP)
    return spark.read.schema(df.schema).parquet(path)


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def bounded(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Hints a broadcast if the table's counted rows are few enough; else leaves the join to shuffle."""
    return F.broadcast(df) if rows <= limit else df


def give_back() -> None:
    """Returns the memory that this process has freed but kept, after a fit on the driver; without effect where libc has no such call."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass


def discard(*frames: DataFrame) -> None:
    """Deletes intermediate tables that nothing reads any more."""
    for df in frames:
        spark = df.sparkSession
        for path in {f.rpartition("/")[0] for f in df.inputFiles()[:1]}:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
