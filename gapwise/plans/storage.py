"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import csv
import io
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch(spark: SparkSession, name: str) -> str:
    """A path below the shared folder.  Where the session names none, a local session gets a temporary one; a cluster raises."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="gapwise-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base}/{name}"


def freeze(df: DataFrame) -> DataFrame:
    """Writes a table and reads it back: what follows sees fixed rows and does not compute them again."""
    path = scratch(df.sparkSession, f"frozen-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(spark._jsc.hadoopConfiguration()).create(at, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """The whole of a small file, None where there is none."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return None
    return spark.read.text(path, wholetext=True).first()[0]


def write_csv(df: DataFrame, path: str) -> None:
    """One CSV file with a header, of a table whose rows are bounded by signals, sessions, metrics or codes."""
    out = io.StringIO()
    csv.writer(out).writerows([df.columns, *df.collect()])
    write_text(df.sparkSession, path, out.getvalue())


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV table with a header under a given schema; times without a zone stay as they are."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)
