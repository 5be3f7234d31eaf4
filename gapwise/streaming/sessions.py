"""Streaming sessions: the batch rule of gaps, kept by session windows under a watermark."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.storage import scratch


def session_stream(stream: DataFrame, gap: str, watermark: str, keys: list[str] | None = None, time: str = "time") -> DataFrame:
    """stream(time timestamp, ...) -> one row a closed session.  A gap of exactly the given length still joins in batch; a
    session window closes at it, so pass the batch threshold plus a microsecond for equal results."""
    w = F.session_window(F.col(time), gap)
    out = stream.withWatermark(time, watermark).groupBy(*(keys or []), w.alias("w")).agg(F.count("*").alias("number_of_samples"), F.min(time).alias("start_time"), F.max(time).alias("end_time"))
    return out.drop("w")


def replayed_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks as a file stream, read once to its end; sessions per signal go to a Parquet sink with exactly-once files."""
    at = scratch(spark, f"stream-{uuid.uuid4().hex}")
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    names = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/events.parquet")
    folder = names.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(names).isDirectory()
    source = spark.readStream.schema(schema)
    source = source.parquet(f"{sf_dir}/events.parquet") if folder else source.option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    rows = source.where("event_type = 'click'").select(F.col("ts").cast("timestamp").alias("time"), F.col("event_type").alias("signal_name"))
    found = session_stream(rows, "7200 seconds 1 microsecond", "1 hour", ["signal_name"])
    # Complete mode keeps the last open session too: a replay has an end that a live stream lacks.
    q = found.writeStream.outputMode("complete").trigger(availableNow=True).option("checkpointLocation", f"{at}/checkpoint").foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(f"{at}/out")).start()
    q.awaitTermination()
    out = spark.read.parquet(f"{at}/out")
    return out.select("number_of_samples", F.col("start_time").cast("timestamp_ntz").alias("start_time"), F.col("end_time").cast("timestamp_ntz").alias("end_time"))


ORACLE = """
WITH g AS (SELECT ts, date_diff('microsecond', lag(ts) OVER (ORDER BY ts, event_id), ts) AS gap_us FROM events WHERE event_type = 'click'),
s AS (SELECT ts, sum(CASE WHEN gap_us > 7200000000 THEN 1 ELSE 0 END) OVER (ORDER BY ts) AS k FROM g)
SELECT count(*) AS number_of_samples, min(ts) AS start_time, max(ts) AS end_time FROM s GROUP BY k
"""
