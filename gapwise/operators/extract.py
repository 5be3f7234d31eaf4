"""Windows of every signal inside every cycle, the dense summary of them, and the partitioned measurement store."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expr import finite
from ..functions.ordered import scan
from .temporal import interval_join


def cycle_measurements(samples: DataFrame, cycles: DataFrame, bucket_seconds: int = 3600) -> DataFrame:
    """samples(signal_name, time, value) x cycles(session_id, cycle_id, start_time, end_time): every sample of each closed
    window, under the cycle's ids."""
    return interval_join(samples, cycles.select("session_id", "cycle_id", "start_time", "end_time"), bucket_seconds=bucket_seconds)


def window_summary(measurements: DataFrame, cycles: DataFrame, signals: DataFrame) -> DataFrame:
    """One row for each cycle and catalogue signal, present or missing.  Finite counts what is not null, as the store does."""
    grid = cycles.select("session_id", "cycle_id").crossJoin(F.broadcast(signals.select("signal_name").distinct()))  # a catalogue has tens of signals
    found = measurements.groupBy("cycle_id", "signal_name").agg(F.count("*").alias("sample_count"), F.count("value").alias("finite_sample_count"), F.min("time").alias("first_time"), F.max("time").alias("last_time"), F.min("value").alias("minimum_value"), F.max("value").alias("maximum_value"))
    out = grid.join(found, ["cycle_id", "signal_name"], "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
    return out.select("session_id", "cycle_id", "signal_name", zero("sample_count"), zero("finite_sample_count"), "first_time", "last_time", "minimum_value", "maximum_value", F.col("sample_count").isNull().alias("is_missing"))


def batch_summary(measurements: DataFrame, cycles: DataFrame, batch: int) -> DataFrame:
    """batch_id (from 0), cycle_count, first_cycle_id, last_cycle_id, written_rows: batches of so many cycles by start.

    Rows are counted by cycle before they meet the cycles, so a long cycle costs no more than a short one; a batch without
    samples has zero rows, no cycles give no batches.
    """
    places = scan(cycles.select("session_id", "cycle_id", "start_time"), [], ["start_time", "session_id", "cycle_id"], sums={"__i": F.lit(1)})
    rows = measurements.groupBy("cycle_id").agg(F.count("*").alias("__n"))
    out = places.withColumn("batch_id", F.floor((F.col("__i") - 1) / batch).cast("bigint")).join(rows, "cycle_id", "left")
    return out.groupBy("batch_id").agg(
        F.count("*").alias("cycle_count"), F.min_by("cycle_id", "__i").alias("first_cycle_id"), F.max_by("cycle_id", "__i").alias("last_cycle_id"), F.coalesce(F.sum("__n"), F.lit(0)).alias("written_rows"),
    )


def fingerprint(cycles: DataFrame, experiment: str, signals: list[str], batch: int) -> str:
    """Names a write by its settings and cycles; a different one must not resume it."""
    row = cycles.agg(F.count("*").alias("n"), F.min("cycle_id").alias("lo"), F.max("cycle_id").alias("hi"), F.sum("cycle_id").alias("sum")).first()
    return hashlib.sha256(json.dumps({"experiment": experiment, "signals": sorted(signals), "batch": batch, **row.asDict()}, sort_keys=True, default=str).encode()).hexdigest()


def write_store(measurements: DataFrame, path: str, mark: str, codec: str = "zstd") -> list[int]:
    """Writes measurements(experiment, session_id, ...) partitioned by both, never by cycle, session by session safe.

    A marker table names the settings; sessions that are already complete are skipped, others are replaced whole.
    Returns the sessions written.  Another marker raises ``ValueError``.
    """
    spark = measurements.sparkSession
    done = completed(spark, path, mark)
    todo = [r[0] for r in measurements.select("session_id").distinct().orderBy("session_id").collect() if r[0] not in done]
    if todo:
        rows = measurements.where(F.col("session_id").isin(todo)).repartition("session_id", F.floor(F.col("cycle_id") / 1000))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", codec).partitionBy("experiment", "session_id").parquet(f"{path}/measurements")
        spark.createDataFrame([(mark, int(s)) for s in todo], "mark string, session_id bigint").coalesce(1).write.mode("append").json(f"{path}/completed")
    return todo


def completed(spark: SparkSession, path: str, mark: str) -> set[int]:
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/completed")
    if not root.getFileSystem(spark._jsc.hadoopConfiguration()).exists(root):
        return set()
    rows = spark.read.schema("mark string, session_id bigint").json(f"{path}/completed").distinct().collect()
    if any(r["mark"] != mark for r in rows):
        raise ValueError("the store was begun with other settings or cycles")
    return {r["session_id"] for r in rows}


def read_store(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Partition values keep their declared types."""
    return spark.read.schema(schema).parquet(f"{path}/measurements")


def only_cycles(measurements: DataFrame, cycles: DataFrame, signals: list[str] | None = None) -> DataFrame:
    out = measurements.join(cycles.select("cycle_id").distinct(), "cycle_id", "left_semi")
    return out.where(F.col("signal_name").isin(signals)) if signals is not None else out


def finite_counts(measurements: DataFrame) -> DataFrame:
    return measurements.groupBy("cycle_id", "signal_name").agg(F.count("*").alias("sample_count"), F.count_if(finite("value")).alias("finite_count"))
