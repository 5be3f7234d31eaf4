"""Measurement stores: bounded scans with partition pruning and filter push-down.

An interval is half-open, ``[start, end)``.  A scan without both bounds is refused unless ``allow_full_scan``; so
is an empty or inverted interval.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expr import micros, number

UUID_STORE, INT_STORE = "signal_data_point.parquet", "vibration.parquet"


def check_bounds(start: datetime | None, end: datetime | None, allow_full_scan: bool = False) -> None:
    if (start is None or end is None) and not allow_full_scan:
        raise ValueError("start and end are required unless allow_full_scan is set")
    if start is not None and end is not None and start >= end:
        raise ValueError("start must lie before end")


def within(time: str | Column, start: datetime | None, end: datetime | None) -> Column:
    """The half-open interval predicate on a timestamp without time zone."""
    time = F.col(time) if isinstance(time, str) else time
    out = F.lit(True)
    if start is not None:
        out = out & (time >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        out = out & (time < F.lit(end).cast("timestamp_ntz"))
    return out


def bounded_scan(df: DataFrame, start=None, end=None, allow_full_scan: bool = False, where: Column | None = None, time: str = "time") -> DataFrame:
    """Filters before anything else, so both predicates reach the files."""
    check_bounds(start, end, allow_full_scan)
    if where is not None:
        df = df.where(where)
    return df.where(within(time, start, end)) if start is not None or end is not None else df


def samples(df: DataFrame) -> DataFrame:
    """time, value, signal_id with NaN as null; nanosecond files read as longs are brought to microseconds."""
    if dict(df.dtypes)["time"] == "bigint":
        df = df.withColumn("time", F.timestamp_micros(F.expr("time div 1000")).cast("timestamp_ntz"))
    return df.select(F.col("time"), number("value").alias("value"), "signal_id")


def uuid_signal(spark: SparkSession, base: str, signal_id: str, start=None, end=None, allow_full_scan: bool = False) -> DataFrame:
    """One signal of the UUID store: its partition directory alone is listed."""
    df = spark.read.schema("time timestamp_ntz, value double, signal_id string").parquet(f"{base.rstrip('/')}/{UUID_STORE}")
    return samples(bounded_scan(df, start, end, allow_full_scan, F.col("signal_id") == signal_id))


def uuid_signals(spark: SparkSession, base: str, signal_ids: list[str]) -> DataFrame:
    """Several signals of the UUID store over their whole time: their partition directories alone are listed."""
    df = spark.read.schema("time timestamp_ntz, value double, signal_id string").parquet(f"{base.rstrip('/')}/{UUID_STORE}")
    return samples(df.where(F.col("signal_id").isin(signal_ids) if signal_ids else F.lit(False)))


def partition_path(spark: SparkSession, base: str, source: str, key: str | int | None) -> str | None:
    """The partition directory of one signal, None where the id is null or the store has no such partition."""
    if key is None:
        return None
    path = f"{base.rstrip('/')}/{UUID_STORE if source == 'uuid' else INT_STORE}/signal_id={key}"
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path if at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at) else None


def int_signal(spark: SparkSession, base: str, signal_id: int, start=None, end=None, allow_full_scan: bool = False) -> DataFrame:
    """One signal of the integer store, whose id is also a physical column."""
    df = spark.read.schema("time timestamp_ntz, value double, signal_id bigint").parquet(f"{base.rstrip('/')}/{INT_STORE}")
    return samples(bounded_scan(df, start, end, allow_full_scan, F.col("signal_id") == signal_id))


def all_samples(spark: SparkSession, base: str) -> DataFrame:
    """Both stores as one tall table (source, signal_id as text, time, value)."""
    root = base.rstrip("/")
    uuid = spark.read.schema("time timestamp_ntz, value double, signal_id string").parquet(f"{root}/{UUID_STORE}")
    ints = spark.read.schema("time timestamp_ntz, value double, signal_id bigint").parquet(f"{root}/{INT_STORE}")
    return samples(uuid).withColumn("source", F.lit("uuid")).unionByName(samples(ints).withColumns({"signal_id": F.col("signal_id").cast("string"), "source": F.lit("int")}))


def time_coverage(df: DataFrame, keys: list[str], time: str = "time") -> DataFrame:
    """Rows and time range of each signal."""
    return df.groupBy(*keys).agg(F.count("*").alias("row_count"), F.min(time).alias("min_time"), F.max(time).alias("max_time"))


def row_group_bounds(spark: SparkSession, path: str, time: str = "time") -> DataFrame:
    """Row-group statistics from Parquet footers, in tasks over the files.

    Spark lists the files and each task seeks to the footers, so data pages are not read and files may have any size.  Where pyarrow
    does not know the path's scheme, Spark's binary reader hands over whole files instead (at most 2 GB each).
    """
    from pyarrow import ArrowInvalid
    from pyarrow.fs import FileSystem

    def split(name: str) -> str:
        return "file://" + name[5:] if name.startswith("file:/") and not name.startswith("file://") else name

    try:
        FileSystem.from_uri(split(path))
        seekable = True
    except (ArrowInvalid, NotImplementedError, OSError):
        seekable = False

    def run(batches):
        import io

        import pyarrow as pa
        import pyarrow.parquet as pq

        for batch in batches:
            out = []
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if seekable:
                    system, at = FileSystem.from_uri(split(name))
                    meta = pq.read_metadata(at, filesystem=system)
                else:
                    meta = pq.read_metadata(io.BytesIO(content))
                for g in range(meta.num_row_groups):
                    group = meta.row_group(g)
                    stats = next((group.column(i).statistics for i in range(group.num_columns) if group.column(i).path_in_schema == time), None)
                    low, high = (stats.min, stats.max) if stats is not None and stats.has_min_max else (None, None)
                    out.append((name, g, group.num_rows, low, high))
            cols = list(zip(*out, strict=True)) if out else [[]] * 5
            kinds = [pa.string(), pa.int32(), pa.int64(), pa.timestamp("us"), pa.timestamp("us")]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds, strict=True)], names=["file", "row_group", "row_count", "min_time", "max_time"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path)
    return files.select("path", F.lit(None).cast("binary").alias("content") if seekable else F.col("content")).mapInArrow(run, "file string, row_group int, row_count bigint, min_time timestamp_ntz, max_time timestamp_ntz")


def session_bounds(cycles: DataFrame) -> DataFrame:
    """The time span of each session's cycles, for pruning the scan of their measurements; the end is exclusive."""
    return cycles.groupBy("session_id").agg(F.min("start_time").alias("start_time"), (F.max("end_time") + F.expr("INTERVAL 0.000001 SECOND")).alias("end_time"), F.count("*").alias("cycles"))


def duration_micros(start: str = "start_time", end: str = "end_time") -> Column:
    return micros(start, end)
