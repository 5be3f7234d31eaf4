"""Fixed-length cycle tensors with masks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import file_name, mask, number, pad_edge


def cycle_lengths(measurements: DataFrame, reference: str) -> DataFrame:
    return measurements.where(F.col("signal_name") == reference).groupBy("cycle_id").agg(F.count("*").alias("cycle_length"))


def target_length(lengths: DataFrame, strategy: str = "max", percentile: float = 95.0) -> int:
    """The longest length, or a percentile rounded up; at least 1.  No lengths raise ``ValueError``."""
    if strategy not in ("max", "percentile"):
        raise ValueError(f"unknown strategy {strategy!r}")
    how = F.max("cycle_length") if strategy == "max" else F.percentile("cycle_length", F.lit(percentile / 100))
    row = lengths.agg(F.ceil(how).alias("t")).first()
    if row["t"] is None:
        raise ValueError("no reference samples")
    return max(int(row["t"]), 1)


def length_statistics(lengths: DataFrame, target: int) -> DataFrame:
    c = F.col("cycle_length")
    return lengths.agg(
        F.count("*").alias("cycle_count"), F.min(c).alias("minimum_length"), F.max(c).alias("maximum_length"), F.avg(c).alias("mean_length"), F.median(c).alias("median_length"), F.percentile(c, F.lit(0.95)).alias("p95_length"), F.percentile(c, F.lit(0.99)).alias("p99_length"),
        F.count_if(c < target).alias("padded_count"), F.count_if(c > target).alias("truncated_count"),
    )


def cycle_tensors(measurements: DataFrame, cycles: DataFrame, signals: list[str], length: int, reference: str, truncate: bool = True, per_file: int = 1000) -> DataFrame:
    """One row a cycle: values and mask (signals x length arrays, in signal order), file number and skip reason.

    Each signal is cut or padded on its own by its last value.  Files count every requested cycle, skipped ones too.
    Values sort by time inside one cycle and signal, a bounded group.
    """
    rows = measurements.where(F.col("signal_name").isin(signals)).groupBy("cycle_id", "signal_name").agg(F.array_sort(F.collect_list(F.struct("time", number("value").alias("value")))).alias("x"))
    rows = rows.select("cycle_id", "signal_name", F.transform("x", lambda s: s["value"]).alias("v"))
    wide = rows.groupBy("cycle_id").pivot("signal_name", signals).agg(F.first("v"))
    place = F.row_number().over(Window.orderBy("cycle_id"))  # one row a requested cycle
    base = cycles.dropDuplicates(["cycle_id"]).withColumn("file_number", F.floor((place - 1) / per_file).cast("bigint"))
    out = base.join(wide, "cycle_id", "left")
    missing = [F.when(F.col(s).isNull(), s) for s in signals]
    reason = F.when(F.col("start_time").isNull() | F.col("end_time").isNull(), "missing_cycle_timing").when(F.size(F.array_compact(F.array(*missing))) > 0, "missing_required_signal")
    if not truncate:
        reason = reason.when(F.size(F.col(reference)) > length, "reference_signal_truncated")
    out = out.withColumn("skip_reason", reason)
    keep = F.col("skip_reason").isNull()
    values = F.when(keep, F.array(*[pad_edge(s, length) for s in signals]))
    masks = F.when(keep, F.array(*[mask(F.least(F.size(s), F.lit(length)), length) for s in signals]))
    lengths = F.when(keep, F.to_json(F.create_map(*[x for s in signals for x in (F.lit(s), F.size(s))])))
    return out.select("cycle_id", "session_id", "start_time", "end_time", "file_number", file_name("file_number").alias("file_name"), values.alias("values"), masks.alias("mask"), lengths.alias("original_lengths"), "skip_reason")


def write_npy(tensors: DataFrame, path: str) -> DataFrame:
    """Writes ``<file>.npy`` and ``<file>_mask.npy`` of each file's cycles and returns what was written.

    The folder must be shared by all executors.  A file's cycles are one group, bounded by the cycles per file.
    """

    def run(pdf):
        import os

        import numpy as np
        import pandas as pd

        pdf = pdf.sort_values("cycle_id")
        x = np.array([np.stack([np.asarray(s, float) for s in v]).T for v in pdf["values"]])
        m = np.array([np.stack([np.asarray(s, np.int8) for s in v]).T for v in pdf["mask"]])
        os.makedirs(path, exist_ok=True)
        name = pdf["file_name"].iloc[0]
        for suffix, data in (("", x), ("_mask", m)):
            part = os.path.join(path, f".{name}{suffix}.{os.getpid()}.npy")
            np.save(part, data)
            os.replace(part, os.path.join(path, f"{name}{suffix}.npy"))  # a repeated task leaves one whole file
        return pd.DataFrame({"file_name": [name], "cycles": [len(x)], "length": [x.shape[1]], "signals": [x.shape[2]]})

    return tensors.where("skip_reason IS NULL").groupBy("file_name").applyInPandas(run, "file_name string, cycles bigint, length bigint, signals bigint")
