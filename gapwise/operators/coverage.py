"""Which sessions and cycles the signals cover, from samples, row-group bounds and window summaries.

Edge cases: a signal without samples has a count of zero and null times, and covers nothing; intervals are closed; null times cover
nothing; repeated rows count as often as they occur; empty tables give empty results or rows of zeros.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import contains_folded
from .temporal import interval_join, overlap_exists


def session_coverage(samples: DataFrame, sessions: DataFrame) -> DataFrame:
    """signal_name, row_count, sessions_covered, session_share: which sessions hold samples of each signal."""
    total = sessions.count()
    inside = interval_join(samples.select("signal_name", "time"), sessions.select("session_id", "start_time", "end_time"), bucket_seconds=86400)
    out = inside.groupBy("signal_name").agg(F.count("*").alias("row_count"), F.countDistinct("session_id").alias("sessions_covered"))
    return out.withColumn("session_share", F.col("sessions_covered") / F.lit(max(total, 1)))


def time_bounds(bounds: DataFrame, keys: list[str]) -> DataFrame:
    """first_raw_timestamp, last_raw_timestamp, raw_sample_count of each key from bounds (keys, row_count, min_time, max_time)."""
    return bounds.groupBy(*keys).agg(F.min("min_time").alias("first_raw_timestamp"), F.max("max_time").alias("last_raw_timestamp"), F.sum("row_count").alias("raw_sample_count"))


def signal_time_coverage(signals: DataFrame, bounds: DataFrame, sessions: DataFrame) -> DataFrame:
    """One row a signal: raw range and count, and the sessions that any of its row groups overlaps, joined by commas in order.

    ``bounds`` (signal_name, row_count, min_time, max_time) has one row for each row group, or for each day of samples; a gap between
    two of them covers no session.  Overlap is an equi-join on time slots.
    """
    names = signals.select("signal_name").distinct()
    spans = sessions.select("session_id", "start_time", "end_time")
    each = spans.crossJoin(F.broadcast(names))  # a catalogue has tens of signals
    hit = overlap_exists(each, bounds.where("row_count > 0"), keys=["signal_name"])
    one = F.struct("session_id", F.date_format("start_time", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("a"), F.date_format("end_time", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("z"))
    hit = hit.groupBy("signal_name").agg(F.array_sort(F.collect_list(one)).alias("x"))
    text = lambda f: F.coalesce(F.array_join(F.transform("x", lambda s: s[f].cast("string")), ","), F.lit(""))
    out = signals.join(time_bounds(bounds, ["signal_name"]), "signal_name", "left").join(hit, "signal_name", "left")
    return out.select(
        *signals.columns, "first_raw_timestamp", "last_raw_timestamp", F.coalesce("raw_sample_count", F.lit(0)).cast("bigint").alias("raw_sample_count"),
        text("session_id").alias("detected_session_ids"), text("a").alias("session_start_times"), text("z").alias("session_end_times"),
    )


def cycle_overlap(cycles: DataFrame, summary: DataFrame, axes: list[str]) -> DataFrame:
    """Cycles with <axis>_overlap for each axis that has samples in the cycle's window, and any_vibration_axis_overlap."""
    has = [F.coalesce(F.bool_or((F.col("signal_name") == a) & ~F.col("is_missing")), F.lit(False)).alias(f"{a}_overlap") for a in axes]
    found = summary.where(F.col("signal_name").isin(axes)).groupBy("cycle_id").agg(*has)
    flags = [F.coalesce(F.col(f"{a}_overlap"), F.lit(False)).alias(f"{a}_overlap") for a in axes]
    out = cycles.select("cycle_id", "session_id", "start_time", "end_time").join(found, "cycle_id", "left")
    out = out.select("cycle_id", "session_id", "start_time", "end_time", *flags)
    return out.withColumn("any_vibration_axis_overlap", reduce(lambda a, b: a | b, [F.col(f"{a}_overlap") for a in axes], F.lit(False)))


def signal_candidates(catalogue: DataFrame, bounds: DataFrame, experiment: str, selected_paths: list[str], unit: str = "vibration") -> DataFrame:
    """Every signal of the unit in the whole catalogue, chosen or not, the experiment's own first and then by path.

    ``bounds`` has source and key (either id as text), row_count, min_time, max_time.  A null path belongs to no experiment.
    """
    key = F.coalesce("signal_id_uuid", F.col("signal_id").cast("string")).alias("key")
    some = catalogue.where(F.col("unit_code") == unit).select("path", "source", "signal_id_uuid", "signal_id", key)
    mine = contains_folded("path", experiment).alias("belongs_to_current_experiment")
    chosen = F.coalesce(F.col("path").isin(selected_paths), F.lit(False)) if selected_paths else F.lit(False)
    out = some.join(time_bounds(bounds, ["source", "key"]), ["source", "key"], "left")
    return out.select(
        "path", "source", "signal_id_uuid", "signal_id", mine, chosen.alias("currently_selected_for_extraction"),
        "first_raw_timestamp", "last_raw_timestamp", F.coalesce("raw_sample_count", F.lit(0)).cast("bigint").alias("raw_sample_count"),
    ).orderBy(F.desc("belongs_to_current_experiment"), F.asc_nulls_last("path"))
