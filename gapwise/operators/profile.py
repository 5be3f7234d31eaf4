"""Quality metrics of every signal in every cycle, their roll-up and distribution, and the wide feature table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import finite, finite_value, micros, ratio

METRICS = ("sample_count", "finite_sample_count", "duration_seconds", "coverage_ratio", "estimated_sampling_rate", "median_sampling_interval", "mean_timestamp_gap", "maximum_timestamp_gap", "mean_value", "standard_deviation", "signal_range")
PERCENTILES = (1, 5, 25, 50, 75, 95, 99)


def signal_quality(measurements: DataFrame, cycles: DataFrame) -> DataFrame:
    """One row for each cycle and each signal that the store holds anywhere.

    Gaps follow time order inside a (cycle, signal) group, which is a few thousand samples at most.  Value metrics take
    finite values only; a constant signal is one whose finite minimum and maximum agree.
    """
    w = Window.partitionBy("cycle_id", "signal_name").orderBy("time", "value")
    v = finite_value("value")
    rows = measurements.select("cycle_id", "signal_name", "time", "value", v.alias("v"), (~finite("value")).alias("odd"), (micros(F.lag("time").over(w), "time")).alias("gap"))
    found = rows.groupBy("cycle_id", "signal_name").agg(
        F.count("*").alias("sample_count"), F.count("v").alias("finite_sample_count"), F.count_if("odd").alias("non_finite_count"),
        (F.coalesce(micros(F.min("time"), F.max("time")), F.lit(0)) / 1e6).alias("duration_seconds"),
        (F.coalesce(F.max("gap"), F.lit(0)) / 1e6).alias("maximum_timestamp_gap"), (F.coalesce(F.avg("gap"), F.lit(0.0)) / 1e6).alias("mean_timestamp_gap"), (F.median("gap") / 1e6).alias("median_sampling_interval"),
        F.avg("v").alias("mean_value"), F.when(F.count("v") > 1, F.stddev_pop("v")).when(F.count("v") == 1, 0.0).alias("standard_deviation"), F.min("v").alias("minimum_value"), F.max("v").alias("maximum_value"), F.median("v").alias("median_value"),
        F.count_if(F.col("gap") == 0).alias("duplicate_timestamp_count"),
    )
    names = measurements.select("signal_name").distinct()
    base = cycles.select("cycle_id", "session_id", micros("start_time", "end_time").alias("__d"))
    out = base.crossJoin(F.broadcast(names)).join(found, ["cycle_id", "signal_name"], "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint")
    return out.select(
        "cycle_id", "session_id", "signal_name", zero("sample_count").alias("sample_count"), zero("finite_sample_count").alias("finite_sample_count"), zero("non_finite_count").alias("non_finite_count"),
        "duration_seconds", "maximum_timestamp_gap", "mean_timestamp_gap", "median_sampling_interval", "mean_value", "standard_deviation", "minimum_value", "maximum_value", "median_value",
        (F.col("maximum_value") - F.col("minimum_value")).alias("signal_range"),
        ratio(F.col("sample_count") - 1, "duration_seconds").alias("estimated_sampling_rate"),
        zero("duplicate_timestamp_count").alias("duplicate_timestamp_count"),
        F.coalesce((F.col("finite_sample_count") > 1) & (F.col("minimum_value") == F.col("maximum_value")), F.lit(False)).alias("is_constant"),
        ratio("duration_seconds", F.col("__d") / 1e6).alias("coverage_ratio"), F.col("sample_count").isNull().alias("missing_signal"),
    )


def cycle_profile(quality: DataFrame, cycles: DataFrame, stroke_signal: str = "position") -> DataFrame:
    """Each cycle's counts, missing signals, and least, mean and greatest of four metrics."""
    spread = [f(c).alias(f"{n}_{c}") for c in ("sample_count", "coverage_ratio", "estimated_sampling_rate", "maximum_timestamp_gap") for n, f in (("min", F.min), ("mean", F.avg), ("max", F.max))]
    here = lambda c: F.when(~F.col("missing_signal"), F.col(c))
    rows = quality.withColumns({c: here(c) for c in ("sample_count", "coverage_ratio", "estimated_sampling_rate", "maximum_timestamp_gap")})
    out = rows.groupBy("cycle_id").agg(
        F.count("*").alias("expected_signal_count"), F.count_if(~F.col("missing_signal")).alias("present_signal_count"), F.count_if("missing_signal").alias("missing_signal_count"),
        F.array_join(F.array_sort(F.collect_list(F.when(F.col("missing_signal"), F.col("signal_name")))), ",").alias("missing_signal_names"),
        F.count_if("is_constant").alias("constant_signal_count"), *spread, F.max(F.when(F.col("signal_name") == stroke_signal, F.col("signal_range"))).alias("position_stroke_range"),
    )
    base = cycles.select("cycle_id", "session_id", "start_time", "end_time", (micros("start_time", "end_time") / 1e6).alias("cycle_duration_seconds"))
    return base.join(out, "cycle_id")


def metric_distribution(quality: DataFrame, metrics=METRICS) -> DataFrame:
    """signal_name, metric and twelve statistics over the cycles that hold the signal; non-finite values are left out."""
    rows = quality.where("NOT missing_signal").select("signal_name", *[F.col(m).cast("double").alias(m) for m in metrics]).unpivot("signal_name", list(metrics), "metric", "x").where(finite("x"))
    return rows.groupBy("signal_name", "metric").agg(
        F.count("*").alias("count"), F.avg("x").alias("mean"), F.coalesce(F.when(F.count("*") > 1, F.stddev_samp("x")), F.lit(0.0)).alias("std"), F.min("x").alias("min"), F.max("x").alias("max"),
        *[F.percentile("x", F.lit(p / 100)).alias(f"p{p}") for p in PERCENTILES],
    )


def feature_table(measurements: DataFrame, cycles: DataFrame, names: list[str]) -> DataFrame:
    """One row a cycle, seven columns a signal; cycles without samples appear as all missing.  NaN carries through."""
    found = measurements.groupBy("cycle_id").pivot("signal_name", names).agg(
        F.count("value").alias("count"), F.min("value").alias("min"), F.max("value").alias("max"), F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"), F.sqrt(F.avg(F.col("value") * F.col("value"))).alias("rms")
    )
    base = cycles.select("session_id", "cycle_id", "start_time", "end_time", (micros("start_time", "end_time") / 1e6).alias("duration_seconds"))
    out = base.join(found, "cycle_id", "left")
    cols = []
    for n in names:
        cols += [F.coalesce(F.col(f"{n}_count") == 0, F.lit(True)).alias(f"{n}_is_missing"), F.coalesce(F.col(f"{n}_count"), F.lit(0)).cast("bigint").alias(f"{n}_count")]
        cols += [F.col(f"{n}_{s}") for s in ("min", "max", "mean", "std", "rms")]
    return out.select("session_id", "cycle_id", "start_time", "end_time", "duration_seconds", *cols)


def presence_pivot(summary: DataFrame, names: list[str]) -> DataFrame:
    """Whether each signal is present in each cycle, and whether any is."""
    out = summary.groupBy("cycle_id").pivot("signal_name", names).agg(F.first("is_missing"))
    flags = [F.coalesce(~F.col(n), F.lit(False)).alias(f"has_{n}") for n in names]
    out = out.select("cycle_id", *flags)
    return out.withColumn("has_any", F.greatest(*[F.col(f"has_{n}") for n in names]) if len(names) > 1 else F.col(f"has_{names[0]}"))
