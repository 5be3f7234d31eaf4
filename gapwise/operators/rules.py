"""Availability classes, learned and hard validation rules, and validation against frozen rules.

Edge cases: a signal that a cycle lacks, or that no cycle has, is missing there; metrics that are null or not finite are not learned
from and not checked; with no cycles every table is empty but that of the hard rules; repeated rows count as often as they occur.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import finite

#: The metrics that rules are learned for.
SIGNAL_METRICS = (
    "sample_count",
    "finite_sample_count",
    "estimated_sampling_rate",
    "median_sampling_interval",
    "maximum_timestamp_gap",
    "coverage_ratio",
    "signal_range",
    "standard_deviation",
)
CYCLE_METRICS = ("cycle_duration_seconds", "position_stroke_range")
#: Metric, applies below, applies above, reason below, reason above.
CHECKS = (
    ("sample_count", True, True, "sample_count_below_lower_bound", "sample_count_above_upper_bound"),
    ("finite_sample_count", True, True, "sample_count_below_lower_bound", "sample_count_above_upper_bound"),
    ("coverage_ratio", True, False, "coverage_below_lower_bound", None),
    ("maximum_timestamp_gap", False, True, None, "maximum_gap_above_upper_bound"),
    ("signal_range", True, True, "signal_range_below_lower_bound", "signal_range_above_upper_bound"),
)


#: Tables that split the results by class.
CLASS_TABLES = {
    "valid_core_cycles": "valid_core_cycle",
    "valid_complete_multisensor_cycles": "valid_complete_multisensor_cycle",
    "invalid_cycles": "invalid_cycle",
}


@dataclass(frozen=True)
class RuleConfig:
    core: tuple[str, ...] = ("position", "velocity", "current", "pressure", "temperature")
    vibration: tuple[str, ...] = ("vibration_x", "vibration_y", "vibration_z")
    minimum_reference_count: int = 20
    z: float = 3.5
    quantiles: tuple[float, float] = (0.01, 0.99)
    provisional: bool = True
    allow_provisional: bool = True
    require_rules: bool = False
    roles: dict = field(default_factory=dict)

    def __post_init__(self):
        if self.minimum_reference_count < 1 or self.z <= 0 or not 0 <= self.quantiles[0] < self.quantiles[1] <= 1:
            raise ValueError("the rule settings are out of range")


def availability(quality: DataFrame, cycles: DataFrame, axes: tuple[str, ...]) -> DataFrame:
    """cycle_id, vibration_class: unavailable, partial or complete by the configured axes."""
    if not axes:
        return cycles.select("cycle_id", F.lit("vibration_unavailable").alias("vibration_class"))
    rows = quality.where(F.col("signal_name").isin(*axes)).select("cycle_id", "signal_name", "sample_count", "finite_sample_count")
    least = rows.groupBy("signal_name").agg(F.greatest(F.lit(1.0), 0.5 * F.coalesce(F.median(F.when(F.col("sample_count") > 0, F.col("sample_count"))), F.lit(0.0))).alias("least"))
    ok = (F.col("sample_count") > 0) & (F.col("finite_sample_count") > 0) & (F.col("sample_count") >= F.col("least"))
    by = rows.join(F.broadcast(least), "signal_name").groupBy("cycle_id").agg(F.sum("sample_count").alias("n"), F.countDistinct(F.when(ok, F.col("signal_name"))).alias("good"))
    label = F.when(F.coalesce("n", F.lit(0)) == 0, "vibration_unavailable").when(F.col("good") == len(axes), "vibration_complete").otherwise("vibration_partial")
    return cycles.select("cycle_id").join(by, "cycle_id", "left").select("cycle_id", label.alias("vibration_class"))


def learned_rules(values: DataFrame, config: RuleConfig) -> DataFrame:
    """values(scope, signal_name, metric, x) -> one rule for each, with its bounds, method and status.

    Bounds are median and scaled median deviation, or outer quantiles where the deviation is zero.  Two aggregates: the
    second needs the first's medians, a table of one row a rule.
    """
    by = ["scope", "signal_name", "metric"]
    rows = values.withColumn("x", F.when(finite("x"), F.col("x")))
    lo, hi = config.quantiles
    first = rows.groupBy(*by).agg(F.count("x").alias("reference_count"), F.median("x").alias("median"), F.percentile("x", F.lit(lo)).alias("q_lo"), F.percentile("x", F.lit(hi)).alias("q_hi"))
    mad = rows.join(F.broadcast(first.select(*by, "median")), by).groupBy(*by).agg(F.median(F.abs(F.col("x") - F.col("median"))).alias("mad"))
    out = first.join(mad, by, "left")
    few = (F.col("reference_count") == 0) | (F.col("reference_count") < config.minimum_reference_count)
    status = F.when(few, "skipped_insufficient_data").when(F.col("mad") > 0, "learned").when(F.col("q_lo") == F.col("q_hi"), "skipped_constant").otherwise("learned")
    reach = F.lit(config.z / 0.6745) * F.col("mad")
    learned = F.col("status") == "learned"
    out = out.withColumn("status", status)
    return out.select(
        *by, "reference_count", "median", "mad",
        F.when(learned, F.when(F.col("mad") > 0, F.col("median") - reach).otherwise(F.col("q_lo"))).alias("lower_bound"),
        F.when(learned, F.when(F.col("mad") > 0, F.col("median") + reach).otherwise(F.col("q_hi"))).alias("upper_bound"),
        F.when(learned, F.when(F.col("mad") > 0, "median_mad").otherwise("quantile")).alias("method"),
        (learned & (F.col("mad") == 0)).alias("fallback_used"), "status",
    )


def reference_values(quality: DataFrame, profile: DataFrame, classes: DataFrame, config: RuleConfig) -> DataFrame:
    """What rules are learned from: core signals over all cycles, vibration axes over complete ones, cycle metrics."""
    def tall(df, scope):
        return df.select("signal_name", *[F.col(m).cast("double").alias(m) for m in SIGNAL_METRICS]).unpivot("signal_name", list(SIGNAL_METRICS), "metric", "x").select(F.lit(scope).alias("scope"), "signal_name", "metric", "x")

    core = tall(quality.where(F.col("signal_name").isin(*config.core)), "core")
    whole = classes.where("vibration_class = 'vibration_complete'")
    vibration = tall(quality.where(F.col("signal_name").isin(*config.vibration)).join(whole, "cycle_id", "left_semi"), "vibration")
    cycle = profile.select(*[F.col(m).cast("double").alias(m) for m in CYCLE_METRICS]).unpivot([], list(CYCLE_METRICS), "metric", "x").select(F.lit("cycle").alias("scope"), F.lit("").alias("signal_name"), "metric", "x")
    return core.unionByName(vibration).unionByName(cycle)


def hard_rules(spark, config: RuleConfig) -> DataFrame:
    """Logical rules that are never learned: order and length of a cycle, the position's presence, finite core signals."""
    rows = [("cycle", "interval_order", "hard_interval_order", None), ("cycle", "duration_seconds", "hard_positive_duration", 0.0)]
    rows += [("position", "presence", "hard_signal_presence", None)]
    rows += [(s, "finite_values", "hard_finite_required", None) for s in config.core]
    fields = "signal_name string, metric string, rule_type string, lower_bound double, upper_bound double, method string, hard_rule boolean, provisional boolean, fallback_used boolean"
    return spark.createDataFrame([(s, m, kind, low, None, "hard_rule", True, False, False) for s, m, kind, low in rows], fields)


def population_warning(profile: DataFrame, config: RuleConfig) -> str | None:
    """Why the profiled cycles may not stand for all, if they may not."""
    row = profile.agg(F.countDistinct("session_id").alias("s"), F.count("*").alias("n")).first()
    if not row["n"]:
        return "no profiled cycles: there is no reference population"
    if row["s"] <= 1 or row["n"] < max(5 * config.minimum_reference_count, 200):
        return f"{row['n']} profiled cycles in {row['s']} sessions may not represent the whole experiment"
    return None


def is_provisional(profile: DataFrame, config: RuleConfig) -> bool:
    return config.provisional and population_warning(profile, config) is not None


def _out(x, rule_lo, rule_hi, below, above, low, high):
    low_ = F.when(F.col(x) < F.col(rule_lo), low) if below else F.lit(None).cast("string")
    high_ = F.when(F.col(x) > F.col(rule_hi), high) if above else F.lit(None).cast("string")
    return low_, high_


def signal_validation(quality: DataFrame, cycles: DataFrame, rules: DataFrame, config: RuleConfig, signals: tuple[str, ...], scope: str) -> DataFrame:
    """cycle_id, signal_name, reasons (array, in fixed order) for every cycle and given signal."""
    spark = quality.sparkSession
    names = spark.createDataFrame([(s,) for s in signals], "signal_name string")
    bounds = rules.where((F.col("scope") == scope) & (F.col("status") == "learned")).groupBy("signal_name").agg(
        *[F.max(F.when(F.col("metric") == m, F.col(b))).alias(f"{m}__{b}") for m, *_ in CHECKS for b in ("lower_bound", "upper_bound", "status")]
    )
    if not config.allow_provisional and "provisional" in rules.columns:  # a provisional rule exists, but does not apply to signals
        off = rules.where("provisional").select("signal_name").distinct().withColumn("__off", F.lit(True))
        bounds = bounds.join(F.broadcast(off), "signal_name", "left")
        for m, *_ in CHECKS:
            for b in ("lower_bound", "upper_bound"):
                bounds = bounds.withColumn(f"{m}__{b}", F.when(F.col("__off").isNull(), F.col(f"{m}__{b}")))
        bounds = bounds.drop("__off")
    grid = cycles.select("cycle_id").crossJoin(F.broadcast(names)).join(quality, ["cycle_id", "signal_name"], "left").join(F.broadcast(bounds), "signal_name", "left")
    checks = []
    for m, below, above, low, high in CHECKS:
        checks += _out(m, f"{m}__lower_bound", f"{m}__upper_bound", below, above, low, high)
        if config.require_rules:
            none = F.col(m).isNotNull() & ~F.isnan(F.col(m).cast("double")) & F.col(f"{m}__status").isNull()
            checks.append(F.when(none, "rule_not_generated"))
    missing = F.col("missing_signal").isNull() | F.col("missing_signal")
    none = F.coalesce(F.col("finite_sample_count"), F.lit(0)) <= 0
    found = F.when(missing, F.array(F.lit("missing_required_signal"))).when(none, F.array(F.lit("no_finite_values"))).otherwise(F.array_compact(F.array(*checks)))
    return grid.select("cycle_id", "signal_name", found.alias("reasons"))


def cycle_validation(quality: DataFrame, profile: DataFrame, classes: DataFrame, rules: DataFrame, config: RuleConfig) -> DataFrame:
    """cycle_id, session_id, vibration_class, reasons (comma-joined) and final_class.

    ``rules`` must be a frozen table that was read back, so validation never recomputes it.
    """
    core = signal_validation(quality, profile, rules, config, config.core, "core")
    core = core.groupBy("cycle_id").agg(F.array_sort(F.collect_list(F.struct(F.array_position(F.array(*[F.lit(s) for s in config.core]), F.col("signal_name")).alias("p"), F.col("signal_name").alias("s"), F.col("reasons").alias("r")))).alias("x"))
    core = core.select("cycle_id", F.flatten(F.transform("x", lambda s: F.transform(s["r"], lambda r: F.concat(s["s"], F.lit(":"), r)))).alias("core_reasons"))
    bounds = {(r["metric"]): (r["lower_bound"], r["upper_bound"]) for r in rules.where("scope = 'cycle' AND status = 'learned'").collect()}
    rows = profile.join(core, "cycle_id", "left").join(classes, "cycle_id", "left").withColumn("vibration_class", F.coalesce("vibration_class", F.lit("vibration_unavailable")))
    if config.vibration:
        bad = signal_validation(quality, profile, rules, config, config.vibration, "vibration").groupBy("cycle_id").agg(F.max(F.size("reasons") > 0).alias("axis_bad"))
        rows = rows.join(bad, "cycle_id", "left")
    else:
        rows = rows.withColumn("axis_bad", F.lit(True))
    checks = [F.when(F.col("start_time") >= F.col("end_time"), "invalid_cycle_interval"), F.when(F.col("cycle_duration_seconds") <= 0, "duration_below_lower_bound")]
    lo, hi = bounds.get("cycle_duration_seconds", (None, None))
    if lo is not None:
        checks += [F.when(F.col("cycle_duration_seconds") < lo, "duration_below_lower_bound"), F.when(F.col("cycle_duration_seconds") > hi, "duration_above_upper_bound")]
    lo, hi = bounds.get("position_stroke_range", (None, None))
    if lo is not None:
        checks += [F.when(F.col("position_stroke_range") < lo, "position_stroke_out_of_range"), F.when(F.col("position_stroke_range") > hi, "position_stroke_out_of_range")]
    hard = F.array_compact(F.array(*checks))
    info = F.when(F.col("vibration_class") != "vibration_complete", F.col("vibration_class"))
    core_reasons = F.coalesce("core_reasons", F.array().cast("array<string>"))
    bad = F.size(F.concat(hard, core_reasons)) > 0
    final = F.when(bad, "invalid_cycle").when((F.col("vibration_class") == "vibration_complete") & ~F.coalesce("axis_bad", F.lit(True)), "valid_complete_multisensor_cycle").otherwise("valid_core_cycle")
    return rows.select("cycle_id", "session_id", "vibration_class", F.array_join(F.concat(hard, core_reasons, F.array_compact(F.array(info))), ",").alias("reasons"), final.alias("final_class"))


def reason_counts(results: DataFrame, reasons: str = "reasons") -> DataFrame:
    parts = F.filter(F.transform(F.split(reasons, ","), lambda x: F.trim(x)), lambda x: x != "")
    return results.select(F.explode(parts).alias("reason")).groupBy("reason").agg(F.count("*").alias("reason_count"))
