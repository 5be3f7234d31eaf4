"""Ready blocks for human validation, and vibration-aware selection of cycles."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import finite, micros
from ..functions.ordered import join_buckets
from .temporal import interval_join

#: Fixed value: the reason of a required signal whose samples are all null or not finite.
NON_FINITE = "non_finite_required_signal"


def window_counts(samples: DataFrame, cycles: DataFrame, signals: list[str]) -> DataFrame:
    """Per cycle, sample and finite counts of each required signal."""
    found = interval_join(samples.where(F.col("signal_name").isin(signals)), cycles.select("cycle_id", "start_time", "end_time"))
    out = found.groupBy("cycle_id").pivot("signal_name", signals).agg(F.count(F.lit(1)).alias("sample_count"), F.count_if(finite("value")).alias("finite_count"))
    zero = [F.coalesce(F.col(f"{s}_{k}"), F.lit(0)).cast("bigint").alias(f"{s}_{k}") for s in signals for k in ("sample_count", "finite_count")]
    return cycles.join(out, "cycle_id", "left").select(*cycles.columns, *zero)


def ready_blocks(counted: DataFrame, signals: list[str], block: int, minimum: int = 1, max_scan: int | None = None) -> DataFrame:
    """Cycles in scan order with ready, run_id and run_length: runs of consecutive ready cycles inside one session."""
    scan = counted.orderBy("session_id", "start_time", "cycle_id").limit(max_scan) if max_scan else counted
    ready = F.lit(True)
    for s in signals:
        ready = ready & (F.col(f"{s}_sample_count") >= max(minimum, 1))
    w = Window.partitionBy("session_id").orderBy("start_time", "cycle_id")
    v = Window.partitionBy("session_id", "ready").orderBy("start_time", "cycle_id")
    out = scan.withColumn("ready", ready).withColumn("run_id", (F.row_number().over(w) - F.row_number().over(v)).cast("bigint"))
    return out.withColumn("run_length", F.when(F.col("ready"), F.count("*").over(Window.partitionBy("session_id", "ready", "run_id"))).otherwise(F.lit(0)).cast("bigint"))


def first_block(blocks: DataFrame, block: int) -> DataFrame:
    """The first ``block`` cycles of the earliest run that is long enough; none raises ``ValueError``."""
    start = blocks.where(F.col("ready") & (F.col("run_length") >= block)).orderBy("session_id", "start_time", "cycle_id").select("session_id", "run_id").limit(1)
    out = blocks.where("ready").join(F.broadcast(start), ["session_id", "run_id"], "left_semi").orderBy("start_time", "cycle_id").limit(block)
    if not out.head(1):
        raise ValueError("no block of consecutive ready cycles")
    return out


def validation_quality(counted: DataFrame, signals: list[str], minimum: dict | None = None) -> DataFrame:
    """Adds is_validation_ready, the missing and the insufficient signals in order, and the rejection's text."""
    least = {s: max(int((minimum or {}).get(s, 1)), 1) for s in signals}
    none = [F.when(F.col(f"{s}_sample_count") == 0, s) for s in signals]
    few = [F.when((F.col(f"{s}_sample_count") > 0) & (F.col(f"{s}_sample_count") < least[s]), s) for s in signals]
    out = counted.withColumns({"missing_required_signals": F.concat_ws(",", *none), "insufficient_required_signals": F.concat_ws(",", *few)})
    missing, short = F.col("missing_required_signals") != "", F.col("insufficient_required_signals") != ""
    # The rejection texts.
    text = F.when(missing & short, "missing and insufficient required signals").when(missing, "missing required signals")
    text = text.when(short, "insufficient samples for required signals").otherwise("")
    return out.withColumns({"is_validation_ready": ~missing & ~short, "rejection_reason": text})


def validation_cycles(quality: DataFrame, count: int, consecutive: bool = True, max_scan: int | None = 10_000) -> DataFrame:
    """The cycles for human validation: the earliest run of so many ready ones inside a session, or just the first ready ones.

    At most ``max_scan`` cycles are looked at, a limit that is the operator's own; none raises ``ValueError``.
    """
    if count <= 0:
        raise ValueError("the number of validation cycles must be positive")
    order = ["session_id", "start_time", "cycle_id"]
    scan = quality.orderBy(*order).limit(max_scan) if max_scan else quality
    if not consecutive:
        out = scan.where("is_validation_ready").orderBy(*order).limit(count)
        if out.count() < count:
            raise ValueError(f"fewer than {count} validation-ready cycles")
        return out
    w = Window.partitionBy("session_id").orderBy("start_time", "cycle_id")
    v = Window.partitionBy("session_id", "is_validation_ready").orderBy("start_time", "cycle_id")
    runs = scan.withColumn("ready", F.col("is_validation_ready")).withColumn("run_id", F.row_number().over(w) - F.row_number().over(v))
    return first_block(runs.withColumn("run_length", F.count("*").over(Window.partitionBy("session_id", "ready", "run_id"))), count).select(*quality.columns)


def first_n(cycles: DataFrame, target: int) -> DataFrame:
    """The leading cycles, unchecked, in the columns of a selection."""
    order = ["session_id", "start_time", "cycle_id"]
    out = cycles.orderBy(*order).limit(target)  # at most the target's rows
    rank = F.row_number().over(Window.orderBy(*order)).cast("bigint")
    return out.withColumns({"burst_id": F.lit(-1), "stratum": F.lit(0).cast("bigint"), "selection_rank": rank, "rejection_reasons": F.lit("")})


def selection_summary(picked: DataFrame, target: int) -> DataFrame:
    """One row: how many were eligible and selected, and how many the target lacks."""
    taken = F.count("selection_rank")
    return picked.agg(F.count("*").alias("eligible_cycles_found"), taken.alias("selected_cycles"), F.greatest(F.lit(0), F.lit(target) - taken).cast("bigint").alias("selection_shortfall"))


def selection_counts(picked: DataFrame) -> DataFrame:
    """kind (session, time_stratum, vibration_burst), id, cycles: sizes of the selection's groups, in one shuffle of partial counts.

    Only selected cycles count; without any the result is empty.
    """
    kinds = {"session": "session_id", "time_stratum": "stratum", "vibration_burst": "burst_id"}
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(c).cast("bigint").alias("id")) for k, c in kinds.items()])).alias("x")
    return picked.where("selection_rank IS NOT NULL").select(each).groupBy("x.kind", "x.id").agg(F.count("*").alias("cycles"))


def candidate_evaluation(counted: DataFrame, signals: list[str], minimum: int) -> DataFrame:
    """Adds eligible and rejection_reasons: an interval code alone, else the first failing code of each signal in order."""
    codes = [
        F.when(F.col(f"{s}_sample_count") == 0, f"missing_{s}").when(F.col(f"{s}_sample_count") < minimum, f"insufficient_{s}_samples").when(F.col(f"{s}_finite_count") == 0, NON_FINITE)
        for s in signals
    ]
    reasons = F.when(F.col("start_time") >= F.col("end_time"), "invalid_cycle_interval").otherwise(F.concat_ws(",", F.array(*codes)))
    return counted.withColumn("rejection_reasons", reasons).withColumn("eligible", F.col("rejection_reasons") == "")


def first_burst(samples: DataFrame, cycles: DataFrame) -> DataFrame:
    """burst_id of the first sample inside each cycle, -1 without one; samples carry burst_id."""
    found = interval_join(samples.select("time", "burst_id"), cycles.select("cycle_id", "start_time", "end_time")).groupBy("cycle_id").agg(F.min_by("burst_id", "time").alias("burst_id"))
    return cycles.join(found, "cycle_id", "left").withColumn("burst_id", F.coalesce("burst_id", F.lit(-1)))


def time_strata(cycles: DataFrame, sessions: DataFrame, strata: int) -> DataFrame:
    """Adds the stratum of each cycle's start within its session; without bounds it is 0."""
    b = sessions.select("session_id", F.col("start_time").alias("__a"), F.col("end_time").alias("__z"))
    span = micros("__a", "__z")
    part = F.floor(micros("__a", "start_time") / span * strata)
    stratum = F.when(span > 0, F.least(F.greatest(part, F.lit(0)), F.lit(strata - 1))).otherwise(0)
    return cycles.join(F.broadcast(b), "session_id", "left").withColumn("stratum", F.coalesce(stratum, F.lit(0)).cast("bigint")).drop("__a", "__z")


def select_cycles(eligible: DataFrame, target: int, burst_cap: int, seed: int = 42) -> DataFrame:
    """Round robin over (session, stratum) buckets in a seeded order, at most ``burst_cap`` of a burst (ids from 0).

    In its bucket a cycle has a seeded place; places are served in turn over all buckets.  A burst's cycles are capped in
    serving order, so the pick needs two windows and no loop.  Adds selection_rank (null where the cap or target leaves it out).

    Cycles without a burst are not one group of that window, and the served cycles, at most ``target``, are a distributed top-k
    that is joined back by its places.
    """
    h = F.xxhash64(F.lit(seed), "cycle_id")
    place = F.row_number().over(Window.partitionBy("session_id", "stratum").orderBy(h, "cycle_id", "burst_id"))
    out = eligible.withColumn("__turn", place)
    serve = [F.col("__turn"), F.col("session_id"), F.col("stratum"), F.col("cycle_id")]
    none = F.when(F.col("burst_id") < 0, F.col("cycle_id"))
    in_burst = F.row_number().over(Window.partitionBy("burst_id", none).orderBy(*serve))
    out = out.withColumn("__kept", (F.col("burst_id") < 0) | (in_burst <= burst_cap))
    keys = ["session_id", "stratum", "__turn"]
    served = out.where("__kept").orderBy(*serve).limit(target)
    rank = F.row_number().over(Window.orderBy(*serve)).cast("bigint")
    out = join_buckets(out, served.select(*keys, rank.alias("selection_rank")), keys)
    return out.withColumn("rejection_reasons", F.when(~F.col("__kept"), "burst_selection_limit").otherwise("")).drop("__turn", "__kept")
