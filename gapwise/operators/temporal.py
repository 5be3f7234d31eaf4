"""Gaps, sessions, bursts, edges, cycles, interval joins and nearest values over time-ordered samples.

Every operator takes the sequence's key columns; an empty list is one sequence.  Order is time, then the tie-breakers.

Edge cases, for all of them: an empty table gives an empty result (the summaries of gaps and sessions one row of zero counts and nulls);
equal times keep the order of the tie-breakers and have a gap of zero; rows that repeat stay apart; null values never move and null times
have no gap (``clean`` drops both).  ``interval_join`` keeps the windows' column where a sample's has the same name.
"""

from __future__ import annotations

from datetime import timedelta
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import micros, number, seconds
from ..functions.ordered import BUCKET, join_buckets, scan

#: Seconds above which gaps are counted.
GAP_THRESHOLDS = (1, 5, 10, 30, 60, 300, 900, 1800, 3600, 21600, 86400)


def gaps(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Adds prev_time and gap_us, the whole microseconds since the sample before (null for the first)."""
    return scan(df, keys, order, {"prev_time": order[0]}).withColumn("gap_us", micros("prev_time", order[0]))


def gap_histogram(gapped: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Exact frequencies of the gaps."""
    return gapped.where("gap_us IS NOT NULL").groupBy(*(keys or []), "gap_us").agg(F.count("*").alias("gap_count"))


def gap_statistics(histogram: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """One row of statistics a sequence from the compressed gaps, in seconds; quantiles interpolate linearly."""
    s = F.col("gap_us") / 1e6
    q = lambda p: F.percentile(s, F.lit(p), F.col("gap_count"))
    return histogram.groupBy(*(keys or [])).agg(
        F.sum("gap_count").alias("gap_count"),
        F.min(s).alias("minimum_gap_seconds"),
        F.max(s).alias("maximum_gap_seconds"),
        (F.sum(F.col("gap_us") * F.col("gap_count")) / F.sum("gap_count") / 1e6).alias("mean_gap_seconds"),
        q(0.5).alias("median_gap_seconds"),
        q(0.95).alias("p95_gap_seconds"),
        q(0.99).alias("p99_gap_seconds"),
    )


def gap_threshold_counts(histogram: DataFrame, thresholds=GAP_THRESHOLDS) -> DataFrame:
    """threshold_seconds, gap_count: how many gaps exceed each threshold."""
    one = histogram.agg(*[F.coalesce(F.sum(F.when(F.col("gap_us") > int(t * 1_000_000), F.col("gap_count"))), F.lit(0)).alias(f"t{t}") for t in thresholds])
    return one.select(F.explode(F.array(*[F.struct(F.lit(int(t)).cast("bigint").alias("threshold_seconds"), F.col(f"t{t}").cast("bigint").alias("gap_count")) for t in thresholds])).alias("x")).select("x.*")


def gap_bins(histogram: DataFrame, bins: int, top_seconds: float, log: bool = False, low_seconds: float = 1e-3) -> DataFrame:
    """bin (1 to bins), gap_count over linear or logarithmic bins; gaps outside fall into 0 or bins + 1."""
    s = F.col("gap_us") / 1e6
    if log:
        x = F.when(s > 0, F.log10(s))
        number_ = F.width_bucket(x, F.log10(F.lit(float(low_seconds))), F.log10(F.lit(float(top_seconds))), F.lit(bins))
        number_ = F.coalesce(number_, F.lit(0))
    else:
        number_ = F.width_bucket(s, F.lit(0.0), F.lit(float(top_seconds)), F.lit(bins))
    return histogram.groupBy(number_.cast("bigint").alias("bin")).agg(F.sum("gap_count").alias("gap_count"))


def session_ids(df: DataFrame, keys: list[str], order: list[str], gap_seconds: float, first: int = 1, name: str = "session_id") -> DataFrame:
    """Adds gap_us and a running id that grows wherever the gap exceeds the threshold."""
    gap = micros("prev_time", order[0])
    new = (gap > int(gap_seconds * 1_000_000)).cast("int")
    out = scan(df, keys, order, {"prev_time": order[0]}, {name: new})
    return out.withColumns({"gap_us": gap, name: (F.col(name) + first).cast("bigint")})


def sessions(df: DataFrame, keys: list[str], order: list[str], gap_seconds: float = 3600.0) -> DataFrame:
    """Recording sessions: a gap above the threshold starts a new one."""
    return summarise_sessions(session_ids(df, keys, order, gap_seconds), keys, order[0], gap_seconds)


def summarise_sessions(tagged: DataFrame, keys: list[str], time: str, gap_seconds: float) -> DataFrame:
    inside = F.when(F.col("gap_us") <= int(gap_seconds * 1_000_000), F.col("gap_us"))
    out = tagged.groupBy(*keys, "session_id").agg(F.min(time).alias("start_time"), F.max(time).alias("end_time"), F.count("*").alias("number_of_samples"), (F.coalesce(F.max(inside), F.lit(0)) / 1e6).alias("maximum_internal_gap_seconds"))
    return out.select(*keys, "session_id", "start_time", "end_time", seconds("start_time", "end_time").alias("duration_seconds"), "number_of_samples", "maximum_internal_gap_seconds")


def session_summary(found: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """One row over all sessions, also when there are none; with keys one row for each sequence that has sessions."""
    return found.groupBy(*(keys or [])).agg(
        F.count("*").alias("session_count"),
        F.min("duration_seconds").alias("minimum_duration_seconds"), F.median("duration_seconds").alias("median_duration_seconds"), F.max("duration_seconds").alias("maximum_duration_seconds"),
        F.min("number_of_samples").alias("minimum_samples"), F.median("number_of_samples").alias("median_samples"), F.max("number_of_samples").alias("maximum_samples"),
        F.max("maximum_internal_gap_seconds").alias("maximum_internal_gap_seconds"),
    )


def bursts(df: DataFrame, keys: list[str], order: list[str], gap_seconds: float) -> DataFrame:
    """Burst ids from 0."""
    return session_ids(df, keys, order, gap_seconds, first=0, name="burst_id")


def _moving(df: DataFrame, threshold: float, value: str) -> DataFrame:
    if threshold < 0:
        raise ValueError("the movement threshold must not be negative")
    return df.withColumn("moving", F.col(value) > F.lit(float(threshold)))


def _rising():
    return F.coalesce(F.col("moving") & ~F.col("__was"), F.lit(False))


def _falling():
    return F.coalesce(~F.col("moving") & F.col("__was"), F.lit(False))


def edges(df: DataFrame, keys: list[str], order: list[str], threshold: float = 1.0, value: str = "value") -> DataFrame:
    """Adds moving, rising and falling; a sequence's first sample is neither."""
    out = scan(_moving(df, threshold, value), keys, order, {"__was": "moving"})
    return out.withColumns({"rising": _rising(), "falling": _falling()}).drop("__was")


def clean(df: DataFrame, time: str = "time", value: str = "value") -> DataFrame:
    """Drops rows without a usable time or value."""
    return df.withColumn(value, number(value)).where(F.col(time).isNotNull() & F.col(value).isNotNull())


def cycles(df: DataFrame, keys: list[str], order: list[str], threshold: float = 1.0, value: str = "value", hold=None) -> DataFrame:
    """Candidate cycles of each sequence: from a rising edge to the next falling edge, which belongs to it.

    Movement that a sequence begins or ends with is no cycle.  Cycles are numbered over all sequences, by keys and start: only
    a sequence's last movement may lack its falling edge, so the running number of rising edges is a cycle's place in its sequence, and
    one row a sequence carries the numbers across.  ``hold`` may store the cycles, one row each, before they are numbered.
    """
    time = order[0]
    marked = _moving(df, threshold, value)
    marked = scan(marked, keys, order, {"__was": "moving"}, {"__i": F.lit(1), "__c": _rising().cast("int")})
    marked = marked.withColumn("falling", _falling())
    inside = marked.where((F.col("__c") > 0) & (F.col("moving") | F.col("falling")))
    out = inside.groupBy(*keys, "__c").agg(
        (F.min("__i") - 1).alias("start_index"), (F.max("__i") - 1).alias("end_index"), F.min(time).alias("start_time"), F.max(time).alias("end_time"), F.count("*").alias("number_of_samples"),
        F.min(value).alias("minimum_position"), F.max(value).alias("maximum_position"), F.avg(value).alias("mean_position"), F.max("falling").alias("__whole"),
    ).where("__whole").drop("__whole")
    out = hold(out) if hold else out
    number_ = F.col("__c")
    if keys:
        ranks = out.groupBy(*keys).agg(F.count("*").alias("__n"))
        before = F.coalesce(F.sum("__n").over(Window.orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        names = {k: f"__k{i}" for i, k in enumerate(keys)}
        ranks = ranks.select(*[F.col(k).alias(n) for k, n in names.items()], before.alias("__before"))
        on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()])
        out, number_ = out.join(ranks, on), F.col("__before") + F.col("__c")
    return out.select(
        *keys, number_.cast("bigint").alias("cycle_id"), "start_index", "end_index", "start_time", "end_time", seconds("start_time", "end_time").alias("duration_seconds"),
        "number_of_samples", "minimum_position", "maximum_position", "mean_position",
    )


def interval_join(samples: DataFrame, windows: DataFrame, time: str = "time", start: str = "start_time", end: str = "end_time", bucket_seconds: int = 3600, keys: list[str] | None = None) -> DataFrame:
    """Samples inside closed windows, as an equi-join on (keys, time bucket) with a range residual.

    A window is repeated once for each bucket that it touches, a sample goes to one bucket; so neither side is
    compared with all of the other, and a sample that two touching windows share appears for both.  Windows whose end lies
    before their start match nothing.
    """
    keys = keys or []
    base = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    slot = lambda c: F.floor(F.timestamp_diff("SECOND", base, F.col(c)) / bucket_seconds).cast("bigint")
    left = samples.withColumn("__slot", slot(time))
    right = windows.where(F.col(start) <= F.col(end)).withColumn("__slot", F.explode(F.sequence(slot(start), slot(end))))
    clash = [c for c in left.columns if c in right.columns and c not in (*keys, "__slot")]
    return left.drop(*clash).join(right, [*keys, "__slot"]).where((F.col(time) >= F.col(start)) & (F.col(time) <= F.col(end))).drop("__slot")


def overlap_exists(left: DataFrame, right: DataFrame, start: str = "start_time", end: str = "end_time", bucket_seconds: int = 86400, keys: list[str] | None = None) -> DataFrame:
    """Rows of ``left`` whose closed interval meets one of ``right`` (whose columns are min_time, max_time) with equal keys."""
    base = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    slots = lambda a, b: F.explode(F.sequence(F.floor(F.timestamp_diff("SECOND", base, F.col(a)) / bucket_seconds), F.floor(F.timestamp_diff("SECOND", base, F.col(b)) / bucket_seconds)))
    cut = right.select(*(keys or []), "min_time", "max_time").where("min_time <= max_time").withColumn("__slot", slots("min_time", "max_time"))
    keyed = left.where(F.col(start) <= F.col(end)).withColumn("__slot", slots(start, end))
    same = reduce(lambda a, b: a & b, [keyed[k] == cut[k] for k in [*(keys or []), "__slot"]])
    hit = keyed.join(cut, same & (F.col("min_time") <= F.col(end)) & (F.col("max_time") >= F.col(start)), "left_semi")
    return hit.drop("__slot").distinct()


def around(samples: DataFrame, cycles: DataFrame, first: int = 100, margin_seconds: int = 1, time: str = "time") -> tuple[DataFrame, DataFrame]:
    """The first cycles by start, at most ``first``, and the samples from a margin before the first start to one after the last's end.

    Both bounds are closed and reach the scan as plain comparisons.  Without cycles there are no samples either.
    """
    some = cycles.orderBy("start_time", "cycle_id").limit(first)  # the limit is the operator's own
    ends = some.agg(F.min("start_time").alias("a"), F.max_by("end_time", F.struct("start_time", "cycle_id")).alias("z")).first()
    if ends["a"] is None:
        return samples.where(F.lit(False)), some
    bound = lambda t, sign: F.lit(t + sign * timedelta(seconds=margin_seconds)).cast("timestamp_ntz")
    return samples.where((F.col(time) >= bound(ends["a"], -1)) & (F.col(time) <= bound(ends["z"], 1))), some


def interval_summary(gapped: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Rows, and least, median and greatest sampling interval in milliseconds; an empty table gives zero and nulls."""
    ms = F.col("gap_us") / 1e3
    return gapped.groupBy(*(keys or [])).agg(F.count("*").alias("row_count"), F.min(ms).alias("minimum_interval_ms"), F.median(ms).alias("median_interval_ms"), F.max(ms).alias("maximum_interval_ms"))


def merge_intervals(df: DataFrame, keys: list[str], gap_seconds: float, start: str = "start_time", end: str = "end_time") -> DataFrame:
    """Islands of intervals that overlap or lie at most the gap apart.

    The farthest end so far is a running maximum in two levels, inside the time buckets of the starts and over one row a bucket, so a
    table without keys is never one task.  Intervals without a start are islands of their own.
    """
    df = df.withColumn("__bucket", F.date_trunc(BUCKET, F.col(start)))
    by = [*keys, "__bucket"]
    past = Window.unboundedPreceding, -1
    inside = F.max(end).over(Window.partitionBy(*by).orderBy(start, end).rowsBetween(*past))
    across = Window.partitionBy(*keys).orderBy("__bucket") if keys else Window.orderBy("__bucket")  # one row a bucket
    tops = df.groupBy(*by).agg(F.max(end).alias("__top")).select(*by, F.max("__top").over(across.rowsBetween(*past)).alias("__before"))
    out = join_buckets(df.withColumn("__inside", inside), tops, by)
    apart = micros(F.greatest("__inside", "__before"), start) > int(gap_seconds * 1_000_000)
    out = out.withColumn("__new", F.coalesce(apart.cast("int"), F.lit(1))).withColumn("__later", 1 - F.col("__new"))
    out = scan(out.drop(*["__bucket", "__inside", "__before"]), keys, [start, end, "__later"], sums={"__island": F.col("__new")})
    return out.groupBy(*keys, "__island").agg(F.min(start).alias(start), F.max(end).alias(end), F.count("*").alias("intervals")).drop("__island")


def nearest(points: DataFrame, samples: DataFrame, at: str, time: str = "time", value: str = "value", bucket: str = "DAY") -> DataFrame:
    """For each point the sample nearest in time, the earlier of two as near; adds nearest_time and nearest_value.

    Points and samples are merged into one sequence, each point with its whole row, so repeated points stay apart; the last
    sample before and the first after reach each point through time buckets, so the table is never sorted as a whole.  Points
    without a time, and all points where there are no samples, get nulls.
    """
    row = F.struct(*[F.col(c) for c in points.columns])
    kind = "struct<t:timestamp_ntz,v:double>"
    asked = points.select(F.col(at).alias("t"), F.lit(1).alias("p"), row.alias("row"), F.lit(None).cast(kind).alias("s"))
    known = F.struct(F.col(time).alias("t"), F.col(value).cast("double").alias("v")).cast(kind)
    given = samples.where(F.col(time).isNotNull()).select(F.col(time).alias("t"), F.lit(0).alias("p"), F.lit(None).cast(asked.schema["row"].dataType).alias("row"), known.alias("s"))
    both = asked.unionByName(given).withColumn("b", F.date_trunc(bucket, "t"))
    ends = both.groupBy("b").agg(F.max("s").alias("hi"), F.min("s").alias("lo"))
    w = Window.orderBy("b")  # one row a bucket
    before, after = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(1, Window.unboundedFollowing)
    ends = ends.select(F.col("b").alias("bb"), F.last("hi", True).over(before).alias("before"), F.first("lo", True).over(after).alias("after"))
    inner = Window.partitionBy("b").orderBy("t", "p")
    both = both.withColumn("x", F.last("s", True).over(inner.rowsBetween(Window.unboundedPreceding, 0)))
    both = both.withColumn("y", F.first("s", True).over(inner.rowsBetween(1, Window.unboundedFollowing)))
    found = both.where("p = 1").join(ends, F.col("b") == F.col("bb"), "left")
    found = found.select("row", "t", F.coalesce("x", "before").alias("x"), F.coalesce("y", "after").alias("y"))
    earlier = micros("x.t", "t") <= micros("t", "y.t")
    pick = F.when(F.col("t").isNull(), None).when(F.col("x").isNull(), F.col("y")).when(F.col("y").isNull() | earlier, F.col("x")).otherwise(F.col("y"))
    return found.select("row", pick.alias("s")).select("row.*", F.col("s.t").alias("nearest_time"), F.col("s.v").alias("nearest_value"))


def evenly_spaced(df: DataFrame, order: list[str], rows: int) -> DataFrame:
    """At most so many rows, evenly spaced in order, both ends among them."""
    if rows < 2:
        raise ValueError("at least two rows")
    indexed = scan(df, [], order, sums={"__i": F.lit(1)}).withColumn("__i", F.col("__i") - 1)
    total = F.broadcast(df.agg(F.count("*").alias("__n")))
    n, i = F.col("__n"), F.col("__i")
    k = F.floor((i * (rows - 1) + F.greatest(n - 2, F.lit(0))) / F.greatest(n - 1, F.lit(1)))
    hit = F.floor(k * (n - 1) / (rows - 1)) == i
    return indexed.join(total).where((n <= rows) | hit).drop("__n", "__i")
