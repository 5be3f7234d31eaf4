"""The registered queries of the engine's own operators and their SQL.

Events play the raw signals: ``ts`` is the time, ``event_type`` the signal, ``click`` the reference.  Regions, nations and
customers are the node hierarchy, customers also the signal catalogue.  Doubles are rounded to six digits on both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.expr import contains_folded, finite, leaf, parts, slug
from .operators import catalog, coverage, extract, profile, relational, rules, select, temporal, tensors
from .plans import dataset
from .plans.storage import freeze
from .sources import measurements as store
from .streaming import sessions as stream

GAP, THRESHOLD, ORDER = 7200.0, 35.0, ["time", "event_id"]
SIGNALS = ["click", "error", "purchase", "signup", "view"]
OTHERS = ["error", "purchase", "signup", "view"]
CONFIG = rules.RuleConfig(core=("click", "error", "purchase"), vibration=("signup", "view"))

QUERIES: dict = {}
ORACLES: dict = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


#: Averages and medians of whole microseconds end in fractions of one; six digits would round them at ties.
FINE = ("mean_timestamp_gap", "median_sampling_interval")


def rounded(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(c, 9 if c in FINE else 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def events(spark, d) -> DataFrame:
    return read(spark, d, "events").select(F.col("ts").alias("time"), "value", F.col("event_type").alias("signal_name"), "event_id")


def clicks(spark, d) -> DataFrame:
    return events(spark, d).where("signal_name = 'click'")


def tagged(spark, d) -> DataFrame:
    """The reference signal under its sessions; stored, as several operators read it."""
    return freeze(temporal.session_ids(temporal.clean(clicks(spark, d)), [], ORDER, GAP).drop("prev_time", "signal_name"))


def found_sessions(spark, d) -> DataFrame:
    return temporal.summarise_sessions(tagged(spark, d), [], "time", GAP)


def found_cycles(spark, d) -> DataFrame:
    return freeze(temporal.cycles(tagged(spark, d).drop("gap_us"), ["session_id"], ORDER, THRESHOLD, hold=freeze))


def inside(spark, d) -> tuple[DataFrame, DataFrame]:
    cycles = found_cycles(spark, d)
    return extract.cycle_measurements(events(spark, d), cycles), cycles


def quality(spark, d) -> tuple[DataFrame, DataFrame]:
    measurements, cycles = inside(spark, d)
    return profile.signal_quality(freeze(measurements), cycles), cycles


# SQL building blocks -------------------------------------------------------------------------------------------------

_EV = "ev AS (SELECT ts AS time, value, event_type AS signal_name, event_id FROM events)"
_GAPS = f"{_EV}, cl AS (SELECT * FROM ev WHERE signal_name = 'click'), g AS (SELECT *, date_diff('microsecond', lag(time) OVER (ORDER BY time, event_id), time) AS gap_us FROM cl)"
_HIST = f"{_GAPS}, h AS (SELECT gap_us, count(*) AS gap_count FROM g WHERE gap_us IS NOT NULL GROUP BY gap_us)"
_TAG = f"{_GAPS}, s AS (SELECT *, CAST(1 + sum(CASE WHEN gap_us > 7200000000 THEN 1 ELSE 0 END) OVER (ORDER BY time, event_id) AS BIGINT) AS session_id FROM g)"
_SES = f"{_TAG}, ses AS (SELECT session_id, min(time) AS start_time, max(time) AS end_time, date_diff('microsecond', min(time), max(time)) / 1e6 AS duration_seconds, count(*) AS number_of_samples, coalesce(max(gap_us) FILTER (WHERE gap_us <= 7200000000), 0) / 1e6 AS maximum_internal_gap_seconds FROM s GROUP BY session_id)"
_EDGE = f"{_TAG}, m AS (SELECT *, value > 35 AS moving, lag(value > 35) OVER w AS was, row_number() OVER w - 1 AS i FROM s WINDOW w AS (PARTITION BY session_id ORDER BY time, event_id)), e AS (SELECT *, coalesce(moving AND NOT was, false) AS rising, coalesce(NOT moving AND was, false) AS falling FROM m)"
_CYC = f"""{_EDGE}, n AS (SELECT *, sum(CASE WHEN rising THEN 1 ELSE 0 END) OVER (PARTITION BY session_id ORDER BY time, event_id) AS c FROM e),
q AS (SELECT session_id, c, min(i) AS start_index, max(i) AS end_index, min(time) AS start_time, max(time) AS end_time, count(*) AS number_of_samples, min(value) AS minimum_position, max(value) AS maximum_position, avg(value) AS mean_position
 FROM n WHERE c > 0 AND (moving OR falling) GROUP BY session_id, c HAVING bool_or(falling)),
cyc AS (SELECT session_id, row_number() OVER (ORDER BY session_id, start_time, c) AS cycle_id, start_index, end_index, start_time, end_time, date_diff('microsecond', start_time, end_time) / 1e6 AS duration_seconds, number_of_samples, minimum_position, maximum_position, mean_position FROM q)"""
_IN = f"{_CYC}, x AS (SELECT c.session_id, c.cycle_id, c.start_time, c.end_time, ev.time, ev.value, ev.signal_name, ev.event_id FROM ev JOIN cyc c ON ev.time BETWEEN c.start_time AND c.end_time)"
_SUM = f"""{_IN}, names AS (SELECT DISTINCT signal_name FROM ev), agg AS (SELECT cycle_id, signal_name, count(*) AS sample_count, count(value) AS finite_sample_count, min(time) AS first_time, max(time) AS last_time, min(value) AS minimum_value, max(value) AS maximum_value FROM x GROUP BY ALL),
summ AS (SELECT session_id, cycle_id, signal_name, coalesce(sample_count, 0) AS sample_count, coalesce(finite_sample_count, 0) AS finite_sample_count, first_time, last_time, minimum_value, maximum_value, sample_count IS NULL AS is_missing FROM cyc CROSS JOIN names LEFT JOIN agg USING (cycle_id, signal_name))"""
_QUAL = f"""{_IN}, y AS (SELECT *, date_diff('microsecond', lag(time) OVER (PARTITION BY cycle_id, signal_name ORDER BY time, value), time) AS gap FROM x), names AS (SELECT DISTINCT signal_name FROM x),
a AS (SELECT cycle_id, signal_name, count(*) AS sample_count, count(value) AS finite_sample_count, date_diff('microsecond', min(time), max(time)) / 1e6 AS duration_seconds, coalesce(max(gap), 0) / 1e6 AS maximum_timestamp_gap, coalesce(avg(gap), 0) / 1e6 AS mean_timestamp_gap, median(gap) / 1e6 AS median_sampling_interval,
 avg(value) AS mean_value, stddev_pop(value) AS standard_deviation, min(value) AS minimum_value, max(value) AS maximum_value, median(value) AS median_value, count(*) FILTER (WHERE gap = 0) AS duplicate_timestamp_count FROM y GROUP BY cycle_id, signal_name),
qual AS (SELECT c.cycle_id, c.session_id, names.signal_name, coalesce(sample_count, 0) AS sample_count, coalesce(finite_sample_count, 0) AS finite_sample_count, CAST(0 AS BIGINT) AS non_finite_count, a.duration_seconds, maximum_timestamp_gap, mean_timestamp_gap, median_sampling_interval, mean_value, standard_deviation, minimum_value, maximum_value, median_value, maximum_value - minimum_value AS signal_range,
 CASE WHEN a.duration_seconds > 0 THEN (sample_count - 1) / a.duration_seconds END AS estimated_sampling_rate, coalesce(duplicate_timestamp_count, 0) AS duplicate_timestamp_count, coalesce(finite_sample_count > 1 AND minimum_value = maximum_value, false) AS is_constant, CASE WHEN c.duration_seconds > 0 THEN a.duration_seconds / c.duration_seconds END AS coverage_ratio, sample_count IS NULL AS missing_signal
 FROM cyc c CROSS JOIN names LEFT JOIN a USING (cycle_id, signal_name))"""


def _round(*cols: str) -> str:
    return ", ".join(f"round({c}, {9 if c in FINE else 6}) AS {c}" for c in cols)


# A: scans ------------------------------------------------------------------------------------------------------------


@query("SELECT event_id, ts AS time, round(value, 6) AS value FROM events WHERE event_type = 'click' AND ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-12'")
def bounded_scan(spark, d):
    from datetime import datetime

    df = store.bounded_scan(events(spark, d), datetime(2024, 1, 5), datetime(2024, 1, 12), where=F.col("signal_name") == "click")
    return rounded(df.select("event_id", "time", "value"))


@query("SELECT event_type AS signal_name, count(*) AS row_count FROM events GROUP BY 1")
def signal_inventory(spark, d):
    return events(spark, d).groupBy("signal_name").agg(F.count("*").alias("row_count"))


@query("SELECT event_type AS signal_name, count(*) AS row_count, min(ts) AS min_time, max(ts) AS max_time FROM events GROUP BY 1")
def time_coverage(spark, d):
    return store.time_coverage(events(spark, d), ["signal_name"])


@query("SELECT CAST(sum(c) AS BIGINT) AS row_count, min(lo) AS min_time, max(hi) AS max_time FROM (SELECT count(*) AS c, min(ts) AS lo, max(ts) AS hi FROM events)")
def footer_statistics(spark, d):
    out = store.row_group_bounds(spark, f"{d}/events.parquet", "ts")
    return out.agg(F.sum("row_count").alias("row_count"), F.min("min_time").alias("min_time"), F.max("max_time").alias("max_time"))


@query("SELECT p_partkey, p_type FROM part WHERE regexp_matches(p_type, '(?i)^(standard|pro).*(d|o)$')")
def find_signals_regex(spark, d):
    return read(spark, d, "part").where(F.col("p_type").isNotNull() & F.col("p_type").rlike("(?i)^(standard|pro).*(d|o)$")).select("p_partkey", "p_type")


@query("SELECT p_partkey, replace(lower(trim(p_name)), ' ', '_') AS slug, list_extract(string_split(p_type, ' '), -1) AS leaf, CAST(len(list_filter(string_split(p_type, ' '), lambda x: x <> '')) AS INTEGER) AS n_parts, contains(lower(p_name), 'red') AS has_red FROM part")
def leaf_and_slug(spark, d):
    return read(spark, d, "part").select("p_partkey", slug("p_name").alias("slug"), leaf("p_type", " ").alias("leaf"), F.size(parts("p_type", " ")).alias("n_parts"), contains_folded("p_name", "Red").alias("has_red"))


@query("SELECT event_type AS signal_name, count(*) AS n, count(*) FILTER (WHERE value IS NOT NULL AND NOT isnan(value) AND NOT isinf(value)) AS finite_n FROM events GROUP BY 1")
def finite_filter(spark, d):
    return events(spark, d).groupBy("signal_name").agg(F.count("*").alias("n"), F.count_if(finite("value")).alias("finite_n"))


# B: catalogue --------------------------------------------------------------------------------------------------------

_NODES = "nodes AS (SELECT 'R' || r_regionkey AS node_id, r_name AS name, NULL AS parent FROM region UNION ALL SELECT 'N' || n_nationkey, n_name, 'R' || n_regionkey FROM nation UNION ALL SELECT 'C' || c_custkey, c_name, 'N' || c_nationkey FROM customer)"
_PATHS = f"{_NODES}, paths AS (SELECT node_id, name AS path, 1 AS depth FROM nodes WHERE parent IS NULL OR parent NOT IN (SELECT node_id FROM nodes) UNION ALL SELECT n.node_id, p.path || '/' || n.name, depth + 1 FROM nodes n JOIN paths p ON n.parent = p.node_id)"
_UNITS = "units AS (SELECT DISTINCT c_mktsegment AS common_code, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN '' ELSE substr(c_mktsegment, 1, 3) END AS symbol, lower(c_mktsegment) AS name FROM customer)"


def nodes(spark, d) -> DataFrame:
    r = read(spark, d, "region").select(F.concat(F.lit("R"), "r_regionkey").alias("node_id"), F.col("r_name").alias("name"), F.lit(None).cast("string").alias("parent_node"))
    n = read(spark, d, "nation").select(F.concat(F.lit("N"), "n_nationkey"), "n_name", F.concat(F.lit("R"), "n_regionkey"))
    c = read(spark, d, "customer").select(F.concat(F.lit("C"), "c_custkey"), "c_name", F.concat(F.lit("N"), "c_nationkey"))
    return r.union(n).union(c)


def units(spark, d) -> DataFrame:
    seg = F.col("c_mktsegment")
    return read(spark, d, "customer").select(seg.alias("common_code"), F.when(seg.isin("BUILDING", "MACHINERY"), "").otherwise(F.substring(seg, 1, 3)).alias("symbol"), F.lower(seg).alias("name")).distinct()


def signals(spark, d) -> DataFrame:
    return read(spark, d, "customer").select(F.col("c_custkey").alias("signal_id"), F.lit(None).cast("string").alias("signal_id_uuid"), F.concat(F.lit("C"), "c_custkey").alias("node_id_uuid"), F.col("c_mktsegment").alias("unit_code"))


@query(f"WITH RECURSIVE {_PATHS} SELECT node_id, path FROM paths")
def node_paths(spark, d):
    return catalog.node_paths(nodes(spark, d))


@query(f"WITH RECURSIVE {_PATHS}, {_UNITS} SELECT c_custkey AS signal_id, CAST(NULL AS VARCHAR) AS signal_id_uuid, 'C' || c_custkey AS node_id_uuid, c_mktsegment AS unit_code, coalesce(nullif(trim(symbol), ''), nullif(trim(u.name), ''), common_code) AS unit_symbol, path FROM customer LEFT JOIN paths p ON p.node_id = 'C' || c_custkey LEFT JOIN units u ON u.common_code = c_mktsegment")
def signal_catalogue(spark, d):
    return catalog.signal_catalogue(signals(spark, d), catalog.node_paths(nodes(spark, d)), units(spark, d))


@query(f"WITH RECURSIVE {_PATHS} SELECT DISTINCT string_split(path, '/')[2] AS experiment FROM paths WHERE len(string_split(path, '/')) >= 2")
def experiment_list(spark, d):
    return catalog.experiments(catalog.node_paths(nodes(spark, d)))


@query(f"WITH RECURSIVE {_PATHS} SELECT c_custkey AS signal_id, replace(lower(c_mktsegment), ' ', '_') || '_' || replace(lower(trim(list_extract(string_split(path, '/'), -1))), ' ', '_') AS base_name FROM customer JOIN paths ON node_id = 'C' || c_custkey")
def signal_names_base(spark, d):
    cat = catalog.signal_catalogue(signals(spark, d), catalog.node_paths(nodes(spark, d)), units(spark, d))
    return cat.withColumn("source", F.lit("int")).select("signal_id", catalog.base_name().alias("base_name"))


@query(f"WITH RECURSIVE {_PATHS} SELECT c_custkey AS signal_id, path FROM customer JOIN paths ON node_id = 'C' || c_custkey WHERE regexp_matches(path, '(?i)^europe/') AND regexp_matches(c_mktsegment, '(?i)auto|house')")
def find_signals(spark, d):
    cat = catalog.signal_catalogue(signals(spark, d), catalog.node_paths(nodes(spark, d)), units(spark, d))
    return catalog.find_signals(cat, path="^europe/", unit="auto|house").select("signal_id", "path")


# C: gaps -------------------------------------------------------------------------------------------------------------


def histogram(spark, d):
    return temporal.gap_histogram(temporal.gaps(clicks(spark, d), [], ORDER))


@query(f"WITH {_HIST} SELECT gap_us, gap_count FROM h")
def gap_histogram_us(spark, d):
    return histogram(spark, d)


_GSTAT = "round(min(gap_us) / 1e6, 6) AS minimum_gap_seconds, round(max(gap_us) / 1e6, 6) AS maximum_gap_seconds, round(avg(gap_us) / 1e6, 6) AS mean_gap_seconds, round(median(gap_us / 1e6), 6) AS median_gap_seconds, round(quantile_cont(gap_us / 1e6, 0.95), 6) AS p95_gap_seconds, round(quantile_cont(gap_us / 1e6, 0.99), 6) AS p99_gap_seconds"


@query(f"WITH {_GAPS} SELECT count(gap_us) AS gap_count, {_GSTAT} FROM g WHERE gap_us IS NOT NULL")
def gap_stats(spark, d):
    return rounded(temporal.gap_statistics(histogram(spark, d)))


@query(f"WITH {_EV}, g AS (SELECT signal_name, date_diff('microsecond', lag(time) OVER (PARTITION BY signal_name ORDER BY time, event_id), time) AS gap_us FROM ev) SELECT signal_name, round(quantile_cont(gap_us / 1e6, 0.5), 6) AS p50, round(quantile_cont(gap_us / 1e6, 0.9), 6) AS p90 FROM g WHERE gap_us IS NOT NULL GROUP BY 1")
def gap_weighted_quantiles(spark, d):
    h = temporal.gap_histogram(temporal.gaps(events(spark, d), ["signal_name"], ORDER), ["signal_name"])
    s = F.col("gap_us") / 1e6
    return rounded(h.groupBy("signal_name").agg(F.percentile(s, F.lit(0.5), F.col("gap_count")).alias("p50"), F.percentile(s, F.lit(0.9), F.col("gap_count")).alias("p90")))


@query(f"WITH {_GAPS}, t AS (SELECT unnest([1, 5, 10, 30, 60, 300, 900, 1800, 3600, 21600, 86400]) AS t) SELECT CAST(t AS BIGINT) AS threshold_seconds, (SELECT count(*) FROM g WHERE gap_us > CAST(t AS BIGINT) * 1000000) AS gap_count FROM t")
def gap_threshold_counts(spark, d):
    return temporal.gap_threshold_counts(histogram(spark, d))


@query(f"WITH {_HIST} SELECT CAST(CASE WHEN gap_us / 1e6 < 0 THEN 0 WHEN gap_us / 1e6 >= 7200 THEN 81 ELSE floor(gap_us / 1e6 * 80 / 7200.0) + 1 END AS BIGINT) AS bin, CAST(sum(gap_count) AS BIGINT) AS gap_count FROM h GROUP BY 1")
def gap_bins(spark, d):
    return temporal.gap_bins(histogram(spark, d), 80, 7200.0)


# D: sessions, cycles, intervals --------------------------------------------------------------------------------------


@query(f"WITH {_SES} SELECT session_id, start_time, end_time, {_round('duration_seconds')}, number_of_samples, {_round('maximum_internal_gap_seconds')} FROM ses")
def sessions(spark, d):
    return rounded(found_sessions(spark, d))


@query(f"WITH {_SES} SELECT count(*) AS session_count, round(min(duration_seconds), 6) AS minimum_duration_seconds, round(median(duration_seconds), 6) AS median_duration_seconds, round(max(duration_seconds), 6) AS maximum_duration_seconds, min(number_of_samples) AS minimum_samples, median(number_of_samples) AS median_samples, max(number_of_samples) AS maximum_samples, round(max(maximum_internal_gap_seconds), 6) AS maximum_internal_gap_seconds FROM ses")
def session_summary(spark, d):
    return rounded(temporal.session_summary(found_sessions(spark, d)))


@query(f"WITH {_CYC} SELECT session_id, cycle_id, start_index, end_index, start_time, end_time, {_round('duration_seconds')}, number_of_samples, {_round('minimum_position', 'maximum_position', 'mean_position')} FROM cyc")
def cycles(spark, d):
    return rounded(found_cycles(spark, d))


@query(f"WITH {_EDGE} SELECT event_id, session_id, moving, rising, falling FROM e WHERE rising OR falling")
def cycle_edges(spark, d):
    return temporal.edges(tagged(spark, d), ["session_id"], ORDER, THRESHOLD).where("rising OR falling").select("event_id", "session_id", "moving", "rising", "falling")


@query(f"WITH {_EV}, g AS (SELECT *, date_diff('microsecond', lag(time) OVER w, time) AS gap_us FROM ev WINDOW w AS (PARTITION BY signal_name ORDER BY time, event_id)) SELECT event_id, CAST(sum(CASE WHEN gap_us > 1800000000 THEN 1 ELSE 0 END) OVER (PARTITION BY signal_name ORDER BY time, event_id) AS BIGINT) AS burst_id FROM g")
def bursts(spark, d):
    return temporal.bursts(events(spark, d), ["signal_name"], ORDER, 1800.0).select("event_id", "burst_id")


@query(f"""WITH {_CYC}, o AS (SELECT *, max(end_time) OVER (ORDER BY start_time, end_time ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM cyc), i AS (SELECT *, sum(CASE WHEN reach IS NULL OR date_diff('microsecond', reach, start_time) > 3600000000 THEN 1 ELSE 0 END) OVER (ORDER BY start_time, end_time) AS island FROM o)
SELECT min(start_time) AS start_time, max(end_time) AS end_time, count(*) AS intervals FROM i GROUP BY island""")
def merge_intervals(spark, d):
    return temporal.merge_intervals(found_cycles(spark, d), [], 3600.0).select("start_time", "end_time", "intervals")


@query(f"WITH {_CYC}, r AS (SELECT min(time) AS min_time, max(time) AS max_time FROM ev WHERE signal_name = 'view' GROUP BY date_trunc('hour', time)) SELECT cycle_id FROM cyc WHERE EXISTS (SELECT 1 FROM r WHERE min_time <= end_time AND max_time >= start_time)")
def session_overlap(spark, d):
    hours = events(spark, d).where("signal_name = 'view'").groupBy(F.date_trunc("HOUR", "time").alias("h")).agg(F.min("time").alias("min_time"), F.max("time").alias("max_time"))
    return temporal.overlap_exists(found_cycles(spark, d).select("cycle_id", "start_time", "end_time"), hours).select("cycle_id")


@query(f"""WITH {_CYC}, v AS (SELECT time, max(value) AS value FROM ev WHERE signal_name = 'view' GROUP BY time), b AS (SELECT c.cycle_id, c.start_time, v.time AS bt, v.value AS bv FROM cyc c ASOF LEFT JOIN v ON c.start_time >= v.time), a AS (SELECT c.cycle_id, v.time AS nt, v.value AS nv FROM cyc c ASOF LEFT JOIN v ON c.start_time < v.time)
SELECT cycle_id, CASE WHEN nt IS NULL OR date_diff('microsecond', bt, start_time) <= date_diff('microsecond', start_time, nt) THEN bt ELSE nt END AS nearest_time, round(CASE WHEN nt IS NULL OR date_diff('microsecond', bt, start_time) <= date_diff('microsecond', start_time, nt) THEN bv ELSE nv END, 6) AS nearest_value FROM b JOIN a USING (cycle_id)""")
def nearest_value(spark, d):
    views = events(spark, d).where("signal_name = 'view'").select("time", "value")
    return rounded(temporal.nearest(found_cycles(spark, d).select("cycle_id", "start_time"), views, "start_time").select("cycle_id", "nearest_time", "nearest_value"))


@query(f"WITH {_CYC} SELECT session_id, min(start_time) AS start_time, max(end_time) + INTERVAL 1 MICROSECOND AS end_time, count(*) AS cycles FROM cyc GROUP BY 1")
def session_bounds(spark, d):
    return store.session_bounds(found_cycles(spark, d))


@query(f"WITH {_GAPS}, r AS (SELECT event_id, row_number() OVER (ORDER BY time, event_id) - 1 AS i, count(*) OVER () AS n FROM cl) SELECT event_id FROM r WHERE n <= 500 OR i IN (SELECT CAST(floor(k * (n - 1) / 499) AS BIGINT) FROM range(500) t(k))")
def evenly_spaced_sample(spark, d):
    return temporal.evenly_spaced(clicks(spark, d), ORDER, 500).select("event_id")


@query(f"""WITH {_CYC}, f AS (SELECT * FROM cyc ORDER BY start_time, cycle_id LIMIT 5), b AS (SELECT min(start_time) - INTERVAL 1 SECOND AS a, arg_max(end_time, (start_time, cycle_id)) + INTERVAL 1 SECOND AS z FROM f)
SELECT event_id, time FROM cl, b WHERE time BETWEEN a AND z""")
def validation_subset(spark, d):
    return temporal.around(clicks(spark, d), found_cycles(spark, d), 5)[0].select("event_id", "time")


@query(f"""WITH {_EV}, g AS (SELECT signal_name, date_diff('microsecond', lag(time) OVER (PARTITION BY signal_name ORDER BY time, event_id), time) / 1e3 AS ms FROM ev)
SELECT signal_name, count(*) AS row_count, round(min(ms), 6) AS minimum_interval_ms, round(median(ms), 6) AS median_interval_ms, round(max(ms), 6) AS maximum_interval_ms FROM g GROUP BY 1""")
def interval_summary(spark, d):
    return rounded(temporal.interval_summary(temporal.gaps(events(spark, d), ["signal_name"], ORDER), ["signal_name"]))


_BY_TYPE = f"""{_EV}, g AS (SELECT *, date_diff('microsecond', lag(time) OVER (PARTITION BY signal_name ORDER BY time, value), time) AS gap_us FROM ev WHERE time IS NOT NULL AND value IS NOT NULL AND NOT isnan(value)),
t AS (SELECT *, 1 + sum(CASE WHEN gap_us > 7200000000 THEN 1 ELSE 0 END) OVER (PARTITION BY signal_name ORDER BY time, value) AS session_id FROM g),
ses AS (SELECT signal_name, session_id, date_diff('microsecond', min(time), max(time)) / 1e6 AS duration_seconds, count(*) AS n, coalesce(max(gap_us) FILTER (WHERE gap_us <= 7200000000), 0) / 1e6 AS internal FROM t GROUP BY 1, 2)"""
_KEYED = "signal_name AS experiment, signal_name AS signal_id_uuid"


def report(spark, d):
    """Each event type plays the reference signal of an experiment of its own; one that is in no table has no samples."""
    rows = events(spark, d).withColumns({"experiment": F.col("signal_name"), "signal_id_uuid": F.col("signal_name")})
    names = spark.createDataFrame([(s, s) for s in [*SIGNALS, "absent"]], "experiment string, signal_id_uuid string")
    return dataset.sampling_and_sessions(rows.select("experiment", "signal_id_uuid", "time", "value"), names, GAP)


@query(f"""WITH {_BY_TYPE} SELECT {_KEYED}, count(*) AS number_of_samples, round(min(gap_us) / 1e6, 6) AS minimum_gap_seconds, round(quantile_cont(gap_us / 1e6, 0.5), 6) AS median_gap_seconds, round(avg(gap_us) / 1e6, 6) AS mean_gap_seconds,
round(quantile_cont(gap_us / 1e6, 0.95), 6) AS percentile_95_gap_seconds, round(quantile_cont(gap_us / 1e6, 0.99), 6) AS percentile_99_gap_seconds, round(max(gap_us) / 1e6, 6) AS maximum_gap_seconds FROM g GROUP BY signal_name
UNION ALL SELECT 'absent', 'absent', 0, NULL, NULL, NULL, NULL, NULL, NULL""")
def experiment_sampling(spark, d):
    return rounded(report(spark, d)[0])


@query(f"""WITH {_BY_TYPE} SELECT {_KEYED}, count(*) AS number_of_sessions, round(min(duration_seconds), 6) AS minimum_duration_seconds, round(median(duration_seconds), 6) AS median_duration_seconds, round(max(duration_seconds), 6) AS maximum_duration_seconds,
min(n) AS minimum_samples, round(median(n), 6) AS median_samples, max(n) AS maximum_samples, round(max(internal), 6) AS maximum_internal_gap_seconds FROM ses GROUP BY signal_name
UNION ALL SELECT 'absent', 'absent', 0, NULL, NULL, NULL, NULL, NULL, NULL, NULL""")
def experiment_sessions(spark, d):
    return rounded(report(spark, d)[2])


@query(f"""WITH {_BY_TYPE}, r AS (SELECT signal_name AS experiment, count(*) AS n FROM g GROUP BY 1 UNION ALL SELECT 'absent', 0) SELECT experiment, place, metric, CASE WHEN metric = 'signal_id_uuid' THEN experiment ELSE CAST(n AS VARCHAR) END AS value FROM r, (VALUES (0, 'signal_id_uuid'), (1, 'number_of_samples')) m(place, metric)""")
def gap_report_rows(spark, d):
    return dataset.gap_report(report(spark, d)[0]).where("place < 2").withColumn("place", F.col("place").cast("int"))


# E: extraction and profile -------------------------------------------------------------------------------------------


@query(f"WITH {_IN} SELECT session_id, cycle_id, signal_name, event_id, round(value, 6) AS value FROM x")
def cycle_measurements(spark, d):
    return rounded(inside(spark, d)[0].select("session_id", "cycle_id", "signal_name", "event_id", "value"))


@query(f"WITH {_SUM} SELECT session_id, cycle_id, signal_name, sample_count, finite_sample_count, first_time, last_time, {_round('minimum_value', 'maximum_value')}, is_missing FROM summ")
def window_summary(spark, d):
    found, cyc = inside(spark, d)
    return rounded(extract.window_summary(found, cyc, events(spark, d).select("signal_name")))


@query(f"""WITH {_IN}, p AS (SELECT cycle_id, row_number() OVER (ORDER BY start_time, session_id, cycle_id) AS i FROM cyc), wr AS (SELECT cycle_id, count(*) AS n FROM x GROUP BY 1)
SELECT CAST((i - 1) // 50 AS BIGINT) AS batch_id, count(*) AS cycle_count, arg_min(cycle_id, i) AS first_cycle_id, arg_max(cycle_id, i) AS last_cycle_id, CAST(coalesce(sum(n), 0) AS BIGINT) AS written_rows FROM p LEFT JOIN wr USING (cycle_id) GROUP BY 1""")
def batch_summary(spark, d):
    found, cyc = inside(spark, d)
    return extract.batch_summary(found, cyc, 50)


_QCOLS = ("duration_seconds", "maximum_timestamp_gap", "mean_timestamp_gap", "median_sampling_interval", "mean_value", "standard_deviation", "minimum_value", "maximum_value", "median_value", "signal_range", "estimated_sampling_rate", "coverage_ratio")


@query(f"WITH {_QUAL} SELECT cycle_id, session_id, signal_name, sample_count, finite_sample_count, non_finite_count, {_round(*_QCOLS)}, duplicate_timestamp_count, is_constant, missing_signal FROM qual")
def signal_quality(spark, d):
    return rounded(quality(spark, d)[0])


_PROF = f"""{_QUAL}, prof AS (SELECT cycle_id, count(*) AS expected_signal_count, count(*) FILTER (WHERE NOT missing_signal) AS present_signal_count, count(*) FILTER (WHERE missing_signal) AS missing_signal_count, coalesce(string_agg(signal_name, ',' ORDER BY signal_name) FILTER (WHERE missing_signal), '') AS missing_signal_names, count(*) FILTER (WHERE is_constant) AS constant_signal_count,
min(sample_count) FILTER (WHERE NOT missing_signal) AS min_sample_count, avg(sample_count) FILTER (WHERE NOT missing_signal) AS mean_sample_count, max(sample_count) FILTER (WHERE NOT missing_signal) AS max_sample_count, min(coverage_ratio) AS min_coverage_ratio, avg(coverage_ratio) AS mean_coverage_ratio, max(coverage_ratio) AS max_coverage_ratio, max(signal_range) FILTER (WHERE signal_name = 'click') AS position_stroke_range FROM qual GROUP BY cycle_id)"""


@query(f"WITH {_PROF} SELECT p.cycle_id, session_id, {_round('duration_seconds').replace('AS duration_seconds', 'AS cycle_duration_seconds')}, expected_signal_count, present_signal_count, missing_signal_count, missing_signal_names, constant_signal_count, min_sample_count, {_round('mean_sample_count')}, max_sample_count, {_round('min_coverage_ratio', 'mean_coverage_ratio', 'max_coverage_ratio', 'position_stroke_range')} FROM prof p JOIN cyc USING (cycle_id)")
def cycle_profile(spark, d):
    q, cyc = quality(spark, d)
    out = profile.cycle_profile(q, cyc, "click")
    return rounded(out.select("cycle_id", "session_id", "cycle_duration_seconds", "expected_signal_count", "present_signal_count", "missing_signal_count", "missing_signal_names", "constant_signal_count", "min_sample_count", "mean_sample_count", "max_sample_count", "min_coverage_ratio", "mean_coverage_ratio", "max_coverage_ratio", "position_stroke_range"))


_METRICS = ("sample_count", "maximum_timestamp_gap", "mean_value", "signal_range", "coverage_ratio")
_TALL = " UNION ALL ".join(f"SELECT signal_name, '{m}' AS metric, CAST({m} AS DOUBLE) AS x FROM qual WHERE NOT missing_signal" for m in _METRICS)


@query(f"WITH {_QUAL}, t AS ({_TALL}) SELECT signal_name, metric, count(x) AS count, round(avg(x), 6) AS mean, round(coalesce(stddev_samp(x), 0), 6) AS std, round(min(x), 6) AS min, round(max(x), 6) AS max, " + ", ".join(f"round(quantile_cont(x, {p / 100}), 6) AS p{p}" for p in profile.PERCENTILES) + " FROM t WHERE x IS NOT NULL GROUP BY 1, 2")
def metric_distribution(spark, d):
    return rounded(profile.metric_distribution(quality(spark, d)[0], _METRICS))


_FEATURES = ", ".join(f"count(value) FILTER (WHERE signal_name = '{n}') = 0 AS {n}_is_missing, count(value) FILTER (WHERE signal_name = '{n}') AS {n}_count, " + ", ".join(f"round({f} FILTER (WHERE signal_name = '{n}'){')' * (s == 'rms')}, 6) AS {n}_{s}" for s, f in (("min", "min(value)"), ("max", "max(value)"), ("mean", "avg(value)"), ("std", "stddev_pop(value)"), ("rms", "sqrt(avg(value * value)"))) for n in SIGNALS)


@query(f"WITH {_IN} SELECT session_id, cycle_id, start_time, end_time, round(any_value(duration_seconds), 6) AS duration_seconds, {_FEATURES} FROM cyc c LEFT JOIN (SELECT cycle_id, signal_name, value FROM x) USING (cycle_id) GROUP BY session_id, cycle_id, start_time, end_time")
def cycle_features_wide(spark, d):
    found, cyc = inside(spark, d)
    return rounded(profile.feature_table(found, cyc, SIGNALS))


_HAS = ", ".join(f"coalesce(bool_or(NOT is_missing) FILTER (WHERE signal_name = '{n}'), false) AS has_{n}" for n in OTHERS)


@query(f"WITH {_SUM} SELECT cycle_id, {_HAS}, coalesce(bool_or(NOT is_missing) FILTER (WHERE signal_name <> 'click'), false) AS has_any FROM summ GROUP BY cycle_id")
def coverage_pivot(spark, d):
    found, cyc = inside(spark, d)
    return profile.presence_pivot(extract.window_summary(found, cyc, events(spark, d).select("signal_name")).where("signal_name <> 'click'"), OTHERS)


# F: rules, validation, selection -------------------------------------------------------------------------------------

_AXES = "('signup', 'view')"
_CLASS = f"""{_PROF}, least AS (SELECT signal_name, greatest(1.0, 0.5 * coalesce(median(sample_count) FILTER (WHERE sample_count > 0), 0)) AS least FROM qual WHERE signal_name IN {_AXES} GROUP BY 1),
cls AS (SELECT cycle_id, CASE WHEN coalesce(sum(sample_count), 0) = 0 THEN 'vibration_unavailable' WHEN count(*) FILTER (WHERE finite_sample_count > 0 AND sample_count >= least) = 2 THEN 'vibration_complete' ELSE 'vibration_partial' END AS vibration_class FROM cyc LEFT JOIN (qual JOIN least USING (signal_name)) USING (cycle_id) GROUP BY 1)"""


@query(f"WITH {_CLASS} SELECT cycle_id, vibration_class FROM cls")
def availability_class(spark, d):
    q, cyc = quality(spark, d)
    return rules.availability(q, cyc, CONFIG.vibration)


_VALUES = " UNION ALL ".join([f"SELECT 'core' AS scope, signal_name, '{m}' AS metric, CAST({m} AS DOUBLE) AS x FROM qual WHERE signal_name IN ('click', 'error', 'purchase')" for m in rules.SIGNAL_METRICS] + [f"SELECT 'vibration', signal_name, '{m}', CAST({m} AS DOUBLE) FROM qual JOIN cls USING (cycle_id) WHERE signal_name IN {_AXES} AND vibration_class = 'vibration_complete'" for m in rules.SIGNAL_METRICS] + ["SELECT 'cycle', '', 'cycle_duration_seconds', duration_seconds FROM cyc", "SELECT 'cycle', '', 'position_stroke_range', position_stroke_range FROM prof"])
_RULES = f"""{_CLASS}, vals AS ({_VALUES}), f AS (SELECT scope, signal_name, metric, count(x) AS reference_count, median(x) AS median, quantile_cont(x, 0.01) AS q_lo, quantile_cont(x, 0.99) AS q_hi, mad(x) AS mad FROM vals GROUP BY 1, 2, 3),
st AS (SELECT *, CASE WHEN reference_count < 20 THEN 'skipped_insufficient_data' WHEN mad > 0 THEN 'learned' WHEN q_lo = q_hi THEN 'skipped_constant' ELSE 'learned' END AS status FROM f),
ru AS (SELECT scope, signal_name, metric, reference_count, median, mad, CASE WHEN status = 'learned' THEN CASE WHEN mad > 0 THEN median - 3.5::DOUBLE / 0.6745::DOUBLE * mad ELSE q_lo END END AS lower_bound, CASE WHEN status = 'learned' THEN CASE WHEN mad > 0 THEN median + 3.5::DOUBLE / 0.6745::DOUBLE * mad ELSE q_hi END END AS upper_bound,
 CASE WHEN status = 'learned' THEN CASE WHEN mad > 0 THEN 'median_mad' ELSE 'quantile' END END AS method, coalesce(status = 'learned' AND mad = 0, false) AS fallback_used, status FROM st)"""


def frozen(spark, d):
    """Quality, profile, classes and rules; rules are written and read back, never recomputed."""
    q, cyc = quality(spark, d)
    q = freeze(q)
    prof = freeze(profile.cycle_profile(q, cyc, "click"))
    classes = freeze(rules.availability(q, cyc, CONFIG.vibration))
    learned = freeze(rules.learned_rules(rules.reference_values(q, prof, classes, CONFIG), CONFIG))
    return q, prof, classes, learned


@query(f"WITH {_RULES} SELECT scope, signal_name, metric, reference_count, {_round('median', 'mad', 'lower_bound', 'upper_bound')}, method, fallback_used, status FROM ru")
def learned_rules(spark, d):
    return rounded(frozen(spark, d)[3].withColumn("fallback_used", F.coalesce("fallback_used", F.lit(False))))


#: Fixed values, written out for the SQL alone: metric, reason below, reason above.
_SQL_CHECKS = (
    ("sample_count", "sample_count_below_lower_bound", "sample_count_above_upper_bound"),
    ("finite_sample_count", "sample_count_below_lower_bound", "sample_count_above_upper_bound"),
    ("coverage_ratio", "coverage_below_lower_bound", None),
    ("maximum_timestamp_gap", None, "maximum_gap_above_upper_bound"),
    ("signal_range", "signal_range_below_lower_bound", "signal_range_above_upper_bound"),
)


def _check_sql(scope: str, signals: tuple) -> str:
    cases = []
    for m, low, high in _SQL_CHECKS:
        bound = lambda b: f"(SELECT {b} FROM ru WHERE ru.scope = '{scope}' AND ru.signal_name = q.signal_name AND ru.metric = '{m}')"  # noqa: E731, B023
        if low:
            cases.append(f"CASE WHEN {m} < {bound('lower_bound')} THEN '{low}' END")
        if high:
            cases.append(f"CASE WHEN {m} > {bound('upper_bound')} THEN '{high}' END")
    names = ", ".join(f"('{s}')" for s in signals)
    grid = f"(SELECT g.cycle_id, g.signal_name, qual.* EXCLUDE (cycle_id, signal_name) FROM (SELECT cycle_id, s AS signal_name FROM cyc, (VALUES {names}) v(s)) g LEFT JOIN qual USING (cycle_id, signal_name)) q"
    return f"SELECT cycle_id, signal_name, CASE WHEN coalesce(missing_signal, true) THEN ['missing_required_signal'] WHEN finite_sample_count <= 0 THEN ['no_finite_values'] ELSE list_filter([{', '.join(cases)}], lambda z: z IS NOT NULL) END AS r FROM {grid}"


_VALID = f"""{_RULES}, core AS ({_check_sql("core", CONFIG.core)}), vib AS ({_check_sql("vibration", CONFIG.vibration)}),
cr AS (SELECT cycle_id, flatten(list(list_transform(r, lambda z: signal_name || ':' || z) ORDER BY signal_name)) AS core_reasons FROM core GROUP BY 1), vb AS (SELECT cycle_id, bool_or(len(r) > 0) AS axis_bad FROM vib GROUP BY 1),
b AS (SELECT max(lower_bound) FILTER (WHERE metric = 'cycle_duration_seconds') AS dl, max(upper_bound) FILTER (WHERE metric = 'cycle_duration_seconds') AS dh, max(lower_bound) FILTER (WHERE metric = 'position_stroke_range') AS sl, max(upper_bound) FILTER (WHERE metric = 'position_stroke_range') AS sh FROM ru WHERE scope = 'cycle'),
hard AS (SELECT cycle_id, cyc.session_id, list_filter([CASE WHEN start_time >= end_time THEN 'invalid_cycle_interval' END, CASE WHEN duration_seconds <= 0 THEN 'duration_below_lower_bound' END, CASE WHEN duration_seconds < dl THEN 'duration_below_lower_bound' END, CASE WHEN duration_seconds > dh THEN 'duration_above_upper_bound' END, CASE WHEN position_stroke_range < sl THEN 'position_stroke_out_of_range' END, CASE WHEN position_stroke_range > sh THEN 'position_stroke_out_of_range' END], lambda z: z IS NOT NULL) AS h FROM cyc LEFT JOIN prof USING (cycle_id), b),
val AS (SELECT cycle_id, session_id, vibration_class, array_to_string(list_concat(list_concat(h, core_reasons), CASE WHEN vibration_class <> 'vibration_complete' THEN [vibration_class] ELSE [] END), ',') AS reasons, CASE WHEN len(h) + len(core_reasons) > 0 THEN 'invalid_cycle' WHEN vibration_class = 'vibration_complete' AND NOT axis_bad THEN 'valid_complete_multisensor_cycle' ELSE 'valid_core_cycle' END AS final_class FROM hard JOIN cr USING (cycle_id) JOIN cls USING (cycle_id) JOIN vb USING (cycle_id))"""


@query(f"WITH {_VALID} SELECT cycle_id, session_id, vibration_class, reasons, final_class FROM val")
def cycle_validation(spark, d):
    return rules.cycle_validation(*frozen(spark, d), CONFIG)


@query(f"WITH {_VALID} SELECT final_class, count(*) AS cycles FROM val GROUP BY 1")
def class_split(spark, d):
    return rules.cycle_validation(*frozen(spark, d), CONFIG).groupBy("final_class").agg(F.count("*").alias("cycles"))


@query("""SELECT * FROM (VALUES ('cycle', 'interval_order', 'hard_interval_order', CAST(NULL AS DOUBLE)), ('cycle', 'duration_seconds', 'hard_positive_duration', 0.0), ('position', 'presence', 'hard_signal_presence', NULL),
('click', 'finite_values', 'hard_finite_required', NULL), ('error', 'finite_values', 'hard_finite_required', NULL), ('purchase', 'finite_values', 'hard_finite_required', NULL)) t(signal_name, metric, rule_type, lower_bound)""")
def hard_rules(spark, d):
    return rules.hard_rules(spark, CONFIG).select("signal_name", "metric", "rule_type", "lower_bound")


@query(f"WITH {_VALID} SELECT r AS reason, count(*) AS reason_count FROM (SELECT unnest(string_split(reasons, ',')) AS r FROM val) WHERE r <> '' GROUP BY 1")
def reason_counts(spark, d):
    return rules.reason_counts(rules.cycle_validation(*frozen(spark, d), CONFIG))


_COUNTED = f"{_IN}, cnt AS (SELECT c.*, " + ", ".join(f"(SELECT count(*) FROM x WHERE x.cycle_id = c.cycle_id AND x.signal_name = '{n}') AS {n}_sample_count" for n in ("error", "view")) + " FROM cyc c)"


def counted(spark, d):
    return select.window_counts(events(spark, d), found_cycles(spark, d), ["error", "view"])


@query(f"WITH {_COUNTED}, rd AS (SELECT *, error_sample_count >= 1 AND view_sample_count >= 1 AS ready FROM cnt), ri AS (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY start_time, cycle_id) - row_number() OVER (PARTITION BY session_id, ready ORDER BY start_time, cycle_id) AS run_id FROM rd) SELECT cycle_id, session_id, ready, run_id, CASE WHEN ready THEN count(*) OVER (PARTITION BY session_id, ready, run_id) ELSE 0 END AS run_length FROM ri")
def ready_block(spark, d):
    return select.ready_blocks(counted(spark, d), ["error", "view"], 3).select("cycle_id", "session_id", "ready", "run_id", "run_length")


def counted_clicks(spark, d, least):
    out = select.window_counts(clicks(spark, d), found_cycles(spark, d), ["click"])
    return select.validation_quality(out, ["click"], {"click": least})


_READY = f"""{_IN}, rd AS (SELECT c.*, (SELECT count(*) FROM x WHERE x.cycle_id = c.cycle_id AND x.signal_name = 'click') >= {{least}} AS ready FROM cyc c),
ri AS (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY start_time, cycle_id) - row_number() OVER (PARTITION BY session_id, ready ORDER BY start_time, cycle_id) AS run_id FROM rd),
rl AS (SELECT *, count(*) OVER (PARTITION BY session_id, ready, run_id) AS run_length FROM ri)"""


@query(f"""WITH {_COUNTED} SELECT cycle_id, error_sample_count < 2 AND error_sample_count > 0 OR view_sample_count < 2 AND view_sample_count > 0 AS short,
CASE WHEN (error_sample_count = 0 OR view_sample_count = 0) AND (error_sample_count = 1 OR view_sample_count = 1) THEN 'missing and insufficient required signals' WHEN error_sample_count = 0 OR view_sample_count = 0 THEN 'missing required signals'
WHEN error_sample_count = 1 OR view_sample_count = 1 THEN 'insufficient samples for required signals' ELSE '' END AS rejection_reason FROM cnt""")
def validation_quality(spark, d):
    out = select.validation_quality(counted(spark, d), ["error", "view"], {"error": 2, "view": 2})
    return out.select("cycle_id", (F.col("insufficient_required_signals") != "").alias("short"), "rejection_reason")


@query(f"""WITH {_READY.format(least=2)}, one AS (SELECT session_id, run_id FROM rl WHERE ready AND run_length >= 2 ORDER BY session_id, start_time, cycle_id LIMIT 1)
SELECT cycle_id FROM rl JOIN one USING (session_id, run_id) WHERE ready ORDER BY start_time, cycle_id LIMIT 2""")
def validation_block(spark, d):
    return select.validation_cycles(counted_clicks(spark, d, 2), 2, max_scan=None).select("cycle_id")


@query(f"WITH {_READY.format(least=3)} SELECT cycle_id FROM rl WHERE ready ORDER BY session_id, start_time, cycle_id LIMIT 2")
def validation_first_ready(spark, d):
    return select.validation_cycles(counted_clicks(spark, d, 3), 2, False, None).select("cycle_id")


@query(f"WITH {_CYC} SELECT cycle_id, row_number() OVER (ORDER BY session_id, start_time, cycle_id) AS selection_rank FROM cyc QUALIFY row_number() OVER (ORDER BY session_id, start_time, cycle_id) <= 40")
def selected_first_n(spark, d):
    return select.first_n(found_cycles(spark, d), 40).select("cycle_id", "selection_rank")


@query(f"WITH {_COUNTED} SELECT cycle_id, error_sample_count, view_sample_count, CASE WHEN start_time >= end_time THEN 'invalid_cycle_interval' ELSE concat_ws(',', CASE WHEN error_sample_count = 0 THEN 'missing_error' WHEN error_sample_count < 2 THEN 'insufficient_error_samples' END, CASE WHEN view_sample_count = 0 THEN 'missing_view' WHEN view_sample_count < 2 THEN 'insufficient_view_samples' END) END AS rejection_reasons, start_time < end_time AND error_sample_count >= 2 AND view_sample_count >= 2 AS eligible FROM cnt")
def candidate_eval(spark, d):
    out = select.candidate_evaluation(counted(spark, d), ["error", "view"], 2)
    return out.select("cycle_id", "error_sample_count", "view_sample_count", "rejection_reasons", "eligible")


@query(f"WITH {_CYC}, ses AS (SELECT session_id, min(time) AS a, max(time) AS z FROM s GROUP BY 1) SELECT cycle_id, CAST(CASE WHEN date_diff('microsecond', a, z) > 0 THEN least(greatest(floor(date_diff('microsecond', a, start_time) / date_diff('microsecond', a, z) * 5), 0), 4) ELSE 0 END AS BIGINT) AS stratum FROM cyc JOIN ses USING (session_id)")
def time_strata(spark, d):
    return select.time_strata(found_cycles(spark, d), found_sessions(spark, d), 5).select("cycle_id", "stratum")


@query(f"WITH {_IN}, vb AS (SELECT time, CAST(sum(CASE WHEN gap_us > 1800000000 THEN 1 ELSE 0 END) OVER (ORDER BY time, event_id) AS BIGINT) AS burst_id FROM (SELECT *, date_diff('microsecond', lag(time) OVER (ORDER BY time, event_id), time) AS gap_us FROM ev WHERE signal_name = 'view')) SELECT cycle_id, coalesce((SELECT arg_min(burst_id, vb.time) FROM vb WHERE vb.time BETWEEN c.start_time AND c.end_time), -1) AS burst_id FROM cyc c")
def cycle_burst(spark, d):
    b = temporal.bursts(events(spark, d).where("signal_name = 'view'"), [], ORDER, 1800.0)
    return select.first_burst(b, found_cycles(spark, d)).select("cycle_id", "burst_id")


@query(f"""WITH {_IN}, ses AS (SELECT session_id, min(time) AS a, max(time) AS z FROM s GROUP BY 1), vb AS (SELECT time, CAST(sum(CASE WHEN gap_us > 1800000000 THEN 1 ELSE 0 END) OVER (ORDER BY time, event_id) AS BIGINT) AS burst_id FROM (SELECT *, date_diff('microsecond', lag(time) OVER (ORDER BY time, event_id), time) AS gap_us FROM ev WHERE signal_name = 'view')),
p AS (SELECT cycle_id, session_id, CAST(CASE WHEN date_diff('microsecond', a, z) > 0 THEN least(greatest(floor(date_diff('microsecond', a, start_time) / date_diff('microsecond', a, z) * 5), 0), 4) ELSE 0 END AS BIGINT) AS stratum,
 coalesce((SELECT arg_min(burst_id, vb.time) FROM vb WHERE vb.time BETWEEN c.start_time AND c.end_time), -1) AS burst_id FROM cyc c JOIN ses USING (session_id) WHERE cycle_id <= 200)
SELECT 'session' AS kind, session_id AS id, count(*) AS cycles FROM p GROUP BY 2 UNION ALL SELECT 'time_stratum', stratum, count(*) FROM p GROUP BY 2 UNION ALL SELECT 'vibration_burst', burst_id, count(*) FROM p GROUP BY 2""")
def selection_counts(spark, d):
    b = temporal.bursts(events(spark, d).where("signal_name = 'view'"), [], ORDER, 1800.0)
    some = select.time_strata(select.first_burst(b, found_cycles(spark, d)), found_sessions(spark, d), 5)
    return select.selection_counts(some.withColumn("selection_rank", F.when(F.col("cycle_id") <= 200, F.col("cycle_id"))))


@query()
def selected_cycles(spark, d):
    """Seeded: rows are checked by count and by tests."""
    b = temporal.bursts(events(spark, d).where("signal_name = 'view'"), [], ORDER, 1800.0)
    some = select.candidate_evaluation(counted(spark, d), ["error", "view"], 1).where("eligible").drop("rejection_reasons")
    some = select.time_strata(select.first_burst(b, some), found_sessions(spark, d), 5)
    return select.select_cycles(some, 60, 4).select("cycle_id", "session_id", "stratum", "burst_id", "selection_rank", "rejection_reasons")


# F': arrays ----------------------------------------------------------------------------------------------------------


@query(f"WITH {_IN} SELECT cycle_id, count(*) AS cycle_length FROM x WHERE signal_name = 'click' GROUP BY 1")
def cycle_lengths(spark, d):
    return tensors.cycle_lengths(inside(spark, d)[0], "click")


@query(f"WITH {_IN}, l AS (SELECT cycle_id, count(*) AS c FROM x WHERE signal_name = 'click' GROUP BY 1) SELECT count(*) AS cycle_count, min(c) AS minimum_length, max(c) AS maximum_length, round(avg(c), 6) AS mean_length, round(median(c), 6) AS median_length, round(quantile_cont(c, 0.95), 6) AS p95_length, round(quantile_cont(c, 0.99), 6) AS p99_length, count(*) FILTER (WHERE c < 4) AS padded_count, count(*) FILTER (WHERE c > 4) AS truncated_count FROM l")
def length_stats(spark, d):
    return rounded(tensors.length_statistics(tensors.cycle_lengths(inside(spark, d)[0], "click"), 4))


def _tensor(spark, d):
    found, cyc = inside(spark, d)
    return tensors.cycle_tensors(found, cyc, ["click", "error"], 4, "click", per_file=100)


@query(f"""WITH {_IN}, v AS (SELECT cycle_id, signal_name, list(value ORDER BY time, value) AS v FROM x WHERE signal_name IN ('click', 'error') GROUP BY 1, 2), ok AS (SELECT cycle_id FROM v GROUP BY 1 HAVING count(*) = 2), p AS (SELECT unnest(range(4)) AS place)
SELECT cycle_id, signal_name, CAST(place AS INTEGER) AS place, round(v[least(place + 1, len(v))], 6) AS value, CAST(place < len(v) AS INTEGER) AS mask FROM v JOIN ok USING (cycle_id), p""")
def cycle_tensor(spark, d):
    out = _tensor(spark, d).where("skip_reason IS NULL")
    names = F.array(F.lit("click"), F.lit("error"))
    tall = out.select("cycle_id", F.posexplode(F.arrays_zip(F.col("values"), F.col("mask"), names.alias("name"))).alias("s", "x"))
    tall = tall.select("cycle_id", F.col("x.name").alias("signal_name"), F.posexplode(F.arrays_zip(F.col("x.values").alias("v"), F.col("x.mask").alias("m"))).alias("place", "y"))
    return rounded(tall.select("cycle_id", "signal_name", "place", F.col("y.v").alias("value"), F.col("y.m").cast("int").alias("mask")))


@query(f"WITH {_IN}, v AS (SELECT cycle_id, count(DISTINCT signal_name) AS n FROM x WHERE signal_name IN ('click', 'error') GROUP BY 1) SELECT cycle_id, CAST(floor((row_number() OVER (ORDER BY cycle_id) - 1) / 100) AS BIGINT) AS file_number, CASE WHEN coalesce(n, 0) < 2 THEN 'missing_required_signal' END AS skip_reason FROM cyc LEFT JOIN v USING (cycle_id)")
def tensor_files(spark, d):
    return _tensor(spark, d).select("cycle_id", "file_number", "skip_reason")


@query("SELECT vec_id, CAST(i AS INTEGER) AS place, CAST(embedding[least(i, len(embedding))] AS DOUBLE) AS padded FROM embeddings, range(62, 67) r(i)")
def array_padding(spark, d):
    from .functions.expr import pad_edge

    out = read(spark, d, "embeddings").select("vec_id", F.posexplode(pad_edge("embedding", 66)).alias("p", "v")).where("p >= 61")
    return out.select("vec_id", (F.col("p") + 1).alias("place"), F.col("v").cast("double").alias("padded"))


# Coverage diagnostic and relational extensions ------------------------------------------------------------------------


@query(f"WITH {_SES} SELECT signal_name, count(*) AS row_count, count(DISTINCT ses.session_id) AS sessions_covered, round(count(DISTINCT ses.session_id) / (SELECT count(*) FROM ses), 6) AS session_share FROM ev JOIN ses ON ev.time BETWEEN ses.start_time AND ses.end_time GROUP BY 1")
def session_coverage(spark, d):
    return rounded(coverage.session_coverage(events(spark, d), found_sessions(spark, d)))


_DAYS = "dy AS (SELECT signal_name, count(*) AS row_count, min(time) AS min_time, max(time) AS max_time FROM ev GROUP BY signal_name, date_trunc('day', time))"


@query(f"""WITH {_SES}, {_DAYS}, hit AS (SELECT DISTINCT signal_name, session_id FROM dy JOIN ses ON min_time <= end_time AND max_time >= start_time)
SELECT signal_name, min(min_time) AS first_raw_timestamp, max(max_time) AS last_raw_timestamp, CAST(coalesce(sum(row_count), 0) AS BIGINT) AS raw_sample_count,
coalesce((SELECT string_agg(CAST(session_id AS VARCHAR), ',' ORDER BY session_id) FROM hit WHERE hit.signal_name = n.signal_name), '') AS detected_session_ids
FROM (SELECT unnest({[*SIGNALS, "absent"]!r}) AS signal_name) n LEFT JOIN dy USING (signal_name) GROUP BY signal_name""")
def signal_time_coverage(spark, d):
    days = events(spark, d).groupBy("signal_name", F.date_trunc("DAY", "time").alias("day")).agg(F.count("*").alias("row_count"), F.min("time").alias("min_time"), F.max("time").alias("max_time"))
    names = spark.createDataFrame([(s,) for s in [*SIGNALS, "absent"]], "signal_name string")
    return coverage.signal_time_coverage(names, days, found_sessions(spark, d)).drop("session_start_times", "session_end_times")


@query(f"""WITH {_SUM} SELECT cycle_id, session_id, start_time, end_time, bool_or(signal_name = 'signup' AND NOT is_missing) AS signup_overlap, bool_or(signal_name = 'view' AND NOT is_missing) AS view_overlap,
bool_or(signal_name IN ('signup', 'view') AND NOT is_missing) AS any_vibration_axis_overlap FROM summ JOIN (SELECT cycle_id, start_time, end_time FROM cyc) USING (cycle_id) GROUP BY ALL""")
def cycle_overlap(spark, d):
    found, cyc = inside(spark, d)
    summary = extract.window_summary(found, cyc, events(spark, d).select("signal_name"))
    return coverage.cycle_overlap(cyc, summary, ["signup", "view"])


@query(f"""WITH RECURSIVE {_PATHS}, o AS (SELECT o_custkey, count(*) AS n, min(o_orderdate) AS a, max(o_orderdate) AS z FROM orders GROUP BY 1)
SELECT path, 'int' AS source, CAST(NULL AS VARCHAR) AS signal_id_uuid, c_custkey AS signal_id, coalesce(contains(lower(path), 'europe'), false) AS belongs_to_current_experiment, coalesce(path LIKE 'ASIA/%' AND c_custkey < 50, false) AS currently_selected_for_extraction,
a AS first_raw_timestamp, z AS last_raw_timestamp, coalesce(n, 0) AS raw_sample_count FROM customer LEFT JOIN paths ON node_id = 'C' || c_custkey LEFT JOIN o ON o_custkey = c_custkey WHERE c_mktsegment = 'BUILDING'""")
def signal_candidates(spark, d):
    known = catalog.signal_catalogue(signals(spark, d), catalog.node_paths(nodes(spark, d)), units(spark, d)).withColumn("source", F.lit("int"))
    bounds = read(spark, d, "orders").groupBy(F.col("o_custkey").cast("string").alias("key")).agg(F.count("*").alias("row_count"), F.min("o_orderdate").alias("min_time"), F.max("o_orderdate").alias("max_time"))
    chosen = [r["path"] for r in known.where("path LIKE 'ASIA/%' AND signal_id < 50").select("path").collect()]
    return coverage.signal_candidates(known, bounds.withColumn("source", F.lit("int")), "Europe", chosen, "BUILDING")


for _name, (_build, _sql) in relational.CATALOGUE.items():
    QUERIES[_name] = _build
    ORACLES[_name] = _sql

QUERIES["stream_sessions"] = stream.replayed_sessions
ORACLES["stream_sessions"] = stream.ORACLE
