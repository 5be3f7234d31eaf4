"""Reports over a whole dataset: every experiment's signals, sampling and sessions, and the coverage of one experiment's signals.

The reference signals of all experiments are scanned together: their ids reach the store as partition filters, and gaps, histograms and
sessions are keyed by experiment.  So the number of Spark jobs does not depend on how many samples or sessions there are; only the
catalogue, tens of rows an experiment, is settled on the driver.

Edge cases: an experiment without exactly one reference signal is listed in ``skipped`` with the number found; a reference signal
without samples has zero sessions and null statistics; one sample has a session and null gaps; no experiments give empty tables.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import catalog, coverage, extract, temporal
from ..schemas import EXPERIMENT_SIGNALS, SESSIONS
from ..sources import measurements as store
from ..sources import metadata
from .config import FOLDERS, Stage
from .storage import freeze, read_csv, write_csv

KEYS = ["experiment", "signal_id_uuid"]

#: The order of the rows of a gap report.
GAP_METRICS = (
    "signal_id_uuid", "number_of_samples", "minimum_gap_seconds", "median_gap_seconds", "mean_gap_seconds",
    "percentile_95_gap_seconds", "percentile_99_gap_seconds", "maximum_gap_seconds",
)


@dataclass
class DatasetReport:
    """The tables of ``analyse``."""

    experiments: DataFrame
    signals: DataFrame
    skipped: DataFrame
    sampling: DataFrame
    sessions: DataFrame
    session_statistics: DataFrame


def catalogues(spark: SparkSession, base: str) -> tuple[DataFrame, DataFrame]:
    """The UUID and the integer signals with their paths, stored, as every experiment reads them."""
    meta = metadata.load_metadata(spark, base)
    paths = freeze(catalog.node_paths(meta.nodes))
    catalog.check_acyclic(meta.nodes, paths)
    uuid = catalog.signal_catalogue(metadata.canonical_uuid_signals(meta.uuid_signals), paths, meta.units)
    return freeze(uuid), freeze(catalog.signal_catalogue(metadata.canonical_int_signals(meta.int_signals), paths, meta.units))


def sampling_and_sessions(samples: DataFrame, chosen: DataFrame, gap_seconds: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The sampling row, the sessions and the session row of each chosen (experiment, signal_id_uuid); samples carry both and time, value."""
    tagged = freeze(temporal.session_ids(temporal.clean(samples), KEYS, ["time", "value"], gap_seconds))
    found = freeze(temporal.summarise_sessions(tagged, KEYS, "time", gap_seconds))
    gaps = temporal.gap_statistics(temporal.gap_histogram(tagged, KEYS), KEYS)
    counts = found.groupBy(*KEYS).agg(F.sum("number_of_samples").alias("number_of_samples"))
    sampling = chosen.join(counts, KEYS, "left").join(gaps, KEYS, "left").select(
        *KEYS, F.coalesce("number_of_samples", F.lit(0)).cast("bigint").alias("number_of_samples"), "minimum_gap_seconds", "median_gap_seconds", "mean_gap_seconds",
        F.col("p95_gap_seconds").alias("percentile_95_gap_seconds"), F.col("p99_gap_seconds").alias("percentile_99_gap_seconds"), "maximum_gap_seconds",
    )
    row = temporal.session_summary(found, KEYS).withColumnRenamed("session_count", "number_of_sessions")
    row = chosen.join(row, KEYS, "left").withColumn("number_of_sessions", F.coalesce("number_of_sessions", F.lit(0)).cast("bigint"))
    return sampling, found, row


def analyse(spark: SparkSession, base: str, unit: str = "position", gap_seconds: float = 3600.0) -> DatasetReport:
    """Signals of every experiment; sampling and sessions of those with exactly one signal of the unit."""
    uuid, ints = catalogues(spark, base)
    known = freeze(catalog.experiments(uuid.select("path").union(ints.select("path"))))
    names = [r[0] for r in known.orderBy("experiment").collect()]
    tables, chosen, skipped = [], [], []
    for name in names:
        tables.append(catalog.experiment_signals(uuid, ints, name).withColumn("experiment", F.lit(name)))
        ids = [r[0] for r in catalog.find_signals(uuid, path=name, unit=unit).select("signal_id_uuid").collect()]
        (chosen if len(ids) == 1 else skipped).append((name, ids[0] if len(ids) == 1 else len(ids)))
    empty = spark.createDataFrame([], f"{EXPERIMENT_SIGNALS}, experiment string")
    signals = reduce(DataFrame.unionByName, tables, empty)
    picked = spark.createDataFrame(chosen, "experiment string, signal_id_uuid string")
    ids = sorted({i for _, i in chosen})
    rows = store.uuid_signals(spark, base, ids).withColumnRenamed("signal_id", "signal_id_uuid").join(F.broadcast(picked), "signal_id_uuid")
    sampling, sessions, statistics = sampling_and_sessions(rows, picked, gap_seconds)
    skips = spark.createDataFrame(skipped, "experiment string, signals_found bigint")
    return DatasetReport(known, signals.select("experiment", *[c for c in empty.columns if c != "experiment"]), skips, freeze(sampling), sessions, freeze(statistics))


def gap_report(sampling: DataFrame) -> DataFrame:
    """Metric and value rows of the sampling row, in the fixed order."""
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("place"), F.lit(m).alias("metric"), F.col(m).cast("string").alias("value")) for i, m in enumerate(GAP_METRICS)]))
    return sampling.select("experiment", each.alias("x")).select("experiment", "x.*")


def one_row(report: DataFrame, keys: list[str]) -> DataFrame:
    """Metric and value rows back as one row a key, a column a metric."""
    return report.groupBy(*keys).agg(*[F.max(F.when(F.col("metric") == m, F.col("value"))).alias(m) for m in GAP_METRICS])


def write_report(report: DatasetReport, out: str) -> None:
    """The four tables of the dataset under ``statistics`` and the tables of each experiment beside them, as CSV."""
    root = out.rstrip("/")
    write_csv(report.experiments.orderBy("experiment"), f"{root}/statistics/experiments.csv")
    write_csv(report.signals, f"{root}/statistics/signal_availability.csv")
    write_csv(report.sampling.orderBy("experiment"), f"{root}/statistics/sampling_statistics_summary.csv")
    write_csv(report.session_statistics.orderBy("experiment"), f"{root}/statistics/session_statistics_summary.csv")
    gaps = freeze(gap_report(report.sampling))
    for (name,) in report.experiments.collect():
        mine = F.col("experiment") == name
        write_csv(report.signals.where(mine), f"{root}/reports/{name.lower()}_signals.csv")
        if report.sampling.where(mine).head(1):
            write_csv(gaps.where(mine).orderBy("place").select("metric", "value"), f"{root}/statistics/{name.lower()}_time_gap_statistics.csv")
            write_csv(report.sessions.where(mine).orderBy("session_id").drop("experiment"), f"{root}/reports/{name.lower()}_position_sessions.csv")


def text_report(report: DatasetReport) -> str:
    """The report in words, an experiment a block."""
    skipped = {r["experiment"]: r["signals_found"] for r in report.skipped.collect()}
    signals = {r["experiment"]: r["n"] for r in report.signals.groupBy("experiment").agg(F.count("*").alias("n")).collect()}
    sampling = {r["experiment"]: r.asDict() for r in report.sampling.collect()}
    sessions = {r["experiment"]: r.asDict() for r in report.session_statistics.collect()}
    lines = []
    for (name,) in report.experiments.orderBy("experiment").collect():
        lines += [f"[{name}]", f"signals: {signals.get(name, 0)}"]
        if name in skipped:
            lines.append(f"no single reference signal ({skipped[name]} found): gaps and sessions left out")
            continue
        for title, row in (("sampling", sampling[name]), ("sessions", sessions[name])):
            lines.append(f"{title}: " + ", ".join(f"{k} {v}" for k, v in row.items() if k not in KEYS))
    return "\n".join(lines)


def row_groups(spark: SparkSession, base: str, signals: DataFrame) -> DataFrame:
    """source, key, row_count, min_time, max_time of every row group of the given signals, from the footers of their partitions alone."""
    rows = [(r["source"], r["key"]) for r in signals.select("source", F.coalesce("signal_id_uuid", F.col("signal_id").cast("string")).alias("key")).distinct().collect()]
    found = spark.createDataFrame([], "source string, key string, row_count bigint, min_time timestamp_ntz, max_time timestamp_ntz")
    for source, key in rows:
        path = store.partition_path(spark, base, source, key)
        if path:
            each = store.row_group_bounds(spark, path).select(F.lit(source).alias("source"), F.lit(key).alias("key"), "row_count", "min_time", "max_time")
            found = found.unionByName(each)
    return found


def diagnose(spark: SparkSession, base: str, experiment: str, run: str, out: str, core: list[str], axes: list[str], first: int = 100, selected: list[str] | None = None, unit: str = "vibration") -> dict[str, DataFrame]:
    """Coverage of an experiment's signals against a finished run, written as three CSV files and returned.

    ``signal_time_coverage`` of the core signals, ``cycle_vibration_overlap`` of the run's first cycles (the limit is the
    operator's own), and ``vibration_signal_candidates``: all signals of the unit in the dataset, whichever were chosen.
    """
    uuid, ints = catalogues(spark, base)
    signals = freeze(catalog.experiment_signals(uuid, ints, experiment))
    every = uuid.withColumn("source", F.lit("uuid")).unionByName(ints.withColumn("source", F.lit("int")))
    wanted = freeze(signals.where(F.col("signal_name").isin(core)))
    asked = every.where(F.col("unit_code") == unit).select("source", "signal_id_uuid", "signal_id")
    bounds = freeze(row_groups(spark, base, wanted.select("source", "signal_id_uuid", "signal_id").union(asked)))
    key = F.coalesce("signal_id_uuid", F.col("signal_id").cast("string"))
    named = bounds.join(F.broadcast(wanted.select("signal_name", "source", key.alias("key"))), ["source", "key"])
    sessions = read_csv(spark, f"{run}/{FOLDERS[Stage.SESSION_DETECTION]}/sessions.csv", SESSIONS)
    cycles = spark.read.parquet(f"{run}/{FOLDERS[Stage.CYCLE_DETECTION]}/cycles").orderBy("session_id", "start_time", "cycle_id").limit(first)
    summary = spark.read.parquet(f"{run}/{FOLDERS[Stage.MULTI_SENSOR_EXTRACTION]}/signal_window_summary")
    paths = signals.where(F.col("signal_name").isin(selected)) if selected else signals
    tables = {
        "signal_time_coverage": coverage.signal_time_coverage(wanted.drop("unit_code", "unit_symbol", "path"), named, sessions).orderBy("signal_name"),
        "cycle_vibration_overlap": coverage.cycle_overlap(cycles, extract.only_cycles(summary, cycles), axes).orderBy("cycle_id"),
        "vibration_signal_candidates": coverage.signal_candidates(every, bounds, experiment, [r["path"] for r in paths.collect()], unit),
    }
    tables = {n: freeze(t) for n, t in tables.items()}
    orders = {"signal_time_coverage": ["signal_name"], "cycle_vibration_overlap": ["cycle_id"], "vibration_signal_candidates": [F.desc("belongs_to_current_experiment"), F.asc_nulls_last("path")]}
    for name, table in tables.items():
        write_csv(table.orderBy(*orders[name]), f"{out.rstrip('/')}/{name}.csv")
    return tables
