"""The whole run over a dataset: catalogue, gaps, sessions, cycles, extraction, profile, rules, validation, features, tensors.

Every stage writes its tables under ``<output>/<experiment>/<run id>/<stage>`` and the next reads them back, so
a run can stop after any stage, rules are frozen before they are applied, and a manifest records what was done.
"""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import catalog, extract, profile, rules, temporal, tensors
from ..sources import measurements as store
from ..sources import metadata
from .storage import freeze, read_text, write_csv, write_text
from .config import FOLDERS, PipelineConfig, Stage


def strict_json(value) -> str:
    """JSON with sorted keys and neither NaN nor infinity."""

    def clean(x):
        if isinstance(x, float):
            return x if x == x and abs(x) != float("inf") else None
        if isinstance(x, dict):
            return {str(k): clean(v) for k, v in x.items()}
        if isinstance(x, list | tuple):
            return [clean(v) for v in x]
        return x.isoformat() if isinstance(x, datetime) else x

    return json.dumps(clean(value), sort_keys=True, allow_nan=False, indent=2)


class Run:
    """One run's folder, tables and manifest."""

    def __init__(self, spark: SparkSession, config: PipelineConfig):
        self.spark, self.config = spark, config
        self.id = config.run_id or datetime.now(timezone.utc).strftime("%Y%m%d_%H%M%S")
        self.root = f"{config.output.rstrip('/')}/{config.experiment}/{self.id}"
        self.manifest: dict = {"experiment": config.experiment, "run_id": self.id, "status": "running", "stages": {}, "error": None}

    def folder(self, stage: Stage) -> str:
        return f"{self.root}/{FOLDERS.get(stage, stage.value)}"

    def csv(self, stage: Stage, name: str, df: DataFrame) -> None:
        write_csv(df, f"{self.folder(stage)}/{name}.csv")

    def json(self, stage: Stage, name: str, value) -> None:
        write_text(self.spark, f"{self.folder(stage)}/{name}.json", strict_json(value))

    def table(self, stage: Stage, name: str, df: DataFrame) -> DataFrame:
        path = f"{self.folder(stage)}/{name}"
        df.write.mode("overwrite").option("compression", self.config.compression).parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.manifest["stages"].setdefault(stage.value, {})[name] = {"path": path, "rows": out.count()}
        self.save()
        return out

    def save(self) -> None:
        write_text(self.spark, f"{self.root}/manifest.json", strict_json(self.manifest))


def run_pipeline(spark: SparkSession, config: PipelineConfig) -> dict:
    """Runs the stages up to ``stop_after`` and returns the manifest; an error is recorded there and raised."""
    if config.stop_after is Stage.DATASET_GENERATION:
        raise NotImplementedError("dataset generation is declared only")
    run = Run(spark, config)
    try:
        for _ in _stages(run):
            pass
        run.manifest["status"] = "completed"
    except Exception as e:
        run.manifest.update(status="failed", error=f"{type(e).__name__}: {e}")
        raise
    finally:
        run.save()
    return run.manifest


def _stages(run: Run):
    config, spark = run.config, run.spark
    stop = lambda s: config.stop_after is s

    at = Stage.METADATA
    meta = metadata.load_metadata(spark, config.dataset)
    paths = catalog.node_paths(meta.nodes)
    catalog.check_acyclic(meta.nodes, paths)
    paths = run.table(at, "node_paths", paths)
    yield at
    if stop(at):
        return

    at = Stage.SIGNAL_DISCOVERY
    uuid = catalog.signal_catalogue(metadata.canonical_uuid_signals(meta.uuid_signals), paths, meta.units)
    ints = catalog.signal_catalogue(metadata.canonical_int_signals(meta.int_signals), paths, meta.units)
    signals = catalog.experiment_signals(uuid, ints, config.experiment, config.exact_experiment)
    signals = run.table(at, "experiment_signals", signals.withColumn("is_reference_signal", F.col("signal_name") == config.reference_signal))
    if not signals.head(1):
        raise ValueError(f"no signals for experiment {config.experiment!r}")
    run.csv(at, "experiment_signals", signals)
    reference = catalog.exactly_one(signals.where("is_reference_signal"), f"signal {config.reference_signal!r}")
    yield at
    if stop(at):
        return

    at = Stage.TIMESTAMP_ANALYSIS
    samples = store.uuid_signal(spark, config.dataset, reference["signal_id_uuid"], allow_full_scan=True)
    samples = temporal.clean(samples)
    order = ["time", "value"]
    histogram = run.table(at, "gap_histogram", temporal.gap_histogram(temporal.gaps(samples, [], order)))
    run.table(at, "gap_statistics", temporal.gap_statistics(histogram))
    run.csv(at, "gap_threshold_counts", run.table(at, "gap_threshold_counts", temporal.gap_threshold_counts(histogram)).orderBy("threshold_seconds"))
    yield at
    if stop(at):
        return

    at = Stage.SESSION_DETECTION
    tagged = freeze(temporal.session_ids(samples, [], order, config.session_gap_seconds))
    run.csv(at, "sessions", run.table(at, "sessions", temporal.summarise_sessions(tagged, [], "time", config.session_gap_seconds)).orderBy("session_id"))
    yield at
    if stop(at):
        return

    at = Stage.CYCLE_DETECTION
    cycles = temporal.cycles(tagged.drop("gap_us"), ["session_id"], order, config.movement_threshold, hold=freeze)
    cycles = cycles.withColumns({"experiment": F.lit(config.experiment), "reference_signal_uuid": F.lit(reference["signal_id_uuid"])})
    cycles = run.table(at, "cycles", cycles.orderBy("session_id", "start_time", "cycle_id"))
    if config.cycle_limit:
        cycles = cycles.orderBy("session_id", "start_time", "cycle_id").limit(config.cycle_limit)
    yield at
    if stop(at):
        return

    at = Stage.MULTI_SENSOR_EXTRACTION
    if config.selected_signals:
        signals = signals.where(F.col("signal_name").isin(*config.selected_signals))
    known = F.broadcast(signals.withColumn("key", F.coalesce("signal_id_uuid", F.col("signal_id").cast("string"))).drop("signal_id"))
    span = cycles.agg(F.min("start_time"), F.max("end_time")).first()  # reaches both scans as a range, the names as partitions
    ids = [r["key"] for r in known.select("key").collect()]
    rows = store.all_samples(spark, config.dataset).withColumnRenamed("signal_id", "key").where(F.col("key").isin(*ids))
    if span[0] is not None:
        rows = rows.where((F.col("time") >= F.lit(span[0]).cast("timestamp_ntz")) & (F.col("time") <= F.lit(span[1]).cast("timestamp_ntz")))
    rows = rows.join(known, ["source", "key"])
    names = [r["signal_name"] for r in signals.select("signal_name").collect()]
    found = extract.cycle_measurements(rows, cycles).withColumns({"experiment": F.lit(config.experiment), "signal_id": F.col("key").try_cast("bigint")}).drop("key")
    mark = extract.fingerprint(cycles, config.experiment, names, config.cycles_per_file)
    extract.write_store(found.select("experiment", "session_id", "cycle_id", "signal_name", "source", "signal_id", "signal_id_uuid", "unit_code", "unit_symbol", "time", "value"), run.folder(at), mark)
    from ..schemas import MEASUREMENTS

    found = extract.read_store(spark, run.folder(at), MEASUREMENTS)
    run.table(at, "signal_window_summary", extract.window_summary(found, cycles, signals))
    run.table(at, "batch_summary", extract.batch_summary(found, cycles, config.cycles_per_file))
    yield at
    if stop(at):
        return

    at = Stage.CYCLE_QUALITY_PROFILING
    quality = run.table(at, "signal_quality", profile.signal_quality(found, cycles))
    prof = run.table(at, "cycle_profile", profile.cycle_profile(quality, cycles, config.reference_signal))
    run.table(at, "metric_distribution", profile.metric_distribution(quality))
    yield at
    if stop(at):
        return

    at = Stage.VALIDATION_RULE_GENERATION
    classes = run.table(at, "availability", rules.availability(quality, cycles, config.rules.vibration))
    learned = rules.learned_rules(rules.reference_values(quality, prof, classes, config.rules), config.rules)
    provisional = rules.is_provisional(prof, config.rules)
    learned = run.table(at, "rules", learned.withColumn("provisional", F.lit(provisional)))
    hard = rules.hard_rules(spark, config.rules)
    shown = learned.where("status = 'learned'").select(*[c for c in hard.columns if c in learned.columns], F.lit(False).alias("hard_rule"))
    run.json(at, "validation_thresholds", {"thresholds": [r.asDict() for r in hard.unionByName(shown, allowMissingColumns=True).collect()]})
    run.csv(at, "threshold_derivation_summary", learned.orderBy("scope", "signal_name", "metric"))
    run.csv(at, "skipped_metrics", learned.where("status <> 'learned'").select("scope", "signal_name", "metric", "status").orderBy("scope", "signal_name", "metric"))
    run.json(at, "rule_generation_summary", {"provisional": provisional, "representative_population_warning": rules.population_warning(prof, config.rules)})
    yield at
    if stop(at):
        return

    at = Stage.DATASET_VALIDATION
    result = run.table(at, "cycle_validation", rules.cycle_validation(quality, prof, classes, learned, config.rules))
    run.csv(at, "validation_reason_summary", run.table(at, "reason_counts", rules.reason_counts(result)).orderBy("reason"))
    for name, final in rules.CLASS_TABLES.items():
        run.table(at, name, result.where(F.col("final_class") == final))
    counts = run.table(at, "class_counts", result.groupBy("final_class").agg(F.count("*").alias("cycles")))
    run.json(at, "validation_summary", {r["final_class"]: r["cycles"] for r in counts.collect()})
    yield at
    if stop(at):
        return

    at = Stage.FEATURE_ENGINEERING
    if config.write_features:
        run.table(at, "cycle_features", profile.feature_table(found, cycles, names))
    wanted = ["valid_core_cycle", *(["valid_complete_multisensor_cycle"] if config.include_complete_cycles else [])]
    chosen = result.where(F.col("final_class").isin(wanted)).select("cycle_id")
    timed = chosen.join(cycles.select("cycle_id", "session_id", "start_time", "end_time"), "cycle_id", "left")
    some = extract.only_cycles(found, chosen, list(config.tensor_signals))
    if chosen.head(1):
        length = tensors.target_length(tensors.cycle_lengths(some, config.tensor_signals[0]), config.tensor_strategy, config.tensor_percentile)
        made = run.table(at, "tensors", tensors.cycle_tensors(some, timed, list(config.tensor_signals), length, config.tensor_signals[0], config.tensor_truncate, config.cycles_per_file))
        run.table(at, "length_statistics", tensors.length_statistics(tensors.cycle_lengths(some, config.tensor_signals[0]), length))
        run.table(at, "skipped", made.where("skip_reason IS NOT NULL").select("cycle_id", "skip_reason"))
    yield at


def latest_run(spark: SparkSession, output: str, experiment: str, run: str | None = None) -> str:
    """The folder of the given run, else of the newest by name that holds a window summary, else of the newest.

    No run at all raises ``FileNotFoundError``.
    """
    root = f"{output.rstrip('/')}/{experiment}"
    if run is not None:
        return f"{root}/{run}"
    at = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    names = sorted((s.getPath().getName() for s in fs.listStatus(at) if s.isDirectory()), reverse=True) if fs.exists(at) else []
    if not names:
        raise FileNotFoundError(f"no runs under {root}")
    summary = f"{FOLDERS[Stage.MULTI_SENSOR_EXTRACTION]}/signal_window_summary"
    whole = (n for n in names if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{n}/{summary}")))
    return f"{root}/{next(whole, names[0])}"


def frozen_thresholds(spark: SparkSession, run: str) -> list[dict]:
    """The thresholds that a run froze as JSON; none where it wrote none."""
    text = read_text(spark, f"{run.rstrip('/')}/{Stage.VALIDATION_RULE_GENERATION.value}/validation_thresholds.json")
    return json.loads(text).get("thresholds", []) if text else []
