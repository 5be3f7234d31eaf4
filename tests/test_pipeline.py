"""A tiny dataset end to end."""

import json
from datetime import datetime, timedelta

import pytest

from gapwise.operators import extract
from gapwise.plans import dataset as reports
from gapwise.plans.config import PipelineConfig, Stage, from_mapping, stage
from gapwise.plans.pipeline import frozen_thresholds, latest_run, run_pipeline, strict_json
from gapwise.operators.rules import RuleConfig

T0 = datetime(2026, 1, 1)
P, T = "00000000-0000-0000-0000-000000000001", "00000000-0000-0000-0000-000000000002"


@pytest.fixture(scope="module")
def dataset(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("dataset"))
    nodes = [("e", "ExperimentAlpha", None), ("d", "Drive", "e"), ("t", "Temperature", "e"), ("s", "Sensor A", "e")]
    frames = {
        "nodes": (nodes, "node_id string, name string, parent_node string"),
        "units": ([("position", "mm", "Position"), ("temperature", "C", "Temperature"), ("vibration", "m/s2", "Vibration")], "common_code string, symbol string, name string"),
        "signal_data_point_rel": ([(P, "d", "position"), (T, "t", "temperature")], "signal_id string, node_id string, unit string"),
        "signal_data_point_rel_int": ([(101, "s", "vibration")], "signal_id bigint, node_id string, unit string"),
    }
    for name, (rows, schema) in frames.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{root}/{name}.parquet")
    at = lambda s: T0 + timedelta(seconds=s)
    position = [(0, 0.0), (0.5, 0.0), (1, 2.0), (1.5, 2.0), (2, 0.0), (2.5, 0.0), (7200, 0.0), (7200.5, 3.0), (7201, 0.0)]
    rows = [(at(s), v, P) for s, v in position] + [(at(s), v, T) for s, v in [(0, 20.0), (1, 20.5), (7200, 21.0)]]
    spark.createDataFrame(rows, "time timestamp_ntz, value double, signal_id string").write.partitionBy("signal_id").parquet(f"{root}/signal_data_point.parquet")
    rows = [(at(s), v, 101) for s, v in [(1, 0.1), (1.5, 0.2), (7200.5, 0.3)]]
    spark.createDataFrame(rows, "time timestamp_ntz, value double, signal_id bigint").write.partitionBy("signal_id").parquet(f"{root}/vibration.parquet")
    return root


def config(dataset, out, **more):
    rules = RuleConfig(core=("position", "temperature"), vibration=("vibration_x",))
    return PipelineConfig(dataset, "ExperimentAlpha", str(out), run_id="r", rules=rules, tensor_signals=("position", "temperature"), **more)


def test_whole_run(spark, dataset, tmp_path):
    m = run_pipeline(spark, config(dataset, tmp_path, write_features=True))
    assert m["status"] == "completed" and json.load(open(tmp_path / "ExperimentAlpha/r/manifest.json"))["status"] == "completed"
    rows = {k: {n: t["rows"] for n, t in v.items()} for k, v in m["stages"].items()}
    assert rows["session_detection"]["sessions"] == 2 and rows["cycle_detection"]["cycles"] == 2
    read = lambda s, n: spark.read.parquet(m["stages"][s][n]["path"])
    counts = {(r.cycle_id, r.signal_name): r.sample_count for r in read("multi_sensor_extraction", "signal_window_summary").collect()}
    assert counts == {(1, "position"): 3, (1, "temperature"): 1, (1, "sensor_a"): 2, (2, "position"): 2, (2, "temperature"): 0, (2, "sensor_a"): 1}
    got = {r.cycle_id: (r.final_class, r.reasons) for r in read("dataset_validation", "cycle_validation").collect()}
    assert got == {1: ("valid_core_cycle", "vibration_unavailable"), 2: ("invalid_cycle", "temperature:missing_required_signal,vibration_unavailable")}
    assert rows["dataset_validation"]["valid_core_cycles"] == rows["dataset_validation"]["invalid_cycles"] == 1
    root = tmp_path / "ExperimentAlpha/r"
    found = json.load(open(root / "validation_rule_generation/validation_thresholds.json"))["thresholds"]
    assert [r["rule_type"] for r in found] == ["hard_interval_order", "hard_positive_duration", "hard_signal_presence", "hard_finite_required", "hard_finite_required"]
    assert json.load(open(root / "dataset_validation/validation_summary.json")) == {"valid_core_cycle": 1, "invalid_cycle": 1}
    assert (root / "dataset_validation/validation_reason_summary.csv").read_text().splitlines()[0] == "reason,reason_count"
    marked = {r.signal_name: r.is_reference_signal for r in read("signal_discovery", "experiment_signals").collect()}
    assert marked == {"position": True, "temperature": False, "sensor_a": False}
    assert [tuple(r) for r in read("multi_sensor_extraction", "batch_summary").collect()] == [(0, 2, 1, 2, 9)]
    assert latest_run(spark, str(tmp_path), "ExperimentAlpha") == str(root) and len(frozen_thresholds(spark, str(root))) == len(found)
    t = read("feature_engineering", "tensors").collect()
    assert len(t) == 1 and t[0]["values"] == [[2.0, 2.0, 0.0], [20.5, 20.5, 20.5]] and t[0]["mask"] == [[1, 1, 1], [1, 0, 0]]


def test_stop_and_errors(spark, dataset, tmp_path):
    m = run_pipeline(spark, config(dataset, tmp_path, stop_after="SESSION_DETECTION"))
    assert set(m["stages"]) == {"metadata", "signal_discovery", "timestamp_analysis", "session_detection"}
    with pytest.raises(FileNotFoundError):
        run_pipeline(spark, config(str(tmp_path / "none"), tmp_path))
    with pytest.raises(ValueError):
        run_pipeline(spark, PipelineConfig(dataset, "Nobody", str(tmp_path), run_id="x"))
    with pytest.raises(ValueError):
        stage("nonsense")
    with pytest.raises(NotImplementedError):
        run_pipeline(spark, config(dataset, tmp_path, stop_after=Stage.DATASET_GENERATION))


def test_store_resumes_and_refuses_other_settings(spark, tmp_path):
    df = spark.createDataFrame([("e", 1, 1, T0, 1.0), ("e", 2, 2, T0, 2.0)], "experiment string, session_id bigint, cycle_id bigint, time timestamp_ntz, value double")
    path = str(tmp_path / "store")
    assert extract.write_store(df, path, "m") == [1, 2] and extract.write_store(df, path, "m") == []
    assert extract.read_store(spark, path, "experiment string, session_id bigint, cycle_id bigint, time timestamp_ntz, value double").count() == 2
    with pytest.raises(ValueError):
        extract.write_store(df, path, "other")


def test_keys_of_run_files():
    c = from_mapping({
        "dataset_path": "d", "experiment": "e", "output_root": "o", "stop_after": "MULTI_SENSOR_EXTRACTION", "extract_all_cycles": False, "max_cycles_to_extract": 100,
        "cycle_batch_size": 500, "selected_extraction_signals": ["position"], "signal_roles": {"core_required": ["position"], "optional_duty_cycled": ["vibration_x"]},
        "validation_rule_generation": {"mad_z_limit": 3, "lower_quantile": 0.05, "upper_quantile": 0.95}, "dataset_validation": {"allow_provisional_rules": False},
        "cycle_tensor_generation": {"required_signals": ["position"], "target_length_strategy": "percentile", "target_length_percentile": 99},
    })
    assert (c.dataset, c.output, c.stop_after, c.cycle_limit, c.selected_signals) == ("d", "o", Stage.MULTI_SENSOR_EXTRACTION, 100, ("position",))
    assert (c.rules.core, c.rules.vibration, c.rules.z, c.rules.quantiles, c.rules.allow_provisional) == (("position",), ("vibration_x",), 3, (0.05, 0.95), False)
    assert (c.tensor_signals, c.tensor_strategy, c.tensor_percentile) == (("position",), "percentile", 99)
    assert from_mapping({"dataset_path": "d", "experiment": "e", "output_root": "o", "extract_all_cycles": True, "max_cycles_to_extract": 3}).cycle_limit is None


def test_settings_and_strict_json():
    c = from_mapping({"dataset": "d", "experiment": "e", "output": "o", "stop_after": "Cycle_Detection", "unknown": 1, "rules": {"z": 3, "core": ["a"]}})
    assert c.stop_after is Stage.CYCLE_DETECTION and c.rules.core == ("a",)
    with pytest.raises(ValueError):
        from_mapping({"dataset": "d", "experiment": "e", "output": "o", "session_gap_seconds": 0})
    assert json.loads(strict_json({"b": float("nan"), "a": [float("inf"), 1]})) == {"a": [None, 1], "b": None}


def test_report_over_the_dataset(spark, dataset, tmp_path):
    report = reports.analyse(spark, dataset)
    assert [r[0] for r in report.experiments.collect()] == ["Drive", "Sensor A", "Temperature"]  # the second level of the paths
    assert {r.experiment: r.signals_found for r in report.skipped.collect()} == {"Sensor A": 0, "Temperature": 0}
    r = report.sampling.first()
    assert (r.experiment, r.signal_id_uuid, r.number_of_samples, r.median_gap_seconds, r.maximum_gap_seconds) == ("Drive", P, 9, 0.5, 7197.5)
    r = report.session_statistics.first()
    assert (r.number_of_sessions, r.minimum_duration_seconds, r.median_duration_seconds, r.maximum_samples, r.maximum_internal_gap_seconds) == (2, 1.0, 1.75, 6, 0.5)
    one = reports.one_row(reports.gap_report(report.sampling), ["experiment"]).first()
    assert (one.number_of_samples, one.minimum_gap_seconds) == ("9", "0.5")
    reports.write_report(report, str(tmp_path))
    assert (tmp_path / "statistics/experiments.csv").read_text().splitlines() == ["experiment", "Drive", "Sensor A", "Temperature"]
    assert (tmp_path / "statistics/drive_time_gap_statistics.csv").read_text().splitlines()[:3] == ["metric,value", f"signal_id_uuid,{P}", "number_of_samples,9"]
    assert len((tmp_path / "reports/drive_position_sessions.csv").read_text().splitlines()) == 3
    assert "no single reference signal (0 found)" in reports.text_report(report)


def test_coverage_of_a_run(spark, dataset, tmp_path):
    run_pipeline(spark, config(dataset, tmp_path, stop_after="multi_sensor_extraction"))
    (tmp_path / "ExperimentAlpha/z").mkdir()  # newer by name, without a window summary
    run = latest_run(spark, str(tmp_path), "ExperimentAlpha")
    assert run.endswith("/r") and latest_run(spark, "o", "e", "given") == "o/e/given" and frozen_thresholds(spark, run) == []
    with pytest.raises(FileNotFoundError):
        latest_run(spark, str(tmp_path), "Nobody")
    got = reports.diagnose(spark, dataset, "ExperimentAlpha", run, str(tmp_path / "out"), ["position", "sensor_a"], ["sensor_a", "sensor_b"], 1)
    cover = {r.signal_name: (r.raw_sample_count, r.detected_session_ids, r.first_raw_timestamp) for r in got["signal_time_coverage"].collect()}
    assert cover == {"position": (9, "1,2", T0), "sensor_a": (3, "1,2", T0 + timedelta(seconds=1))}
    r = got["cycle_vibration_overlap"].collect()
    assert [(x.cycle_id, x.sensor_a_overlap, x.sensor_b_overlap, x.any_vibration_axis_overlap) for x in r] == [(1, True, False, True)]
    r = got["vibration_signal_candidates"].collect()
    assert [(x.signal_id, x.belongs_to_current_experiment, x.currently_selected_for_extraction, x.raw_sample_count) for x in r] == [(101, True, True, 3)]
    assert sorted(p.name for p in (tmp_path / "out").glob("*.csv")) == ["cycle_vibration_overlap.csv", "signal_time_coverage.csv", "vibration_signal_candidates.csv"]
