"""Schemas of the fixed tables."""

from __future__ import annotations

UNITS = "common_code string, symbol string, name string"
NODES = "node_id string, name string, parent_node string"
SIGNALS_UUID = "signal_id string, node_id string, unit string"
SIGNALS_INT = "signal_id bigint, node_id string, unit string"
CATALOGUE = "signal_id bigint, signal_id_uuid string, node_id_uuid string, unit_code string, unit_symbol string, path string"
EXPERIMENT_SIGNALS = "signal_name string, source string, signal_id bigint, signal_id_uuid string, unit_code string, unit_symbol string, path string"
SAMPLES = "time timestamp_ntz, value double, signal_id string"
SESSIONS = "session_id bigint, start_time timestamp_ntz, end_time timestamp_ntz, duration_seconds double, number_of_samples bigint, maximum_internal_gap_seconds double"
MEASUREMENTS = "experiment string, session_id bigint, cycle_id bigint, signal_name string, source string, signal_id bigint, signal_id_uuid string, unit_code string, unit_symbol string, time timestamp_ntz, value double"
THRESHOLDS = "signal_name string, metric string, scope string, lower_bound double, upper_bound double, method string, fallback_used boolean, median double, mad double, reference_count bigint, provisional boolean, status string"
