"""Settings of a run: a dataclass, YAML files and command-line overrides, in rising precedence."""

from __future__ import annotations

from dataclasses import dataclass, field, fields, replace
from enum import Enum

from ..operators.rules import RuleConfig


class Stage(str, Enum):
    """Stages in the order in which they run; the last is declared only.  The names are fixed values."""

    METADATA = "metadata"
    SIGNAL_DISCOVERY = "signal_discovery"
    TIMESTAMP_ANALYSIS = "timestamp_analysis"
    SESSION_DETECTION = "session_detection"
    CYCLE_DETECTION = "cycle_detection"
    MULTI_SENSOR_EXTRACTION = "multi_sensor_extraction"
    CYCLE_QUALITY_PROFILING = "cycle_quality_profiling"
    VALIDATION_RULE_GENERATION = "validation_rule_generation"
    DATASET_VALIDATION = "dataset_validation"
    FEATURE_ENGINEERING = "feature_engineering"
    DATASET_GENERATION = "dataset_generation"


#: Folders of the stages whose folder has another name.
FOLDERS = {
    Stage.SESSION_DETECTION: "sessions",
    Stage.CYCLE_DETECTION: "cycles",
    Stage.MULTI_SENSOR_EXTRACTION: "multi_sensor",
    Stage.CYCLE_QUALITY_PROFILING: "quality_profiling",
    Stage.FEATURE_ENGINEERING: "features",
    Stage.DATASET_GENERATION: "dataset",
}


def stage(name: str | Stage | None) -> Stage | None:
    """A stage by name, in any case; an unknown one raises ``ValueError``."""
    if name is None or isinstance(name, Stage):
        return name
    try:
        return Stage(name.strip().lower())
    except ValueError:
        raise ValueError(f"invalid stop_after: {name!r}; known stages are {', '.join(s.value for s in Stage)}") from None


@dataclass(frozen=True)
class PipelineConfig:
    dataset: str
    experiment: str
    output: str
    run_id: str | None = None
    stop_after: Stage | None = None
    reference_signal: str = "position"
    session_gap_seconds: float = 3600.0
    movement_threshold: float = 1.0
    cycle_limit: int | None = None
    tensor_signals: tuple[str, ...] = ("position", "velocity", "current", "pressure", "temperature")
    tensor_strategy: str = "max"
    tensor_percentile: float = 95.0
    tensor_truncate: bool = True
    cycles_per_file: int = 1000
    include_complete_cycles: bool = False
    write_features: bool = False
    exact_experiment: bool = False
    selected_signals: tuple[str, ...] = ()
    compression: str = "zstd"
    validation_signals: tuple[str, ...] = ()
    validation_minimum: dict = field(default_factory=dict)
    validation_count: int = 3
    validation_consecutive: bool = True
    validation_scan: int | None = 10_000
    rules: RuleConfig = field(default_factory=RuleConfig)

    def __post_init__(self):
        object.__setattr__(self, "stop_after", stage(self.stop_after))
        if self.session_gap_seconds <= 0 or self.movement_threshold < 0 or self.cycles_per_file < 1 or (self.cycle_limit or 1) < 1:
            raise ValueError("the pipeline settings are out of range")


#: Keys of run files, by the field that they set.
_KEYS = {
    "dataset": "dataset_path",
    "output": "output_root",
    "selected_signals": "selected_extraction_signals",
    "write_features": "generate_cycle_features",
    "compression": "parquet_compression",
    "validation_count": "validation_cycle_count",
    "validation_signals": "required_validation_signals",
    "validation_minimum": "minimum_samples_per_validation_cycle",
    "validation_consecutive": "require_consecutive_validation_cycles",
    "validation_scan": "max_cycles_to_scan_for_validation",
}
_TENSOR_KEYS = {
    "tensor_signals": "required_signals",
    "tensor_strategy": "target_length_strategy",
    "tensor_percentile": "target_length_percentile",
    "tensor_truncate": "truncate_long_cycles",
    "cycles_per_file": "cycles_per_file",
}
_RULE_KEYS = {
    "minimum_reference_count": "minimum_reference_count",
    "z": "mad_z_limit",
    "provisional": "mark_small_or_limited_population_as_provisional",
    "require_rules": "fail_on_missing_generated_rule",
    "allow_provisional": "allow_provisional_rules",
}


def from_mapping(values: dict) -> PipelineConfig:
    """A configuration from a mapping: own field names, a nested ``rules`` mapping, and the fixed keys of run files.

    Keys that nothing here needs (batch sizes, plots) are ignored.  ``max_cycles_to_extract`` holds unless ``extract_all_cycles``.
    """
    values = dict(values)
    for own, key in _KEYS.items():
        if own not in values and values.get(key) is not None:
            values[own] = values[key]
    if "cycle_limit" not in values and values.get("max_cycles_to_extract") and not values.get("extract_all_cycles"):
        values["cycle_limit"] = values["max_cycles_to_extract"]
    tensor = values.get("cycle_tensor_generation") or {}
    for own, key in _TENSOR_KEYS.items():
        if own not in values and tensor.get(key) is not None:
            values[own] = tensor[key]
    if "rules" not in values:
        blocks = {**(values.get("validation_rule_generation") or {}), **(values.get("dataset_validation") or {})}
        rules = {own: blocks[key] for own, key in _RULE_KEYS.items() if blocks.get(key) is not None}
        roles = values.get("signal_roles") or {}
        rules |= {own: tuple(roles[key]) for own, key in (("core", "core_required"), ("vibration", "optional_duty_cycled")) if roles.get(key)}
        if blocks.get("lower_quantile") is not None and blocks.get("upper_quantile") is not None:
            rules["quantiles"] = (blocks["lower_quantile"], blocks["upper_quantile"])
        values["rules"] = rules
    for key in ("selected_signals", "validation_signals"):
        if isinstance(values.get(key), list):
            values[key] = tuple(values[key])
    known = {f.name for f in fields(PipelineConfig)}
    kept = {k: v for k, v in values.items() if k in known and v is not None}
    if isinstance(kept.get("rules"), dict):
        names = {f.name for f in fields(RuleConfig)}
        kept["rules"] = RuleConfig(**{k: tuple(v) if isinstance(v, list) else v for k, v in kept["rules"].items() if k in names})
    if isinstance(kept.get("tensor_signals"), list):
        kept["tensor_signals"] = tuple(kept["tensor_signals"])
    return PipelineConfig(**kept)


def load_yaml(path: str) -> dict:
    import yaml

    with open(path) as f:
        values = yaml.safe_load(f) or {}
    if not isinstance(values, dict):
        raise ValueError("a configuration file must hold a mapping")
    return values


def override(config: PipelineConfig, **values) -> PipelineConfig:
    return replace(config, **{k: v for k, v in values.items() if v is not None})
