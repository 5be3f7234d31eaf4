"""Command line.  Overrides win over the file, the file over defaults.

``python -m gapwise.cli --config run.yaml [overrides]`` runs the pipeline, ``--report`` writes the reports over the whole dataset to
``output`` instead, ``--diagnose`` the coverage of the experiment's signals in the given or latest run.
"""

from __future__ import annotations

import argparse

from .plans import dataset
from .plans.config import from_mapping, load_yaml
from .plans.pipeline import latest_run, run_pipeline, strict_json


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description="Runs the cycle pipeline over a dataset.")
    for name in ("config", "dataset", "experiment", "output", "run-id", "stop-after"):
        p.add_argument(f"--{name}")
    p.add_argument("--session-gap-seconds", type=float)
    p.add_argument("--movement-threshold", type=float)
    p.add_argument("--cycle-limit", type=int)
    p.add_argument("--write-features", action="store_true", default=None)
    p.add_argument("--report", action="store_true", default=None)
    p.add_argument("--diagnose", action="store_true", default=None)
    p.add_argument("--cycles", type=int, help="how many leading cycles --diagnose looks at")
    return p


def settings(argv: list[str] | None = None) -> dict:
    given = {k: v for k, v in vars(parser().parse_args(argv)).items() if v is not None}
    values = load_yaml(given.pop("config")) if "config" in given else {}
    return values | given


def main(argv: list[str] | None = None) -> None:
    from pyspark.sql import SparkSession

    values = settings(argv)
    spark = SparkSession.builder.appName("gapwise").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if values.get("report"):
        report = dataset.analyse(spark, values["dataset"])
        dataset.write_report(report, values["output"])
        print(dataset.text_report(report))
        return
    config = from_mapping(values)
    if values.get("diagnose"):
        run = latest_run(spark, config.output, config.experiment, config.run_id)
        core, axes = [*config.rules.core, *config.rules.vibration], list(config.rules.vibration)
        dataset.diagnose(spark, config.dataset, config.experiment, run, f"{run}/diagnostics", core, axes, values.get("cycles", 100), list(config.selected_signals))
        print(f"{run}/diagnostics")
        return
    print(strict_json(run_pipeline(spark, config)))


if __name__ == "__main__":
    main()
