"""Run records as tables: one row per status change, parameter and metric."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrane.operators.sampling import latest
from terrane.operators.upkeep import compact
from terrane.sources.tables import is_table, live_segments, read_table, small_frame, write_table

_MAX_SEGMENTS = 100
RUNNING, FINISHED, FAILED = "RUNNING", "FINISHED", "FAILED"

_RUNS = (
    "run_id string, experiment string, run_name string, status string, "
    "start_time timestamp, logged_at timestamp"
)
_PARAMS = "run_id string, key string, value string"
_METRICS = "run_id string, key string, value double"


def now() -> datetime:
    return datetime.now(timezone.utc)


def latest_run(runs: DataFrame, experiment: str, *, finished: bool = True) -> DataFrame:
    """The newest run of an experiment: finished ones only, unless asked otherwise."""
    matching = runs.filter(F.col("experiment") == experiment)
    order = [F.col("start_time").desc(), F.col("run_id")]
    return latest(matching, f"status = '{FINISHED}'" if finished else "true", order)


def of_latest_run(runs: DataFrame, records: DataFrame, experiment: str) -> DataFrame:
    """That run's metrics or parameters."""
    return records.join(latest_run(runs, experiment).select("run_id"), "run_id")


class RunLog:
    """Appends one run's status, parameters and metrics under a shared root path."""

    def __init__(
        self, spark: SparkSession, root: str, experiment: str, run_name: str | None = None
    ) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.experiment = experiment
        self.run_name = run_name
        self.run_id = uuid.uuid4().hex
        self.start_time = now()

    def table(self, name: str) -> str:
        return f"{self.root}/{name}"

    def model_path(self, run_id: str | None = None) -> str:
        return f"{self.root}/models/{run_id or self.run_id}"

    def _append(self, name: str, rows: list[tuple], schema: str) -> None:
        if rows:
            write_table(small_frame(self.spark, rows, schema), self.table(name), "append")

    def status(self, status: str) -> None:
        row = (self.run_id, self.experiment, self.run_name, status, self.start_time, now())
        self._append("runs", [row], _RUNS)

    def params(self, values: Mapping[str, Any]) -> None:
        rows = [(self.run_id, key, str(value)) for key, value in values.items()]
        self._append("run_params", rows, _PARAMS)

    def metrics(self, values: Mapping[str, float | None]) -> None:
        rows = [(self.run_id, k, float(v)) for k, v in values.items() if v is not None]
        self._append("run_metrics", rows, _METRICS)

    def tidy(self) -> None:
        """Every run adds a few tiny files; merge them now and then."""
        for name in ("runs", "run_params", "run_metrics"):
            if len(live_segments(self.spark, self.table(name))) > _MAX_SEGMENTS:
                compact(self.spark, self.table(name))


def latest_run_id(spark: SparkSession, root: str, experiment: str) -> str:
    runs = f"{root.rstrip('/')}/runs"
    if not is_table(spark, runs):
        raise ValueError(f"no run table under {root}")
    row = latest_run(read_table(spark, runs), experiment).first()
    if row is None:
        raise RuntimeError(f"experiment {experiment!r} has no finished run")
    return row["run_id"]
