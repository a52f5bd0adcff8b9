"""The job spec: plain dataclasses filled from YAML."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import MISSING, dataclass, field, fields
from typing import Any, get_args, get_origin, get_type_hints

import yaml

from terrane.operators.rules import Rule


@dataclass
class BronzeSpec:
    landing_path: str
    target_delta_path: str
    name: str | None = None
    archive_path: str | None = None
    file_format: str = "json"
    file_pattern: str = "*"
    write_mode: str = "append"
    options: dict = field(default_factory=dict)
    # Additions: a DDL schema (no inference pass) and a bound on files per stream batch.
    schema: str | None = None
    max_files_per_batch: int | None = None


@dataclass
class RuleSpec:
    name: str
    expr: str

    def rule(self) -> Rule:
        return Rule(self.name, self.expr)


@dataclass
class SilverSpec:
    source_delta_path: str
    target_delta_path: str
    quarantine_delta_path: str | None = None
    write_mode: str = "overwrite"
    drop_duplicates: list | None = None
    drop_na_cols: list | None = None
    fill_na: dict | None = None
    validation_rules: list[RuleSpec] | None = None
    # Rules without a quarantine path are an error unless this says "ignore".
    on_invalid: str | None = None
    # In append mode, leave out rows whose drop_duplicates keys the table already has.
    unique_across_batches: bool = False


@dataclass
class JoinSpec:
    table: str
    on: list
    type: str = "left"


@dataclass
class GoldSpec:
    target_delta_path: str
    primary_table: str | None = None
    source_delta_path: str | None = None
    write_mode: str = "overwrite"
    joins: list[JoinSpec] | None = None
    select_expressions: list | None = None
    group_by: list | None = None
    aggregations: dict | None = None
    skew: str = "auto"

    @property
    def source(self) -> str:
        found = self.primary_table or self.source_delta_path
        if not found:
            raise ValueError("gold needs primary_table or source_delta_path")
        return found


@dataclass
class LearningSpec:
    enabled: bool = True
    target_column: str = "actual_delay_days"
    categorical_features: list = field(default_factory=list)
    numeric_features: list = field(default_factory=list)
    train_test_split_ratio: float = 0.8
    random_seed: int = 42
    hyperparameters: dict | None = None
    tuning: dict | None = None
    # Columns that identify a row for the split; all used columns when absent.
    split_keys: list | None = None


@dataclass
class MaintenanceSpec:
    enabled: bool = True
    retention_hours: int = 168
    tables: list | None = None


@dataclass
class TrackingSpec:
    experiment_name: str
    run_name: str | None = "declarative_run"
    # Folder of the run tables and models; beside the layers when absent.
    path: str | None = None


@dataclass
class JobSpec:
    pipeline_name: str
    version: str
    silver: SilverSpec
    gold: GoldSpec
    mlflow: TrackingSpec
    bronze: BronzeSpec | None = None
    bronze_tables: list[BronzeSpec] | None = None
    maintenance: MaintenanceSpec | None = field(default_factory=MaintenanceSpec)
    ml_stage: LearningSpec | None = None

    @property
    def landings(self) -> list[BronzeSpec]:
        """What bronze ingests: the table list wins over the single entry."""
        return self.bronze_tables or ([self.bronze] if self.bronze else [])

    @property
    def runs_path(self) -> str:
        if self.mlflow.path:
            return self.mlflow.path.rstrip("/")
        return self.gold.target_delta_path.rstrip("/").rsplit("/", 2)[0] + "/runs"


def parse_spec(raw: Mapping[str, Any]) -> JobSpec:
    return _build(JobSpec, raw, "spec")


def read_spec(text: str) -> JobSpec:
    """A spec from YAML text, wherever it came from."""
    return parse_spec(yaml.safe_load(text))


def load_spec(path: str) -> JobSpec:
    with open(path, encoding="utf-8") as text:
        return read_spec(text.read())


def _build(cls: type, raw: Any, where: str) -> Any:
    """Unknown keys are ignored; a missing or wrongly typed field names its place."""
    if not isinstance(raw, Mapping):
        raise ValueError(f"{where} must be a mapping")
    # YAML 1.1 reads an unquoted ``on:`` as the boolean true.
    raw = {("on" if key is True else key): value for key, value in raw.items()}
    hints = get_type_hints(cls)
    values = {}
    for item in fields(cls):
        place = f"{where}.{item.name}"
        if item.name in raw:
            values[item.name] = _convert(hints[item.name], raw[item.name], place)
        elif item.default is MISSING and item.default_factory is MISSING:
            raise ValueError(f"{place} is required")
    return cls(**values)


def _convert(hint: Any, value: Any, where: str) -> Any:
    options = get_args(hint) if type(None) in get_args(hint) else (hint,)
    if value is None and type(None) in options:
        return None
    wanted = next(o for o in options if o is not type(None))
    if hasattr(wanted, "__dataclass_fields__"):
        return _build(wanted, value, where)
    if get_origin(wanted) is list:
        if not isinstance(value, list):
            raise ValueError(f"{where} must be a list")
        inner = get_args(wanted)[0]
        return [_convert(inner, v, f"{where}[{i}]") for i, v in enumerate(value)]
    if isinstance(value, str) and wanted in (int, float, bool):
        value = yaml.safe_load(value)  # a quoted number or boolean
    accepted = (int, float) if wanted is float else wanted
    if not isinstance(value, accepted) or (isinstance(value, bool) and wanted is not bool):
        raise ValueError(f"{where} must be {wanted.__name__}, not {type(value).__name__}")
    return value
