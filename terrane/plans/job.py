"""The whole job from one spec: bronze, silver, gold, training, upkeep, run record."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import SparkSession

from terrane.operators.learning import DEFAULT_HYPERPARAMETERS, Fit
from terrane.operators.runlog import FAILED, FINISHED, RUNNING, RunLog
from terrane.operators.scoring import save_model
from terrane.operators.upkeep import maintain
from terrane.plans import layers
from terrane.plans.spec import JobSpec, LearningSpec, load_spec, parse_spec


def run(spark: SparkSession, spec: JobSpec | Mapping[str, Any] | str) -> dict[str, Any]:
    """Run every stage; metrics are logged as each stage ends, also for a run that fails."""
    if isinstance(spec, str):
        spec = load_spec(spec)
    elif not isinstance(spec, JobSpec):
        spec = parse_spec(spec)
    log = RunLog(spark, spec.runs_path, spec.mlflow.experiment_name, spec.mlflow.run_name)
    log.status(RUNNING)
    try:
        report = _stages(spark, spec, log)
    except Exception:
        log.status(FAILED)
        raise
    log.status(FINISHED)
    log.tidy()
    return {"run_id": log.run_id, **report}


def _stages(spark: SparkSession, spec: JobSpec, log: RunLog) -> dict[str, Any]:
    params = {"pipeline_name": spec.pipeline_name, "version": spec.version}
    entries = [*([spec.bronze] if spec.bronze else []), *(spec.bronze_tables or [])]
    landing = ";".join(sorted({e.landing_path for e in entries}))
    log.params({**params, "landing_path": landing} if landing else params)

    report: dict[str, Any] = {"bronze_record_count": layers.run_bronze(spark, spec.landings)}
    log.metrics(report)

    silver = layers.run_silver(spark, spec.silver)
    measured = {
        "silver_record_count": silver["clean_count"],
        "quarantine_record_count": silver["quarantine_count"],
        "dropped_record_count": silver["dropped_count"],
        "dq_pass_rate_pct": silver["pass_rate_pct"],
        "dq_quarantine_ratio_pct": silver["quarantine_ratio_pct"],
    }
    log.metrics(measured)
    report |= measured

    measured = {"gold_record_count": layers.run_gold(spark, spec.gold)}
    log.metrics(measured)
    report |= measured

    fit = layers.run_training(spark, spec.ml_stage, spec.gold.target_delta_path)
    report["ml_metrics"] = fit.metrics if fit else {}
    if fit:
        save_model(fit.model, log.model_path())
        log.params(_learning_params(spec.ml_stage, fit))
        log.metrics(_learning_metrics(fit))

    report["maintenance"] = _upkeep(spark, spec)
    return report


def _learning_params(spec: LearningSpec, fit: Fit) -> dict[str, Any]:
    return {
        **{**DEFAULT_HYPERPARAMETERS, **(spec.hyperparameters or {})},
        "train_test_ratio": spec.train_test_split_ratio,
        "categorical_features": spec.categorical_features,
        "numeric_features": spec.numeric_features,
        **{f"best_{name}": value for name, value in fit.best_params.items()},
    }


def _learning_metrics(fit: Fit) -> dict[str, float]:
    rounded = {
        f"test_{name}": None if value is None else round(value, 4)
        for name, value in fit.metrics.items()
    }
    scores = {f"feature_importance_{n}": round(v, 6) for n, v in fit.importances.items()}
    return {**rounded, **scores}


def _upkeep(spark: SparkSession, spec: JobSpec) -> dict[str, str]:
    """Table path to status, or the one word that says the stage is off."""
    wanted = spec.maintenance
    if wanted is None or not wanted.enabled:
        return {"status": "SKIPPED"}
    tables = wanted.tables or [spec.silver.target_delta_path, spec.gold.target_delta_path]
    rows = maintain(spark, tables, wanted.retention_hours).collect()  # one row per table
    return {r["table"]: r["status"] + (f": {r['message']}" if r["message"] else "") for r in rows}
