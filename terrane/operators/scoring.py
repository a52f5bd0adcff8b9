"""Applying a saved pipeline to whole tables."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrane.functions.columns import MODEL_RUN_ID, PREDICTED_AT, PREDICTION, column, residual
from terrane.operators.categories import TargetStatistics
from terrane.operators.profiling import histogram

_log = logging.getLogger(__name__)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(
    spark: SparkSession,
    primary: str | None,
    run_id: str | None,
    model_of: Callable[[str], str],
    latest_run: Callable[[], str],
) -> tuple[PipelineModel, str]:
    """The model and the run id it is credited to.

    An explicit run id is used as given and never replaced. Otherwise the primary
    location is tried first and the latest finished run's model is the fallback.
    """
    if run_id is not None:
        return PipelineModel.load(model_of(run_id)), run_id
    if primary is not None:
        try:
            return PipelineModel.load(primary), primary.rstrip("/").rsplit("/", 1)[-1]
        except Exception as error:
            _log.warning("%s did not load (%s); using the latest finished run", primary, error)
    found = latest_run()
    return PipelineModel.load(model_of(found)), found


def _named(model: PipelineModel, scored: DataFrame) -> DataFrame:
    """The column that the model itself predicts into, under its public name."""
    return scored.withColumnRenamed(model.stages[-1].getPredictionCol(), PREDICTION)


def score_batch(
    model: PipelineModel, df: DataFrame, id_columns: Sequence[str], run_id: str
) -> DataFrame:
    """Id columns, the prediction, and when and by which model it was made."""
    scored = _named(model, model.transform(df))
    return scored.select(
        *map(column, id_columns),
        PREDICTION,
        F.current_timestamp().alias(PREDICTED_AT),
        F.lit(run_id).alias(MODEL_RUN_ID),
    )


def score_full(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Every input column plus the prediction; the model's working columns are dropped."""
    working = []
    for step in model.stages:
        if isinstance(step, StringIndexerModel):
            working += step.getOutputCols() if step.isSet("outputCols") else [step.getOutputCol()]
        elif isinstance(step, VectorAssembler):
            working.append(step.getOutputCol())
        elif isinstance(step, TargetStatistics):
            working += step.getOutputCols()
    scored = model.transform(df).drop(*[c for c in working if c not in df.columns])
    return _named(model, scored)


def residuals(df: DataFrame, predicted: str, actual: str, name: str = "residual") -> DataFrame:
    """Predicted minus actual, for rows that have both."""
    return df.dropna(subset=[predicted, actual]).withColumn(name, residual(predicted, actual))


def residual_histogram(df: DataFrame, predicted: str, actual: str, bins: int = 50) -> DataFrame:
    return histogram(residuals(df, predicted, actual), "residual", bins)
