"""Gradient-boosted-tree regression on MLlib: index, assemble, fit, tune, evaluate."""

from __future__ import annotations

import logging
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool
from typing import Any

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrane.functions.columns import (
    PREDICTION,
    column,
    fold_of,
    hash_position,
    within_share,
)
from terrane.operators import boosting
from terrane.operators.categories import (
    fold_sums,
    out_of_fold,
    statistics_name,
    target_statistics,
)
from terrane.operators.cleansing import drop_missing
from terrane.session import ensure_checkpoint_dir, estimated_bytes, layout_for, settings
from terrane.sources import paths
from terrane.sources.tables import stage

_log = logging.getLogger(__name__)

FEATURES = "features"
_FOLD = "__fold"
_POSITION = "__position"
_WEIGHT = "__weight"
# Bytes a training partition should take: small, as every tree level passes over them.
_TRAINING_BYTES = 4 * 1024 * 1024
# Alike rows are fitted as one where a row stands for so many, by a look at the first and then
# by an estimate over all; it decides the work, never the result.
_SHARED = 8
_LOOK = 10_000
_ALIKE_BYTES = 100
# Parameters that see weights, not rows, so that alike rows may be one.
_BY_WEIGHT = {"maxIter", "maxDepth", "stepSize", "maxBins", "minInfoGain", "lossType"}
# Folds of which target statistics leave out the row's own.
_STATISTICS_FOLDS = 5
# Defaults of an unconfigured fit.
DEFAULT_HYPERPARAMETERS = {"maxDepth": 5, "maxIter": 20, "stepSize": 0.1}


@dataclass
class Fit:
    """A fitted pipeline with what was learned about it."""

    model: PipelineModel
    metrics: dict[str, float]
    importances: dict[str, float]
    best_params: dict[str, Any] = field(default_factory=dict)


def indexed_name(name: str) -> str:
    return f"{name}_indexed"


def feature_names(
    categorical: Sequence[str], numeric: Sequence[str], encoded: Sequence[str] = ()
) -> list[str]:
    return [*map(indexed_name, categorical), *map(statistics_name, encoded), *numeric]


def many_valued(df: DataFrame, categorical: Sequence[str], most: int | None) -> list[str]:
    """The columns of more than `most` values, by an exact count."""
    if most is None:
        return []
    return [c for c in categorical if df.select(column(c)).dropna().distinct().limit(most + 1).count() > most]


def fit_indexer(
    df: DataFrame, categorical: Sequence[str], max_categories: int | None = None
) -> StringIndexerModel | None:
    """Frequency-ordered labels of all categorical columns.

    Ties are alphabetical; unseen and NULL values share one extra bucket when applied. Labels
    travel through the driver; with ``max_categories`` a column of more is refused, by an
    exact count, before they do.
    """
    if not categorical:
        return None
    refused = many_valued(df, categorical, max_categories)
    if refused:
        raise ValueError(f"too many categories in {refused}: more than {max_categories}")
    return StringIndexer(
        inputCols=list(categorical),
        outputCols=[indexed_name(c) for c in categorical],
        handleInvalid="keep",
        stringOrderType="frequencyDesc",
    ).fit(df)


def assembler(
    categorical: Sequence[str], numeric: Sequence[str], encoded: Sequence[str] = ()
) -> VectorAssembler:
    """Indexed categories, target statistics, numbers; rows with a NULL or NaN are skipped."""
    return VectorAssembler(
        inputCols=feature_names(categorical, numeric, encoded), outputCol=FEATURES, handleInvalid="skip"
    )


def regressor(
    target: str, hyperparameters: Mapping[str, Any] | None, seed: int, max_bins: int = 32
) -> GBTRegressor:
    chosen = {**DEFAULT_HYPERPARAMETERS, **(hyperparameters or {})}
    trees = GBTRegressor(
        featuresCol=FEATURES, labelCol=target, predictionCol=PREDICTION, seed=seed, maxBins=max_bins
    )
    unknown = sorted(name for name in chosen if not trees.hasParam(name))
    if unknown:
        raise ValueError(f"unknown hyperparameters {unknown}")
    chosen["maxBins"] = max(int(chosen.get("maxBins", 0)), max_bins)
    return trees.setParams(**chosen)


def bins_needed(indexer: StringIndexerModel | None) -> int:
    """Trees need a bin per category, the extra bucket included."""
    labels = indexer.labelsArray if indexer is not None else []
    return max([32, *(len(known) + 1 for known in labels)])


def regression_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """RMSE, MAE and R² as one aggregate over rows that have both values."""
    error = column(predicted) - column(actual)
    both = df.filter(column(predicted).isNotNull() & column(actual).isNotNull())
    spread = F.var_pop(column(actual).cast("double")) * F.count(F.lit(1))
    return both.agg(
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        (1 - F.sum(error * error) / F.nullif(spread, F.lit(0.0))).alias("r2"),
    )


def importances(model: PipelineModel) -> dict[str, float]:
    """Scores of the tree stage by assembler input, highest first."""
    inputs = next(s for s in model.stages if isinstance(s, VectorAssembler)).getInputCols()
    scores = model.stages[-1].featureImportances
    named = {name: float(scores[i]) for i, name in enumerate(inputs)}
    return dict(sorted(named.items(), key=lambda item: (-item[1], item[0])))


def train(
    df: DataFrame,
    target: str,
    categorical: Sequence[str],
    numeric: Sequence[str],
    *,
    split_keys: Sequence[str] | None = None,
    train_share: float = 0.8,
    seed: int = 42,
    hyperparameters: Mapping[str, Any] | None = None,
    tuning: Mapping[str, Any] | None = None,
    max_categories: int | None = 10_000,
) -> Fit:
    """Split, fit (tuned if asked), and evaluate on the held-out part.

    Trees need a bin per category in every task, so a categorical column of more than
    ``max_categories`` values (None: any number) is not indexed but stands as the mean target
    of its label: that of the other folds while fitting, of all training rows when scoring. Rows are partitioned and
    ordered by their hash position, into a number of parts that follows their bytes, so the
    same rows and seed give the same trees on any number of cores. Where most rows are alike in
    target and features, one of each kind is fitted, weighted by their number.

    Without ``split_keys`` a row is placed by its target and features, so exact copies stay
    on one side and cannot leak into the test; give a row key to place them one by one.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    needed = [target, *categorical, *numeric]
    keys = list(split_keys or needed)
    rows = drop_missing(df, needed).select(*map(column, dict.fromkeys(needed + keys)))
    placed = rows.withColumn(_POSITION, hash_position(seed, keys))
    placed = placed.select(*map(column, needed), _POSITION)
    parts = max(1, -(-min(estimated_bytes(rows), _UNKNOWN_BYTES) // _TRAINING_BYTES))
    # Indexing, fitting and evaluation all pass over these columns: keep them once, durably.
    rows, path = stage(_ordered(placed, parts, needed), "train")
    with settings(spark, {**layout_for(spark, estimated_bytes(rows)), **_READING}), _removed(spark, path):
        inside = within_share(F.col(_POSITION), train_share)
        training, holdout = rows.filter(inside), rows.filter(~inside)
        encoded = many_valued(training, categorical, max_categories)
        indexed = [c for c in categorical if c not in encoded]
        indexer = fit_indexer(training, indexed)
        indexing = [indexer] if indexer is not None else []
        features, encoding, fitting = assembler(indexed, numeric, encoded), [], training
        if encoded:
            fold = fold_of(F.col(_POSITION), _STATISTICS_FOLDS)
            sums = fold_sums(training, encoded, target, fold)
            encoding = [target_statistics(sums, encoded)]
            fitting, _ = stage(_ordered(out_of_fold(training, sums, encoded, fold), parts, needed), "encoded")
        trees = regressor(target, hyperparameters, seed, bins_needed(indexer))
        tuned = bool(tuning and tuning.get("enabled"))
        inputs = [target, FEATURES, _POSITION]
        named = {*(hyperparameters or {}), *((tuning.get("param_grid") or {}) if tuned else {})}
        if not encoded and named <= _BY_WEIGHT and (kinds := _kinds(training, needed)):
            by = fold_of(F.col(_POSITION), int(tuning.get("num_folds", 3))) if tuned else F.lit(0)
            fitting, trees = _alike(training.withColumn(_FOLD, by), needed, kinds), trees.setWeightCol(_WEIGHT)
            inputs = [target, FEATURES, _FOLD, _WEIGHT]
        places = PipelineModel(indexing).transform(fitting)
        prepared = features.transform(places).select(*inputs)
        if tuned:
            fitted, best = tune(prepared, trees, target, tuning, seed)
        else:
            arities = {k: len(labels) + 1 for k, labels in enumerate(indexer.labelsArray if indexing else [])}
            count = 0 if _WEIGHT in inputs else fitting.count()
            if boosting.suited(trees, named, count, arities, len(features.getInputCols())):
                fitted = boosting.fit(places, trees, target, features.getInputCols(), arities, count)
            else:
                fitted = trees.fit(prepared)
            best = {}
        model = PipelineModel([*indexing, *encoding, features, fitted])
        scored = model.transform(holdout)
        measured = regression_metrics(scored, target, PREDICTION).first().asDict()
    return Fit(model, measured, importances(model), best)


def _kinds(rows: DataFrame, columns: Sequence[str]) -> int:
    """About how many different rows there are, if they stand for `_SHARED` each or more; else 0."""
    first = rows.select(*map(column, columns)).take(_LOOK)
    if _SHARED * len(set(first)) > len(first):
        return 0
    different = F.approx_count_distinct(F.xxhash64(*map(column, columns)))
    kinds, total = rows.agg(different, F.count(F.lit(1))).first()
    return kinds if _SHARED * kinds <= total else 0


def _alike(rows: DataFrame, columns: Sequence[str], kinds: int) -> DataFrame:
    """Rows that differ in the columns or the fold, each with the number of those alike. They are
    placed by their values, into parts that follow their number, like the rows of a plain fit."""
    by = [*map(column, columns), F.col(_FOLD)]
    counted = rows.groupBy(*by).agg(F.count(F.lit(1)).cast("double").alias(_WEIGHT))
    parts = max(1, -(-kinds * _ALIKE_BYTES // _TRAINING_BYTES))
    return stage(counted.repartition(parts, *by).sortWithinPartitions(*by), "alike")[0]


def _ordered(rows: DataFrame, parts: int, columns: Sequence[str]) -> DataFrame:
    return rows.repartition(parts, _POSITION).sortWithinPartitions(_POSITION, *map(column, columns))


# A scan that opens each staged file as one partition, however many cores there are; joins whose
# smaller side is small in every partition are not sorted.
_READING = {
    "spark.sql.files.openCostInBytes": "134217728",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
}
_UNKNOWN_BYTES = 1 << 42


@contextmanager
def _removed(spark: SparkSession, path: str) -> Iterator[None]:
    """Remove a staged folder at the end."""
    try:
        yield
    finally:
        paths.remove(spark, path)


def tune(
    prepared: DataFrame,
    trees: GBTRegressor,
    target: str,
    tuning: Mapping[str, Any],
    seed: int,
):
    """Grid search by k-fold cross-validation; returns the refitted best model and its values.

    Folds come from the rows' hash positions, so a retried fit sees the same folds. Boosting
    adds its trees one after another, so a fit of ``maxIter`` trees begins with those of every
    shorter one: grid points that differ in ``maxIter`` alone share the longest fit of each
    fold, and one pass over the held-out rows measures all its beginnings.
    """
    wanted = dict(tuning.get("param_grid") or {})
    for name in [n for n in wanted if not trees.hasParam(n)]:
        _log.warning("param_grid entry %r is not a parameter of the trees; skipped", name)
        del wanted[name]
    grid = ParamGridBuilder()
    for name, values in wanted.items():
        grid.addGrid(trees.getParam(name), list(values))
    points, metric = grid.build(), tuning.get("metric", "rmse")
    folds, parallelism = int(tuning.get("num_folds", 3)), int(tuning.get("parallelism", 1))
    folded = prepared
    if _FOLD not in prepared.columns:
        folded = prepared.withColumn(_FOLD, fold_of(F.col(_POSITION), folds))
    if metric in _ERRORS:
        scores = _shared_search(folded, trees, target, points, metric, folds, parallelism)
        chosen = points[int(np.argmax(scores) if metric == "r2" else np.argmin(scores))]
        best = trees.copy(chosen).fit(prepared)
    else:
        best = _plain_search(folded, trees, target, points, metric, folds, parallelism, seed)
    return best, {name: best.getOrDefault(best.getParam(name)) for name in wanted}


# The loss whose mean over rows leads to each metric.
_ERRORS = {"rmse": "squared", "mse": "squared", "r2": "squared", "mae": "absolute"}


def _shared_search(
    folded: DataFrame, trees: GBTRegressor, target: str, points: Sequence[dict], metric: str, folds: int, parallelism: int
) -> list[float]:
    """The metric of each grid point, the mean of its folds."""
    length = trees.getParam("maxIter")
    groups: dict[tuple, list[int]] = {}
    for k, point in enumerate(points):
        rest = tuple(sorted((p.name, value) for p, value in point.items() if p.name != "maxIter"))
        groups.setdefault(rest, []).append(k)

    def fitted(task: tuple[list[int], int]) -> list[tuple[int, float]]:
        members, fold = task
        lengths = [points[k].get(length, trees.getMaxIter()) for k in members]
        longest = trees.copy({**points[members[0]], length: max(lengths)})
        held_out = folded.filter(F.col(_FOLD) == fold)
        model = longest.fit(folded.filter(F.col(_FOLD) != fold))
        if _WEIGHT in folded.columns:
            errors, spread = _weighted_errors(model, held_out, target, _ERRORS[metric])
        else:
            errors = model.evaluateEachIteration(held_out, _ERRORS[metric])
            spread = held_out.agg(F.var_pop(target)).first()[0] if metric == "r2" else None
        return [(k, _of_error(errors[n - 1], metric, spread)) for k, n in zip(members, lengths)]

    tasks = [(members, fold) for members in groups.values() for fold in range(folds)]
    # Each fit already fills the cluster; fits side by side are for whoever asks.
    with ThreadPool(max(1, parallelism)) as pool:
        found = [pair for pairs in pool.map(fitted, tasks) for pair in pairs]
    return [float(np.mean([value for k, value in found if k == point])) for point in range(len(points))]


def _weighted_errors(
    model: GBTRegressionModel, held_out: DataFrame, target: str, loss: str
) -> tuple[list[float], float]:
    """The mean loss of the first tree, of the first two, and so on, and the target's variance,
    over rows that count by their weight."""
    weight, actual = F.col(_WEIGHT), column(target)
    mean = lambda value: F.sum(weight * value) / F.sum(weight)
    middle = held_out.agg(mean(actual)).first()[0]
    scored, guess, means = held_out, F.lit(0.0), [mean((actual - F.lit(middle)) ** 2)]
    for k, (tree, share) in enumerate(zip(model.trees, model.treeWeights)):
        scored = tree.setFeaturesCol(FEATURES).setPredictionCol(f"__tree{k}").transform(scored)
        guess = guess + F.lit(float(share)) * F.col(f"__tree{k}")
        means.append(mean((guess - actual) ** 2 if loss == "squared" else F.abs(guess - actual)))
    spread, *errors = scored.agg(*means).first()
    return errors, spread


def _of_error(error: float, metric: str, spread: float | None) -> float:
    if metric == "rmse":
        return error**0.5
    if metric == "r2":
        return 1 - error / spread if spread else float("-inf")
    return error


def _plain_search(folded, trees, target, points, metric, folds, parallelism, seed):
    """Every grid point fitted by itself, for metrics that are no mean over rows."""
    evaluator = RegressionEvaluator(labelCol=target, predictionCol=PREDICTION, metricName=metric)
    if _WEIGHT in folded.columns:
        evaluator = evaluator.setWeightCol(_WEIGHT)
    search = CrossValidator(
        estimator=trees,
        estimatorParamMaps=points,
        evaluator=evaluator,
        numFolds=folds,
        foldCol=_FOLD,
        parallelism=parallelism,
        seed=seed,
    )
    return search.fit(folded).bestModel
