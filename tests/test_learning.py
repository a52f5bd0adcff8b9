from __future__ import annotations

import pytest
from pyspark.ml.evaluation import RegressionEvaluator

from terrane.functions.columns import PREDICTION
from terrane.operators import learning
from terrane.operators.learning import (
    assembler,
    bins_needed,
    fit_indexer,
    regression_metrics,
    regressor,
    train,
)
from terrane.operators.scoring import load_model, save_model, score_batch, score_full
from terrane.session import scratch_path

SMALL = {"maxIter": 2, "maxDepth": 2}


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(600).selectExpr(
        "id",
        "concat('c', id % 51) AS cat",
        "double(id % 10) AS x",
        "double(id % 10) * 3 + id % 2 AS y",
    )


@pytest.fixture(scope="module")
def fit(rows):
    return train(rows, "y", ["cat"], ["x"], split_keys=["id"], hyperparameters=SMALL)


def test_labels_by_frequency_then_name_with_one_extra_bucket(spark):
    df = spark.sql("SELECT * FROM VALUES ('b'), ('b'), ('a'), ('c'), (NULL) t(s)")
    model = fit_indexer(df, ["s"])
    assert model.labelsArray == [("b", "a", "c")] or [list(x) for x in model.labelsArray] == [
        ["b", "a", "c"]
    ]
    unseen = spark.sql("SELECT * FROM VALUES ('a'), ('zz'), (NULL) t(s)")
    assert [r.s_indexed for r in model.transform(unseen).collect()] == [1.0, 3.0, 3.0]
    assert fit_indexer(df, []) is None


def test_too_many_categories_are_refused(rows):
    known = rows.select("cat").dropna().distinct().count()
    assert fit_indexer(rows, ["cat"], known) is not None
    with pytest.raises(ValueError, match="too many categories"):
        fit_indexer(rows, ["cat"], known - 1)


def test_a_model_does_not_depend_on_the_layout(spark):
    data = spark.range(20000).selectExpr("id", "hash(id) % 1000 AS a", "hash(id, 1) % 100 AS b")
    data = data.selectExpr("id", "double(a) AS a", "double(b) AS b", "a * 0.5 + b AS y")
    found = set()
    for parts in (1, 4, 8):
        fit = train(data.repartition(parts), "y", [], ["a", "b"], hyperparameters={"maxIter": 2, "maxDepth": 3})
        found.add((fit.model.stages[-1].toDebugString.split("\n", 1)[1], fit.metrics["rmse"]))
    assert len({trees for trees, _ in found}) == 1


def test_bins_follow_the_labels(rows, fit):
    assert bins_needed(fit_indexer(rows, ["cat"])) == 52
    assert bins_needed(None) == 32
    assert fit.model.stages[-1].getOrDefault("maxBins") >= 32


def test_assembly_skips_missing_numbers(spark):
    df = spark.sql("SELECT * FROM VALUES (1.0D), (NULL), (double('NaN')) t(x)")
    assert assembler([], ["x"]).transform(df).count() == 1


def test_hyperparameters_reach_the_trees_and_unknown_ones_are_refused():
    trees = regressor("y", {"maxDepth": 3, "subsamplingRate": 0.5, "maxBins": 10}, 7, 40)
    assert trees.getMaxDepth() == 3 and trees.getSubsamplingRate() == 0.5
    assert trees.getMaxIter() == 20 and trees.getMaxBins() == 40
    with pytest.raises(ValueError, match="maxDeep"):
        regressor("y", {"maxDeep": 3}, 7)


def test_metrics_equal_the_evaluator(rows, fit):
    scored = fit.model.transform(rows)
    got = regression_metrics(scored, "y", PREDICTION).first().asDict()
    for name in ("rmse", "mae", "r2"):
        evaluator = RegressionEvaluator(labelCol="y", predictionCol=PREDICTION, metricName=name)
        assert got[name] == pytest.approx(evaluator.evaluate(scored))
    assert regression_metrics(scored.filter("false"), "y", PREDICTION).first().rmse is None


def test_fit_learns_and_names_its_inputs(fit):
    assert fit.metrics["r2"] > 0.5
    assert list(fit.importances) == ["x", "cat_indexed"]
    assert sum(fit.importances.values()) == pytest.approx(1.0)


def test_same_seed_same_fit_on_any_layout(rows, fit):
    again = train(
        rows.repartition(3), "y", ["cat"], ["x"], split_keys=["id"], hyperparameters=SMALL
    )
    assert again.metrics == pytest.approx(fit.metrics)


@pytest.mark.parametrize("metric", ["rmse", "mae", "r2", "var"])
def test_alike_rows_are_fitted_as_one(spark, monkeypatch, metric):
    """Eight kinds of 4,000 rows: fits see a row a kind and fold, and find what all rows give."""
    data = spark.range(4000).selectExpr(
        "id", "concat('c', pmod(hash(id), 2)) AS cat", "double(pmod(hash(id, 1), 2)) AS x",
        "pmod(hash(id), 2) * 10 + pmod(hash(id, 1), 2) * 3.0D + pmod(hash(id, 2), 2) AS y",
    )
    fit, search, seen, scores = learning.GBTRegressor._fit, learning._shared_search, [], []

    def counted(self, dataset):
        seen.append(dataset.count())
        return fit(self, dataset)

    monkeypatch.setattr(learning.GBTRegressor, "_fit", counted)
    monkeypatch.setattr(learning, "_shared_search", lambda *a: scores.append(search(*a)) or scores[-1])
    grid = {"maxDepth": [1, 2], "maxIter": [1, 3]} if metric == "rmse" else {"maxDepth": [1, 2], "maxIter": [1]}
    tuning = {"enabled": True, "num_folds": 2, "metric": metric, "param_grid": grid}
    once = train(data, "y", ["cat"], ["x"], split_keys=["id"], hyperparameters=SMALL, tuning=tuning)
    assert max(seen) <= 16
    monkeypatch.setattr(learning, "_kinds", lambda *a: 0)
    plain = train(data, "y", ["cat"], ["x"], split_keys=["id"], hyperparameters=SMALL, tuning=tuning)
    assert max(seen) > 1000
    assert once.metrics == pytest.approx(plain.metrics) and once.importances == pytest.approx(plain.importances)
    assert once.best_params == plain.best_params
    if metric != "var":
        assert scores[0] == pytest.approx(scores[1])
    # rows of which a parameter counts each are not made one
    seen.clear()
    monkeypatch.undo()
    monkeypatch.setattr(learning.GBTRegressor, "_fit", counted)
    train(data, "y", ["cat"], ["x"], split_keys=["id"], hyperparameters={**SMALL, "minInstancesPerNode": 5})
    assert min(seen) > 1000


def test_tuning_returns_the_best_grid_values(rows):
    tuned = train(
        rows,
        "y",
        [],
        ["x"],
        split_keys=["id"],
        hyperparameters={"maxIter": 2},
        tuning={"enabled": True, "num_folds": 2, "param_grid": {"maxDepth": [1, 4], "no": [1]}},
    )
    assert tuned.best_params == {"maxDepth": 4}


def test_scoring_forms(spark, rows, fit):
    fresh = spark.sql(
        "SELECT * FROM VALUES (1L, 'c1', 2.0D), (2L, 'never', 2.0D), (3L, NULL, 2.0D), "
        "(4L, 'c1', NULL) t(id, cat, x)"
    )
    batch = score_batch(fit.model, fresh, ["id"], "r1")
    assert batch.columns == ["id", PREDICTION, "_predicted_at", "_model_run_id"]
    assert sorted(r.id for r in batch.collect()) == [1, 2, 3]
    assert {r._model_run_id for r in batch.collect()} == {"r1"}
    full = score_full(fit.model, fresh)
    assert full.columns == ["id", "cat", "x", PREDICTION]


def test_model_resolution(spark, fit):
    root = scratch_path(spark, "models")
    for name in ("old", "new"):
        save_model(fit.model, f"{root}/{name}")

    def find(primary, run_id):
        return load_model(spark, primary, run_id, lambda r: f"{root}/{r}", lambda: "new")[1]

    assert find(None, "old") == "old"
    assert find(f"{root}/old", None) == "old"
    assert find(f"{root}/missing", None) == "new"
    assert find(None, None) == "new"
    with pytest.raises(Exception):
        find(f"{root}/old", "missing")


def test_grid_points_share_the_longest_fit(spark, rows, monkeypatch):
    """18 fits instead of 36, and the scores of the plain search."""
    from pyspark.ml.regression import GBTRegressor
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder

    data = rows.withColumn(learning._POSITION, learning.hash_position(1, ["id"])).coalesce(1)
    prepared = assembler([], ["x"]).transform(data).select("y", learning.FEATURES, learning._POSITION).cache()
    folded = prepared.withColumn(learning._FOLD, learning.fold_of(learning.F.col(learning._POSITION), 3))
    trees, fits, real = regressor("y", {}, 42), [], GBTRegressor._fit
    monkeypatch.setattr(GBTRegressor, "_fit", lambda self, frame: fits.append(self.getMaxIter()) or real(self, frame))
    whole = {"maxDepth": [1, 2, 3], "maxIter": [1, 2], "stepSize": [0.1, 0.4]}
    for metric, grid in (("rmse", whole), ("r2", {"maxIter": [1, 2]}), ("mae", {"maxIter": [2, 1]})):
        fits.clear()
        best, chosen = learning.tune(prepared, trees, "y", {"param_grid": grid, "metric": metric}, 42)
        assert fits[:-1] == [2] * (18 if grid is whole else 3)
        points = ParamGridBuilder()
        for name, values in grid.items():
            points.addGrid(trees.getParam(name), values)
        evaluator = RegressionEvaluator(labelCol="y", predictionCol=PREDICTION, metricName=metric)
        search = CrossValidator(
            estimator=trees, estimatorParamMaps=points.build(), evaluator=evaluator, numFolds=3, foldCol=learning._FOLD
        )
        plain = search.fit(folded)
        assert chosen == {name: plain.bestModel.getOrDefault(name) for name in grid}
        assert best.toDebugString.split("\n", 1)[1] == plain.bestModel.toDebugString.split("\n", 1)[1]
        if grid is not whole:
            shared = learning._shared_search(folded, trees, "y", points.build(), metric, 3, 2)
            assert shared == pytest.approx(plain.avgMetrics)
    other = learning.tune(prepared, trees, "y", {"param_grid": {"maxIter": [1, 2]}, "metric": "var"}, 42)[1]
    assert other["maxIter"] in (1, 2)


def _mixed(spark):
    """Categories, statistics, many values, many zeros, few values, and a feature of one value."""
    return spark.range(30000).selectExpr(
        "id", "concat('c', pmod(hash(id, 7), 20)) AS cat", "concat('m', pmod(hash(id, 5), 700)) AS many",
        "double(pmod(hash(id, 1), 50)) - 25 AS x", "hash(id, 2) / 1e6 AS z", "double(greatest(0, pmod(hash(id, 6), 9) - 6)) AS w",
        "0.0D AS nil",
        "pmod(hash(id, 1), 50) * 2.0D + pmod(hash(id, 7), 20) * pmod(hash(id, 6), 9) + abs(hash(id, 2)) / 1e8 AS y",
    ).repartition(3)


@pytest.mark.parametrize("steps", [{"maxIter": 4}, {"maxIter": 3, "maxDepth": 3, "stepSize": 0.7, "minInfoGain": 0.5}])
def test_trees_over_blocks_are_those_of_mllib(spark, monkeypatch, steps):
    import re

    def fitted():
        fit = train(
            _mixed(spark), "y", ["cat", "many"], ["x", "z", "w", "nil"], split_keys=["id"], max_categories=100, hyperparameters=steps
        )
        text = fit.model.stages[-1].toDebugString.split("\n", 1)[1]
        return fit, re.sub(r"-?\d+\.\d+(E-?\d+)?", lambda number: f"{float(number[0]):.9g}", text)

    kept = len(spark.sparkContext._jsc.getPersistentRDDs())
    with monkeypatch.context() as without:  # MLlib, which keeps some objects a row, is not asked
        without.setattr(learning.GBTRegressor, "_fit", lambda *a: pytest.fail("fitted by MLlib"))
        fit, trees = fitted()
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) == kept
    monkeypatch.setattr(learning.boosting, "suited", lambda *a: False)
    plain, expected = fitted()
    assert trees == expected and len(trees) > 1000
    assert fit.metrics == pytest.approx(plain.metrics) and fit.importances == pytest.approx(plain.importances)
    one, other = fit.model.stages[-1], plain.model.stages[-1]
    assert one.treeWeights == other.treeWeights and one.totalNumNodes == other.totalNumNodes
    assert one.getMaxDepth() == other.getMaxDepth() and one.getPredictionCol() == PREDICTION


def test_split_points_count_zeros_as_what_is_left():
    sample = learning.np.array([0.0, 0.0, 1.0, 1.0, 2.0, -3.0])
    assert learning.boosting._points(sample, 31, 6.0).tolist() == [-1.5, 0.5, 1.5]
    assert learning.boosting._points(sample, 31, 4.0).tolist() == [-1.0, 1.5]
    assert learning.boosting._points(learning.np.zeros(3), 31, 3.0).tolist() == []
    assert learning.boosting._points(learning.np.arange(1.0, 101), 3, 100.0).tolist() == [25.5, 50.5, 75.5]


def test_targets_without_spread_and_numbers_without_end(spark):
    flat = spark.range(400).selectExpr("id", "double(id % 40) AS x", "double(hash(id)) AS z", "7 AS y")
    fit = train(flat, "y", [], ["x", "z"], split_keys=["id"], hyperparameters={"maxIter": 2})
    assert fit.metrics["rmse"] == 0 and fit.model.stages[-1].totalNumNodes == 2
    endless = flat.withColumn("x", learning.F.expr("if(id = 5, double('Infinity'), x)"))
    with pytest.raises(Exception, match="finite|NaN or Inf|Inf"):
        train(endless, "y", [], ["x", "z"], split_keys=["id"], hyperparameters={"maxIter": 2})


def test_categories_beyond_the_bins_stand_as_target_statistics(spark):
    data = spark.range(4000).selectExpr(
        "id", "if(id % 97 = 0, NULL, concat('k', id % 500)) AS many", "concat('c', id % 3) AS few",
        "double(id % 7) AS x", "double(id % 500) + id % 3 AS y",
    )
    fit = train(
        data, "y", ["many", "few"], ["x"], split_keys=["id"], max_categories=100, hyperparameters={"maxIter": 3}
    )
    assert list(sorted(fit.importances)) == ["few_indexed", "many_target", "x"]
    assert fit.importances["many_target"] > 0.9 and fit.metrics["r2"] > 0.5
    again = train(
        data.repartition(7), "y", ["many", "few"], ["x"], split_keys=["id"], max_categories=100, hyperparameters={"maxIter": 3}
    )
    assert again.metrics == pytest.approx(fit.metrics)
    path = scratch_path(spark, "model")
    save_model(fit.model, path)
    copy, _ = load_model(spark, path, None, str, str)
    fresh = spark.sql("SELECT * FROM VALUES (1L, 'k7', 'c1', 2.0D), (2L, 'new', 'c1', 2.0D), (3L, NULL, 'z', 2.0D) t(id, many, few, x)")
    one, two = (sorted(map(tuple, score_full(m, fresh).collect()), key=str) for m in (fit.model, copy))
    assert one == two and len(one) == 3
    assert score_full(copy, fresh).columns == ["id", "many", "few", "x", PREDICTION]


def test_statistics_leave_out_the_own_fold(spark):
    from terrane.operators.categories import fold_sums, out_of_fold, target_statistics

    rows = [(k, "ab c"[k % 4] if k % 9 else None, k % 3, float(k * k % 50)) for k in range(300)]
    frame = spark.createDataFrame(rows, "id int, `l.x` string, f int, y double").repartition(4)
    fold = learning.F.col("f")
    sums = fold_sums(frame, ["l.x"], "y", fold)
    got = {r.id: r["l.x_target"] for r in out_of_fold(frame, sums, ["l.x"], fold, prior=5).collect()}
    for key, label, f, _ in rows:
        others = [y for _, _, g, y in rows if g != f]
        same = [y for _, other, g, y in rows if g != f and other == label and label is not None]
        mean = sum(others) / len(others)
        assert got[key] == pytest.approx((sum(same) + 5 * mean) / (len(same) + 5))
    whole = target_statistics(sums, ["l.x"], prior=5).transform(frame)
    mean = sum(r[3] for r in rows) / len(rows)
    for row in whole.collect():
        same = [y for _, label, _, y in rows if label == row["l.x"] and label is not None]
        assert row["l.x_target"] == pytest.approx((sum(same) + 5 * mean) / (len(same) + 5))


def test_five_million_labels_are_indexed_without_the_driver(spark, monkeypatch):
    from pyspark.sql import DataFrame

    from terrane.operators.categories import label_table, with_indexes

    collected, real = [], DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda self: collected.append(real(self)) or collected[-1])
    n = 5_000_000
    frame = spark.range(n + 1000).selectExpr("id", "concat('k', lpad(id % 5000000, 7, '0')) AS many")
    found = with_indexes(frame, label_table(frame, ["many"]), ["many"])
    total = found.selectExpr(
        "count(*) AS rows", "count(DISTINCT many_indexed) AS n", "max(many_indexed) AS last",
        "max(if(id < 1000, many_indexed, 0)) AS repeated", "count_if(id >= 1000 AND id < 5000000 AND many_indexed <> id) AS odd",
    ).first()
    assert (total.rows, total.n, total.last, total.repeated, total.odd) == (n + 1000, n, n - 1, 999, 0)
    assert sum(map(len, collected)) < 100


def test_hold_out_metrics_of_the_gold_features_by_hand(spark):
    import numpy as np

    from terrane.functions.columns import hash_position, within_share
    from terrane.queries.learning import CATEGORICAL, NUMERIC, TARGET, boosted

    fit, rows = boosted(spark, "/root/testdata/sf0.001")
    used = [TARGET, *CATEGORICAL, "customer_id", *NUMERIC]
    held_out = rows.filter(~within_share(hash_position(42, used), 0.8))
    scored = fit.model.transform(held_out).select(TARGET, PREDICTION).toPandas()
    assert len(scored) == held_out.dropna(subset=used).count() > 500
    error = (scored[PREDICTION] - scored[TARGET]).to_numpy(float)
    spread = ((scored[TARGET] - scored[TARGET].mean()) ** 2).sum()
    assert fit.metrics["rmse"] == pytest.approx(np.sqrt((error**2).mean()))
    assert fit.metrics["mae"] == pytest.approx(np.abs(error).mean())
    assert fit.metrics["r2"] == pytest.approx(1 - (error**2).sum() / spread)
    assert set(fit.importances) == {"c_mktsegment_indexed", "p_brand_indexed", "customer_id_target", *NUMERIC}
