"""Splits, encodings, boosted trees and scoring over the gold features."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrane.functions.columns import MODEL_RUN_ID, PREDICTED_AT, PREDICTION, fold_of, hash_position
from terrane.operators.categories import (
    fold_sums,
    label_table,
    out_of_fold,
    statistics_name,
    with_indexes,
)
from terrane.operators.learning import (
    Fit,
    assembler,
    fit_indexer,
    regression_metrics,
    train,
)
from terrane.operators.runlog import of_latest_run
from terrane.operators.sampling import split
from terrane.operators.scoring import load_model, save_model, score_batch, score_full
from terrane.plans.job import run
from terrane.plans.layers import run_gold_scoring, run_scoring
from terrane.plans.spec import read_spec
from terrane.queries.gold import gold_features
from terrane.queries.profile import predicted
from terrane.queries.registry import query, table
from terrane.session import scratch_path
from terrane.sources.tables import read_table, small_frame, write_table

CATEGORICAL = ["c_mktsegment", "p_brand"]
NUMERIC = ["l_extendedprice", "l_quantity", "p_retailprice"]
TARGET = "actual_delay_days"
# Few, shallow trees where the query shows something else than the fit.
SMALL = {"maxIter": 3, "maxDepth": 3, "stepSize": 0.1}


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines whose target depends on a status and a flag: four cells.

    One tree of depth two must predict the training mean of each cell, and that is
    something SQL can say as well.
    """
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey",
        "l_linenumber",
        "l_linestatus",
        "double(l_quantity > 25) AS large",
        "l_quantity + if(l_linestatus = 'F', 30, 0) AS target",
    )


_CELLS = """
    WITH r AS (
      SELECT l_orderkey, l_linenumber, l_linestatus, (l_quantity > 25)::INTEGER::DOUBLE AS large,
             l_quantity + CASE WHEN l_linestatus = 'F' THEN 30 ELSE 0 END AS target,
             ('0x' || substr(md5('42:' || l_orderkey || ':' || l_linenumber), 1, 8))::BIGINT
               < 3435973837 AS training
      FROM lineitem),
    m AS (SELECT l_linestatus, large, avg(target) AS guess FROM r WHERE training GROUP BY ALL),
    s AS (SELECT r.*, guess FROM r JOIN m USING (l_linestatus, large))"""

_CELL_METRICS = """
    SELECT 'rmse' AS metric, round(sqrt(avg((guess - target) ** 2)), 6) AS value
    FROM s WHERE NOT training
    UNION ALL SELECT 'mae', round(avg(abs(guess - target)), 6) FROM s WHERE NOT training
    UNION ALL SELECT 'r2', round(1 - sum((guess - target) ** 2) / (var_pop(target) * count(*)), 6)
    FROM s WHERE NOT training"""


def _fit_cells(spark: SparkSession, sf_dir: str, **extra) -> Fit:
    return train(
        cells(spark, sf_dir),
        "target",
        ["l_linestatus"],
        ["large"],
        split_keys=["l_orderkey", "l_linenumber"],
        **extra,
    )


def cell_model(spark: SparkSession, sf_dir: str) -> Fit:
    return _fit_cells(spark, sf_dir, hyperparameters={"maxIter": 1, "maxDepth": 2})


@query(
    "ml_split",
    """SELECT o_orderkey, o_custkey,
              CASE WHEN ('0x' || substr(md5('42:' || o_orderkey), 1, 8))::BIGINT < 3435973837
                   THEN 'train' ELSE 'test' END AS part
       FROM orders""",
)
def ml_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    training, test = split(rows, ["o_orderkey"], 0.8, seed=42)
    return training.withColumn("part", F.lit("train")).unionByName(
        test.withColumn("part", F.lit("test"))
    )


def branded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts with one brand and one size taken away."""
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey",
        "nullif(p_brand, 'Brand#2') AS brand",
        "p_type AS kind",
        "nullif(p_size, 5) AS size",
        "p_retailprice",
    )


_INDEXED = """
    WITH p AS (SELECT p_partkey, nullif(p_brand, 'Brand#2') AS brand, p_type AS kind,
                      nullif(p_size, 5) AS size, p_retailprice FROM part),
         b AS (SELECT brand, row_number() OVER (ORDER BY count(*) DESC, brand) - 1 AS i
               FROM p WHERE brand IS NOT NULL GROUP BY brand),
         k AS (SELECT kind, row_number() OVER (ORDER BY count(*) DESC, kind) - 1 AS i
               FROM p GROUP BY kind)
    SELECT p_partkey, p.brand, p.kind, size, p_retailprice, k.i::DOUBLE AS kind_indexed,
           coalesce(b.i, (SELECT count(*) FROM b))::DOUBLE AS brand_indexed
    FROM p LEFT JOIN b ON p.brand = b.brand JOIN k ON p.kind = k.kind"""


@query(
    "ml_string_index",
    f"SELECT p_partkey, brand, kind, brand_indexed, kind_indexed FROM ({_INDEXED})",
)
def ml_string_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = branded(spark, sf_dir)
    indexed = fit_indexer(rows, ["brand", "kind"]).transform(rows)
    return indexed.select("p_partkey", "brand", "kind", "brand_indexed", "kind_indexed")


@query(
    "ml_assemble",
    f"""SELECT p_partkey, brand_indexed AS f0, size::DOUBLE AS f1, p_retailprice AS f2
        FROM ({_INDEXED}) WHERE size IS NOT NULL""",
)
def ml_assemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = branded(spark, sf_dir)
    indexed = fit_indexer(rows, ["brand"]).transform(rows)
    assembled = assembler(["brand"], ["size", "p_retailprice"]).transform(indexed)
    values = vector_to_array("features")
    return assembled.select("p_partkey", *[values[i].alias(f"f{i}") for i in range(3)])


@query(
    "ml_metrics",
    """SELECT round(sqrt(avg((guess - actual) ** 2)), 6) AS rmse,
              round(avg(abs(guess - actual)), 6) AS mae,
              round(1 - sum((guess - actual) ** 2) / (var_pop(actual) * count(*)), 6) AS r2
       FROM (SELECT l_quantity * 1500 + 10 AS guess, l_extendedprice AS actual
             FROM lineitem WHERE l_returnflag <> 'R')""",
)
def ml_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = regression_metrics(predicted(spark, sf_dir), "actual", "guess")
    return measured.select(*[F.round(c, 6).alias(c) for c in ("rmse", "mae", "r2")])


def _named(spark: SparkSession, values: dict[str, float], name: str) -> DataFrame:
    rows = [(k, float(v)) for k, v in values.items()]
    return small_frame(spark, rows, f"{name} string, value double")


def _rounded(metrics: DataFrame) -> DataFrame:
    return metrics.withColumn("value", F.round("value", 6))


@query("ml_train", f"{_CELLS} {_CELL_METRICS}")
def ml_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hold-out metrics of the cell model."""
    return _rounded(_named(spark, cell_model(spark, sf_dir).metrics, "metric"))


@query("ml_tune", f"{_CELLS} {_CELL_METRICS} UNION ALL SELECT 'best_maxDepth', 2")
def ml_tune(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cross-validation finds that one level of splits is not enough for four cells."""
    fit = _fit_cells(
        spark,
        sf_dir,
        hyperparameters={"maxIter": 1},
        tuning={"enabled": True, "num_folds": 3, "param_grid": {"maxDepth": [1, 2]}},
    )
    best = {f"best_{name}": value for name, value in fit.best_params.items()}
    return _rounded(_named(spark, {**fit.metrics, **best}, "metric"))


@query(
    "ml_feature_importance",
    f"""{_CELLS},
    v AS (SELECT (SELECT var_pop(target) * count(*) FROM r WHERE training) AS whole,
                 (SELECT sum(x) FROM (SELECT var_pop(target) * count(*) AS x FROM r
                                      WHERE training GROUP BY l_linestatus)) AS by_status,
                 (SELECT sum(x) FROM (SELECT var_pop(target) * count(*) AS x FROM r
                                      WHERE training GROUP BY l_linestatus, large)) AS by_cell)
    SELECT 'l_linestatus_indexed' AS feature,
           round((whole - by_status) / (whole - by_cell), 6) AS value FROM v
    UNION ALL SELECT 'large', round((by_status - by_cell) / (whole - by_cell), 6) FROM v""",
)
def ml_feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each feature's share of the variance the tree explains, highest first."""
    scores = _named(spark, cell_model(spark, sf_dir).importances, "feature")
    return _rounded(scores).orderBy(F.col("value").desc(), "feature")


_STUMPS = """
    WITH r AS (
      SELECT l_orderkey, l_linenumber, l_linestatus, (l_quantity > 25)::INTEGER::DOUBLE AS large,
             l_quantity + CASE WHEN l_linestatus = 'F' THEN 30 ELSE 0 END AS target,
             ('0x' || substr(md5('42:' || l_orderkey || ':' || l_linenumber), 1, 8))::BIGINT
               < 3435973837 AS training
      FROM lineitem),
    one AS (SELECT l_linestatus, avg(target) AS first FROM r WHERE training GROUP BY ALL),
    two AS (SELECT large, avg(target - first) AS second FROM r JOIN one USING (l_linestatus)
            WHERE training GROUP BY ALL),
    s AS (SELECT r.*, first + second AS guess
          FROM r JOIN one USING (l_linestatus) JOIN two USING (large))"""


@query("ml_boost_steps", f"{_STUMPS} {_CELL_METRICS}")
def ml_boost_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two stumps at step 0.5: the status first, then the quantity on what is left.

    The second tree is fitted to twice the residuals, so half of it is their mean.
    """
    steps = {"maxIter": 2, "maxDepth": 1, "stepSize": 0.5}
    return _rounded(_named(spark, _fit_cells(spark, sf_dir, hyperparameters=steps).metrics, "metric"))


@query("ml_boost_cells", f"{_CELLS} {_CELL_METRICS}")
def ml_boost_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The default 20 trees of depth 5: the first finds the cells, the rest leave them."""
    return _rounded(_named(spark, _fit_cells(spark, sf_dir).metrics, "metric"))


@query("ml_grid_search", f"{_CELLS} {_CELL_METRICS}")
def ml_grid_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A grid of 3 x 2 x 2 points with three folds: any that has two levels finds the cells."""
    grid = {"maxDepth": [1, 2, 3], "maxIter": [1, 2], "stepSize": [0.05, 0.1]}
    tuning = {"enabled": True, "num_folds": 3, "param_grid": grid}
    return _rounded(_named(spark, _fit_cells(spark, sf_dir, tuning=tuning).metrics, "metric"))


def boosted(spark: SparkSession, sf_dir: str) -> tuple[Fit, DataFrame]:
    """The default trees on all gold features, and the rows they come from.

    The customer is a category of any number of values, so it stands as a target statistic.
    """
    gold = scratch_path(spark, "gold")
    write_table(gold_features(spark, sf_dir), gold)
    rows = read_table(spark, gold)
    return train(rows, TARGET, [*CATEGORICAL, "customer_id"], NUMERIC, max_categories=64), rows


@query("ml_train_boosted")
def ml_train_boosted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hold-out metrics and importances on all gold features."""
    fit, _ = boosted(spark, sf_dir)
    return _named(spark, {**fit.metrics, **fit.importances}, "key")


_FOLDED = """
    WITH r AS (SELECT p_partkey, nullif(p_brand, 'Brand#2') AS brand, p_type AS kind,
                      p_retailprice::DECIMAL(38, 9) AS price,
                      ('0x' || substr(md5('42:' || p_partkey), 1, 8))::BIGINT % 5 AS fold FROM part),
    t AS (SELECT count(*) AS n, sum(price) AS s FROM r),
    f AS (SELECT fold, (t.s - sum(price))::DOUBLE / (t.n - count(*)) AS mean FROM r, t GROUP BY fold, t.n, t.s)"""


@query(
    "ml_target_statistics",
    f"""{_FOLDED},
    b AS (SELECT a.p_partkey, sum(o.price)::DOUBLE AS s, count(o.price) AS n
          FROM r a LEFT JOIN r o ON a.brand = o.brand AND a.fold <> o.fold GROUP BY a.p_partkey),
    k AS (SELECT a.p_partkey, sum(o.price)::DOUBLE AS s, count(o.price) AS n
          FROM r a LEFT JOIN r o ON a.kind = o.kind AND a.fold <> o.fold GROUP BY a.p_partkey)
    SELECT p_partkey, fold::INTEGER AS fold,
           round((coalesce(b.s, 0) + 20 * mean) / (b.n + 20), 6) AS brand_target,
           round((coalesce(k.s, 0) + 20 * mean) / (k.n + 20), 6) AS kind_target
    FROM r JOIN f USING (fold) JOIN b USING (p_partkey) JOIN k USING (p_partkey)""",
)
def ml_target_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each part's brand and kind as the mean price of the other folds' parts of that label."""
    rows, columns = branded(spark, sf_dir), ["brand", "kind"]
    fold = fold_of(hash_position(42, ["p_partkey"]), 5)
    sums = fold_sums(rows, columns, "p_retailprice", fold)
    encoded = out_of_fold(rows, sums, columns, fold, prior=20.0)
    means = [F.round(statistics_name(name), 6).alias(statistics_name(name)) for name in columns]
    return encoded.select("p_partkey", fold.alias("fold"), *means)


@query("ml_label_table", f"SELECT p_partkey, brand, kind, brand_indexed, kind_indexed FROM ({_INDEXED})")
def ml_label_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The string index by a joined table of labels, for any number of them."""
    rows, columns = branded(spark, sf_dir), ["brand", "kind"]
    indexed = with_indexes(rows, label_table(rows, columns), columns)
    return indexed.select("p_partkey", "brand", "kind", "brand_indexed", "kind_indexed")


@query("ml_save_load", "SELECT count(*) AS rows, 0 AS changed FROM lineitem")
def ml_save_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the gold features scored alike by a model and by its saved and loaded copy."""
    gold, path = scratch_path(spark, "gold"), scratch_path(spark, "model")
    write_table(gold_features(spark, sf_dir), gold)
    fit = train(read_table(spark, gold), TARGET, CATEGORICAL, NUMERIC, hyperparameters=SMALL)
    save_model(fit.model, path)
    copy, _ = load_model(spark, path, None, str, str)
    once = score_full(fit.model, read_table(spark, gold)).withColumnRenamed(PREDICTION, "before")
    both = score_full(copy, once)
    return both.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(~F.col("before").eqNullSafe(F.col(PREDICTION))).alias("changed"),
    )


@query(
    "score_batch",
    f"""{_CELLS} SELECT l_orderkey, l_linenumber, round(guess, 6) AS predicted_delay_days,
                       true AS dated, 'run-1' AS model_run FROM s""",
)
def score_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The appended prediction table: ids, prediction, and the model it is credited to."""
    target = scratch_path(spark, "predictions")
    model = cell_model(spark, sf_dir).model
    scored = score_batch(model, cells(spark, sf_dir), ["l_orderkey", "l_linenumber"], "run-1")
    write_table(scored, target, "append")
    return read_table(spark, target).select(
        "l_orderkey",
        "l_linenumber",
        F.round(PREDICTION, 6).alias(PREDICTION),
        F.col(PREDICTED_AT).isNotNull().alias("dated"),
        F.col(MODEL_RUN_ID).alias("model_run"),
    )


@query(
    "score_repeat",
    """SELECT 'first' AS scoring, count(*) AS written, 0 AS known,
              (SELECT count(*) FROM lineitem WHERE l_quantity <= 2) AS skipped
       FROM lineitem WHERE l_quantity > 2
       UNION ALL SELECT 'second', 0, count(k), count(*) - count(k)
       FROM lineitem l LEFT JOIN (SELECT DISTINCT l_orderkey AS k, l_linenumber AS n
                                  FROM lineitem WHERE l_quantity > 2)
            ON l.l_orderkey = k AND l.l_linenumber = n
       UNION ALL SELECT 'table', count(*), 0, 0 FROM lineitem WHERE l_quantity > 2""",
)
def score_repeat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A scoring and its repetition: nothing is appended twice, rows without a number are told."""
    root = scratch_path(spark, "repeat")
    spec = read_spec(_JOB.format(landing=sf_dir, root=root, training=False, upkeep=False))
    save_model(cell_model(spark, sf_dir).model, f"{root}/model")
    quantity = F.expr("target - if(l_linestatus = 'F', 30, 0)")
    gaps = cells(spark, sf_dir).withColumn("large", F.when(quantity > 2, F.col("large")))
    write_table(gaps, f"{root}/rows")
    told = []
    for name in ("first", "second"):
        scored = run_scoring(
            spark, spec, f"{root}/rows", f"{root}/out", ["l_orderkey", "l_linenumber"], primary_model=f"{root}/model"
        )
        told.append((name, int(scored), scored.known, scored.skipped))
    told.append(("table", read_table(spark, f"{root}/out").count(), 0, 0))
    return small_frame(spark, told, "scoring string, written long, known long, skipped long")


@query(
    "score_full",
    f"""{_CELLS} SELECT l_orderkey, l_linenumber, l_linestatus, large, target,
                       round(guess, 6) AS predicted_delay_days FROM s""",
)
def score_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All input columns and the prediction."""
    scored = score_full(cell_model(spark, sf_dir).model, cells(spark, sf_dir))
    return scored.withColumn(PREDICTION, F.round(PREDICTION, 6))


_JOB = """
pipeline_name: cells
version: "2.1"
bronze_tables:
  - {{name: lines, landing_path: "{landing}", file_format: parquet, file_pattern: lineitem.parquet,
     target_delta_path: "{root}/bronze/lines"}}
silver:
  source_delta_path: "{root}/bronze/lines"
  target_delta_path: "{root}/silver/lines"
  quarantine_delta_path: "{root}/quarantine/lines"
  validation_rules: [{{name: some, expr: "l_quantity > 0"}}]
gold:
  primary_table: "{root}/silver/lines"
  target_delta_path: "{root}/gold/cells"
  select_expressions:
    - l_orderkey
    - l_linenumber
    - l_linestatus
    - "double(l_quantity > 25) AS large"
    - "l_quantity + if(l_linestatus = 'F', 30, 0) AS target"
ml_stage:
  enabled: {training}
  target_column: target
  split_keys: [l_orderkey, l_linenumber]
  categorical_features: [l_linestatus]
  numeric_features: [large]
  hyperparameters: {{maxIter: 1, maxDepth: 2}}
maintenance: {{enabled: {upkeep}}}
mlflow: {{experiment_name: cells, path: "{root}/runs"}}
"""


@query(
    "job_from_yaml",
    f"""{_CELLS}
    SELECT 'param' AS kind, 'pipeline_name' AS key, 'cells' AS text, NULL::DOUBLE AS number
    UNION ALL SELECT 'param', 'version', '2.1', NULL
    UNION ALL SELECT 'param', 'maxDepth', '2', NULL
    UNION ALL SELECT 'param', 'maxIter', '1', NULL
    UNION ALL SELECT 'upkeep', 'silver/lines', 'SUCCESS', NULL
    UNION ALL SELECT 'upkeep', 'gold/cells', 'SUCCESS', NULL
    UNION ALL SELECT 'second run', 'status', 'SKIPPED', NULL
    UNION ALL SELECT 'second run', 'trained', 'no', NULL
    UNION ALL SELECT 'predictions', 'named for the run', 'yes', count(*) FROM r
    UNION ALL SELECT DISTINCT 'cell', l_linestatus || large::INTEGER, NULL, round(guess, 6) FROM s""",
)
def job_from_yaml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A job read from YAML, with default upkeep targets, then scored into its own folder.

    The primary model given for scoring does not exist, so the latest run's model is used. A
    second run of the same job with training and upkeep off skips both.
    """
    root = scratch_path(spark, "yaml")
    spec = read_spec(_JOB.format(landing=sf_dir, root=root, training=True, upkeep=True))
    report = run(spark, spec)
    target = run_gold_scoring(spark, spec, f"{root}/scored", primary_model=f"{root}/no-model")
    named = target.endswith(f"predictions_{report['run_id']}")
    off = read_spec(_JOB.format(landing=sf_dir, root=f"{root}/off", training=False, upkeep=False))
    second = run(spark, off)
    told = [
        *(("upkeep", path.removeprefix(f"{root}/"), status) for path, status in report["maintenance"].items()),
        *(("second run", name, status) for name, status in second["maintenance"].items()),
        ("second run", "trained", "yes" if second["ml_metrics"] else "no"),
    ]
    text = F.col("text")
    params = of_latest_run(
        read_table(spark, f"{root}/runs/runs"), read_table(spark, f"{root}/runs/run_params"), "cells"
    )
    params = params.filter("key IN ('pipeline_name', 'version', 'maxDepth', 'maxIter')")
    scored = spark.read.parquet(target)
    nothing = F.lit(None).cast("double")
    frames = [
        params.select(F.lit("param").alias("kind"), "key", F.col("value").alias("text"), nothing.alias("number")),
        small_frame(spark, told, "kind string, key string, text string").select("kind", "key", text, nothing.alias("number")),
        scored.agg(F.count(F.lit(1)).cast("double").alias("number")).select(
            F.lit("predictions").alias("kind"),
            F.lit("named for the run").alias("key"),
            F.lit("yes" if named else "no").alias("text"),
            "number",
        ),
        scored.select(
            F.lit("cell").alias("kind"),
            F.concat("l_linestatus", F.col("large").cast("int").cast("string")).alias("key"),
            F.lit(None).cast("string").alias("text"),
            F.round(PREDICTION, 6).alias("number"),
        ).distinct(),
    ]
    united = frames[0]
    for frame in frames[1:]:
        united = united.unionByName(frame)
    return united
