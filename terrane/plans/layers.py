"""The layer jobs: bronze, silver, gold, training, scoring."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from terrane.functions.columns import MODEL_RUN_ID
from terrane.operators import rules as quality
from terrane.operators.cleansing import cleanse, unseen
from terrane.operators.joins import join_chain
from terrane.operators.learning import Fit, train
from terrane.operators.rules import Rule
from terrane.operators.runlog import latest_run_id
from terrane.operators.scoring import load_model, score_batch, score_full
from terrane.operators.shaping import shape
from terrane.plans.spec import BronzeSpec, GoldSpec, JobSpec, LearningSpec, SilverSpec
from terrane.session import layout_for, settings
from terrane.sources import paths
from terrane.sources.landing import read_landing, with_lineage
from terrane.sources.tables import is_table, read_table, stage, table_bytes, write_table
from terrane.streaming.ingest import ingest_stream

_log = logging.getLogger(__name__)


def run_bronze(spark: SparkSession, landings: Sequence[BronzeSpec]) -> int:
    """Ingest each landing in listed order; returns all rows written."""
    return sum(ingest(spark, landing) for landing in landings)


def ingest(spark: SparkSession, spec: BronzeSpec) -> int:
    """One landing. With an archive the sweep is incremental; nothing landed writes nothing."""
    common = {
        "file_format": spec.file_format,
        "file_pattern": spec.file_pattern,
        "options": spec.options,
        "schema": spec.schema,
    }
    if spec.archive_path:
        return ingest_stream(
            spark,
            spec.landing_path,
            spec.target_delta_path,
            archive_path=spec.archive_path,
            max_files_per_batch=spec.max_files_per_batch,
            write_mode=spec.write_mode,
            **common,
        )
    landed = read_landing(spark, spec.landing_path, **common)
    if landed is None:
        _log.warning("nothing landed under %s/%s", spec.landing_path, spec.file_pattern)
        return 0
    with settings(spark, layout_for(spark, paths.total_bytes(spark, spec.landing_path))):
        return write_table(with_lineage(landed), spec.target_delta_path, spec.write_mode)


def route(
    df: DataFrame,
    rules: Sequence[Rule],
    clean_table: str,
    quarantine_table: str,
    mode: str,
    *,
    staged: bool = False,
    segment: str | None = None,
) -> tuple[int, int]:
    """Write passing rows and, if there are any, failing rows; returns both counts.

    Counts come from the writes themselves. With ``staged``, and always when the rules
    depend on the clock or on chance, rows are tagged once into a staged copy that both
    writes read: right for rows that took a shuffle or text parsing to make. Otherwise the
    source is read again for the (usually small) failing part, only if something failed.
    """
    if staged or not quality.repeatable(df, rules):
        tagged, path = stage(quality.tag_failures(df, rules), "silver")
        try:
            clean = write_table(
                tagged.filter(quality.passed()).drop(quality.FAILED_RULES),
                clean_table,
                mode,
                segment=segment,
            )
            failed = tagged.filter(~quality.passed())
            bad = tagged.count() - clean  # a footer-only count of the staged copy
            if bad:
                write_table(quality.stamp(failed), quarantine_table, "append", segment=segment)
        finally:
            paths.remove(df.sparkSession, path)
        return clean, bad
    total = Observation()
    watched = df.observe(total, F.count(F.lit(1)).alias("rows"))
    clean = write_table(quality.valid_rows(watched, rules), clean_table, mode, segment=segment)
    bad = total.get["rows"] - clean
    if bad:
        failed = quality.quarantined_rows(df, rules)
        write_table(failed, quarantine_table, "append", segment=segment)
    return clean, bad


def run_silver(spark: SparkSession, spec: SilverSpec) -> dict[str, float]:
    """Cleanse, validate, quarantine; returns the quality metrics.

    They cover the rows that reached the rules; ``dropped_count`` says how many did not,
    being duplicates or incomplete.
    """
    rules = [r.rule() for r in spec.validation_rules or ()]
    if rules and not spec.quarantine_delta_path:
        if spec.on_invalid != "ignore":
            raise ValueError(
                "validation_rules need a quarantine_delta_path, or on_invalid: ignore"
            )
        rules = []
    with settings(spark, layout_for(spark, table_bytes(spark, spec.source_delta_path))):
        source = read_table(spark, spec.source_delta_path)
        df = cleanse(source, spec.fill_na, spec.drop_duplicates, spec.drop_na_cols)
        if spec.unique_across_batches and spec.drop_duplicates and spec.write_mode == "append":
            if is_table(spark, spec.target_delta_path):
                df = unseen(df, read_table(spark, spec.target_delta_path), spec.drop_duplicates)
        if rules:
            counts = route(
                df,
                rules,
                spec.target_delta_path,
                spec.quarantine_delta_path,
                spec.write_mode,
                staged=bool(spec.drop_duplicates),
            )
        else:
            counts = write_table(df, spec.target_delta_path, spec.write_mode), 0
        may_drop = spec.drop_duplicates or spec.drop_na_cols
        landed = source.count() if may_drop else sum(counts)  # counted from footers alone
    return {**quality.quality_report(*counts), "dropped_count": landed - sum(counts)}


def gold_frame(spark: SparkSession, spec: GoldSpec) -> DataFrame:
    """The gold plan: join chain, then projection or group-by."""
    joins = [(read_table(spark, j.table), j.on, j.type) for j in spec.joins or ()]
    joined = join_chain(read_table(spark, spec.source), joins, skew=spec.skew)
    return shape(joined, spec.select_expressions, spec.group_by, spec.aggregations)


def run_gold(spark: SparkSession, spec: GoldSpec) -> int:
    inputs = [spec.source, *(j.table for j in spec.joins or ())]
    size = sum(table_bytes(spark, table) for table in inputs)
    with settings(spark, layout_for(spark, size)):
        return write_table(gold_frame(spark, spec), spec.target_delta_path, spec.write_mode)


def run_training(spark: SparkSession, spec: LearningSpec | None, gold_table: str) -> Fit | None:
    """None when the stage is absent or switched off."""
    if spec is None or not spec.enabled:
        return None
    with settings(spark, layout_for(spark, table_bytes(spark, gold_table))):
        return train(
            read_table(spark, gold_table),
            spec.target_column,
            spec.categorical_features,
            spec.numeric_features,
            split_keys=spec.split_keys,
            train_share=spec.train_test_split_ratio,
            seed=spec.random_seed,
            hyperparameters=spec.hyperparameters,
            tuning=spec.tuning,
        )


class Scored(int):
    """Rows written, with how many were `known` from an earlier scoring by the same run and how
    many were `skipped` as a number they need is missing."""

    known: int
    skipped: int


def run_scoring(
    spark: SparkSession,
    spec: JobSpec,
    source_table: str,
    output_table: str,
    id_columns: Sequence[str],
    *,
    run_id: str | None = None,
    primary_model: str | None = None,
    again: bool = False,
) -> Scored:
    """Append ids, prediction and audit columns for every row that can be scored.

    Rows whose ids this run's model has scored into the table before are left out, unless they
    are wanted ``again``, so a repeated scoring adds nothing; another model's run scores them.
    """
    model, credited = _model(spark, spec, run_id, primary_model)
    with settings(spark, layout_for(spark, table_bytes(spark, source_table))):
        source = read_table(spark, source_table)
        rows = source
        if not again and is_table(spark, output_table):
            done = read_table(spark, output_table)
            if {MODEL_RUN_ID, *id_columns} <= set(done.columns):
                rows = unseen(rows, done.filter(F.col(MODEL_RUN_ID) == credited), id_columns)
        seen = Observation()
        watched = rows.observe(seen, F.count(F.lit(1)).alias("rows"))
        scored = score_batch(model, watched, id_columns, credited)
        report = Scored(write_table(scored, output_table, "append"))
        report.skipped = seen.get["rows"] - report
        report.known = source.count() - seen.get["rows"]  # counted from footers alone
    return report


def run_gold_scoring(
    spark: SparkSession, spec: JobSpec, output_root: str, *, primary_model: str | None = None
) -> str:
    """Score the whole gold table into ``<output_root>/predictions_<run_id>`` as Parquet."""
    model, credited = _model(spark, spec, None, primary_model)
    target = f"{output_root.rstrip('/')}/predictions_{credited}"
    gold = spec.gold.target_delta_path
    with settings(spark, layout_for(spark, table_bytes(spark, gold))):
        score_full(model, read_table(spark, gold)).write.mode("overwrite").parquet(target)
    return target


def _model(spark: SparkSession, spec: JobSpec, run_id: str | None, primary: str | None):
    root = spec.runs_path
    return load_model(
        spark,
        primary,
        run_id,
        lambda found: f"{root}/models/{found}",
        lambda: latest_run_id(spark, root, spec.mlflow.experiment_name),
    )

