from __future__ import annotations

import os
import json
import threading

import pytest

from terrane import load_spec, run, session
from terrane.operators import runlog, upkeep
from terrane.operators.runlog import latest_run, latest_run_id, of_latest_run
from terrane.operators.upkeep import (
    compact,
    maintain,
    small_segments,
    remove_stale,
    stale_files,
    stale_segments,
)
from terrane.plans.layers import run_gold_scoring, run_scoring, run_training
from terrane.plans.spec import parse_spec
from terrane.session import layout_for, scratch_path, shared_root
from terrane.sources import paths
from terrane.sources.tables import history, live_segments, pack_segments, read_table, write_table

SPEC = """
pipeline_name: people
version: "1.0"
bronze:
  landing_path: {root}/landing
  file_pattern: "*.json"
  target_delta_path: {root}/bronze/people
silver:
  source_delta_path: {root}/bronze/people
  target_delta_path: {root}/silver/people
  quarantine_delta_path: {root}/quarantine/people
  drop_duplicates: [person]
  validation_rules:
    - name: grown
      expr: "age >= 18 AND age <= 120"
    - name: known
      expr: "status IS NOT NULL AND status IN ('ACTIVE', 'PENDING')"
gold:
  primary_table: {root}/silver/people
  target_delta_path: {root}/gold/people
  joins:
    - table: {root}/silver/people
      on: [person]
      type: left_semi
  select_expressions:
    - person
    - status
    - double(age) AS age
    - double(age * 2) AS actual_delay_days
ml_stage:
  categorical_features: [status]
  numeric_features: [age]
  hyperparameters: {{maxIter: 1, maxDepth: 2}}
  tuning: {{enabled: true, num_folds: 2, param_grid: {{maxDepth: [1, 2]}}}}
mlflow:
  experiment_name: people_runs
unknown_key: ignored
"""


@pytest.fixture()
def landed(spark, tmp_path):
    root = tmp_path / "lake"
    (root / "landing").mkdir(parents=True)
    people = [
        {"person": i, "age": 10 + i % 60, "status": ["ACTIVE", "PENDING", "GONE"][i % 3]}
        for i in range(200)
    ]
    people += people[:20]
    text = "\n".join(json.dumps(p) for p in people)
    (root / "landing" / "a.json").write_text(text)
    (tmp_path / "job.yaml").write_text(SPEC.format(root=root))
    return root, str(tmp_path / "job.yaml")


def test_whole_job(spark, landed):
    root, path = landed
    touched = (
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum",
        "spark.sql.files.maxPartitionBytes",
        "spark.sql.session.timeZone",
        "spark.sql.ansi.enabled",
    )
    before = [spark.conf.get(key, None) for key in touched]
    report = run(spark, path)
    assert [spark.conf.get(key, None) for key in touched] == before
    clean = sum(1 for i in range(200) if 18 <= 10 + i % 60 <= 120 and i % 3 < 2)
    assert report["bronze_record_count"] == 220
    assert report["silver_record_count"] == report["gold_record_count"] == clean
    assert report["quarantine_record_count"] == 200 - clean
    assert report["dropped_record_count"] == 20
    assert report["dq_pass_rate_pct"] == round(clean / 2, 2)
    assert set(report["ml_metrics"]) == {"rmse", "mae", "r2"}
    tables = [f"{root}/silver/people", f"{root}/gold/people"]
    assert report["maintenance"] == dict.fromkeys(tables, "SUCCESS")

    runs, metrics = (read_table(spark, f"{root}/runs/{t}") for t in ("runs", "run_metrics"))
    assert [r.status for r in runs.orderBy("logged_at").collect()] == ["RUNNING", "FINISHED"]
    logged = {r.key: r.value for r in of_latest_run(runs, metrics, "people_runs").collect()}
    assert logged["gold_record_count"] == clean
    assert {"test_rmse", "feature_importance_age", "dq_quarantine_ratio_pct"} <= set(logged)
    params = {r.key: r.value for r in read_table(spark, f"{root}/runs/run_params").collect()}
    assert params["pipeline_name"] == "people" and params["landing_path"] == f"{root}/landing"
    assert params["maxIter"] == "1" and params["best_maxDepth"] in ("1", "2")
    assert latest_run_id(spark, f"{root}/runs", "people_runs") == report["run_id"]
    assert latest_run(runs, "people_runs", finished=False).count() == 1

    spec = load_spec(path)
    gold, out = f"{root}/gold/people", f"{root}/predictions"
    for again in (False, True):
        assert run_scoring(spark, spec, gold, out, ["person"], again=again) == clean
    assert run_scoring(spark, spec, gold, out, ["person"]) == 0
    assert read_table(spark, out).count() == 2 * clean
    assert {r._model_run_id for r in read_table(spark, out).collect()} == {report["run_id"]}
    target = run_gold_scoring(spark, spec, f"{root}/scored", primary_model="/tmp/no-such-model")
    assert target.endswith(f"predictions_{report['run_id']}")
    assert spark.read.parquet(target).columns == [
        "person",
        "status",
        "age",
        "actual_delay_days",
        "predicted_delay_days",
    ]


def test_a_failed_run_keeps_what_it_measured(spark, landed):
    root, path = landed
    spec = load_spec(path)
    spec.gold.select_expressions = ["no_such_column"]
    with pytest.raises(Exception):
        run(spark, spec)
    runs = read_table(spark, f"{root}/runs/runs").orderBy("logged_at")
    assert [r.status for r in runs.collect()] == ["RUNNING", "FAILED"]
    keys = {r.key for r in read_table(spark, f"{root}/runs/run_metrics").collect()}
    assert "silver_record_count" in keys and "gold_record_count" not in keys
    with pytest.raises(RuntimeError, match="no finished run"):
        latest_run_id(spark, f"{root}/runs", "people_runs")
    with pytest.raises(ValueError, match="no run table"):
        latest_run_id(spark, f"{root}/elsewhere", "people_runs")


BASE = {
    "pipeline_name": "p",
    "version": "1",
    "silver": {"source_delta_path": "a/b", "target_delta_path": "a/c"},
    "gold": {"source_delta_path": "a/c", "target_delta_path": "lake/gold/g"},
    "mlflow": {"experiment_name": "e"},
}


def test_spec_defaults():
    spec = parse_spec(BASE)
    assert spec.landings == [] and spec.maintenance.enabled and spec.ml_stage is None
    assert spec.maintenance.retention_hours == 168 and spec.gold.source == "a/c"
    assert spec.mlflow.run_name == "declarative_run" and spec.runs_path == "lake/runs"
    many = {**BASE, "bronze": {"landing_path": "l", "target_delta_path": "t"}}
    assert [b.file_format for b in parse_spec(many).landings] == ["json"]
    many["bronze_tables"] = [{"landing_path": "m", "target_delta_path": "t"}]
    assert [b.landing_path for b in parse_spec(many).landings] == ["m"]


def test_unquoted_on_is_understood():
    gold = {**BASE["gold"], "joins": [{"table": "x/y", True: ["k"]}]}
    join = parse_spec({**BASE, "gold": gold}).gold.joins[0]
    assert join.on == ["k"] and join.type == "left"


@pytest.mark.parametrize(
    "change, message",
    [
        ({"silver": {"source_delta_path": "a"}}, "spec.silver.target_delta_path is required"),
        ({"version": 2}, "spec.version must be str"),
        ({"bronze_tables": {"a": 1}}, "spec.bronze_tables must be a list"),
        ({"gold": "x"}, "spec.gold must be a mapping"),
        ({"ml_stage": {"random_seed": True}}, "random_seed must be int"),
        (
            {"gold": {"target_delta_path": "x", "joins": [{"table": "t"}]}},
            r"joins\[0\].on is required",
        ),
    ],
)
def test_spec_errors_name_the_place(change, message):
    with pytest.raises(ValueError, match=message):
        parse_spec({**BASE, **change})


def test_compaction_keeps_rows_and_skips_packed_tables(spark):
    table = scratch_path(spark, "compact")
    write_table(spark.range(0, 500, 1, 6), table, "append")
    write_table(spark.range(0, 500, 1, 6).selectExpr("id", "id AS more"), table, "append")
    before = sorted(map(str, read_table(spark, table).collect()))
    assert compact(spark, table)
    assert sorted(map(str, read_table(spark, table).collect())) == before
    assert len(read_table(spark, table).inputFiles()) == 1
    assert not small_segments(spark, table, 1 << 28) and not compact(spark, table)
    plan = spark.conf.get("spark.sql.files.maxPartitionBytes")
    assert plan != str(256 * 1024 * 1024)


def test_only_small_files_are_packed(spark):
    table = scratch_path(spark, "mixed")
    write_table(spark.range(0, 200_000, 1, 3), table, "append")
    before = {name: os.stat(name).st_mtime_ns for name in files_of(spark, table)}
    target = min(os.stat(name).st_size for name in before)
    for n in range(8):
        write_table(spark.range(n, n + 1, 1, 1), table, "append")
    rows = sorted(r.id for r in read_table(spark, table).collect())
    assert compact(spark, table, target) and not compact(spark, table, target)
    after = files_of(spark, table)
    assert len(after) == 4 and set(before) < set(after)
    assert all(os.stat(name).st_mtime_ns == changed for name, changed in before.items())
    assert sorted(r.id for r in read_table(spark, table).collect()) == rows
    assert stale_files(spark, table, 168).count() == 0
    assert remove_stale(spark, table, 0) == 8
    assert sorted(r.id for r in read_table(spark, table).collect()) == rows


def files_of(spark, table):
    return [name.removeprefix("file://") for name in read_table(spark, table).inputFiles()]


def test_appends_during_packing_and_overwrites_are_kept(spark, monkeypatch):
    from terrane.sources import tables

    table = scratch_path(spark, "race")
    for n in range(4):
        write_table(spark.range(n, n + 1), table, "append")
    real = tables.write_counted

    def while_writing(action):
        def write(df, path):
            monkeypatch.setattr(tables, "write_counted", real)
            action()
            return real(df, path)

        monkeypatch.setattr(tables, "write_counted", write)

    # An append becomes visible while files are packed, and the other way round.
    while_writing(lambda: write_table(spark.range(10, 12), table, "append"))
    assert compact(spark, table)
    assert sorted(r.id for r in read_table(spark, table).collect()) == [0, 1, 2, 3, 10, 11]
    while_writing(lambda: compact(spark, table))
    assert write_table(spark.range(20, 21), table, "append") == 1
    assert sorted(r.id for r in read_table(spark, table).collect()) == [0, 1, 2, 3, 10, 11, 20]
    # An overwrite is published while rows with a further column are appended.
    while_writing(lambda: write_table(spark.range(30, 31), table))
    assert write_table(spark.sql("SELECT 40L AS id, 'x' AS more"), table, "append") == 1
    assert sorted(map(tuple, read_table(spark, table).collect())) == [(30, None), (40, "x")]


def test_overlapping_packings_count_once(spark, monkeypatch):
    """Two at a time, on the same segments and on more; then removal, and a late third."""
    table = scratch_path(spark, "twice")
    for n in range(8):
        write_table(spark.range(n * 125, n * 125 + 125), table, "append")
    live = live_segments(spark, table)
    for _ in range(2):
        assert pack_segments(spark, table, live) == 1000
        assert read_table(spark, table).count() == 1000
    write_table(spark.range(1000, 1100), table, "append")
    # A packing that read the first four is overtaken by one of all, and by the removal.
    from terrane.sources import tables

    real, late = tables.write_counted, []

    def overtaken(df, path):
        monkeypatch.setattr(tables, "write_counted", real)
        compact(spark, table)
        assert read_table(spark, table).distinct().count() == read_table(spark, table).count() == 1100
        remove_stale(spark, table, 0)
        assert read_table(spark, table).count() == 1100
        late.append(path)
        return spark.range(7).write.parquet(path)  # whatever it holds, it comes too late

    monkeypatch.setattr(tables, "write_counted", overtaken)
    pack_segments(spark, table, live_segments(spark, table)[-2:])
    assert late and sorted(r.id for r in read_table(spark, table).collect()) == list(range(1100))
    assert remove_stale(spark, table, 0) == 1 and remove_stale(spark, table, 0) == 0
    assert sorted(r.id for r in read_table(spark, table).collect()) == list(range(1100))


def test_a_packing_of_packings(spark):
    table = scratch_path(spark, "nested")
    for n in range(4):
        write_table(spark.range(n, n + 1), table, "append")
    one, two, three, four = live_segments(spark, table)
    pack_segments(spark, table, [one, two])
    packed = [s for s in live_segments(spark, table) if "packed-" in s]
    pack_segments(spark, table, [*packed, three])
    pack_segments(spark, table, [two, four])  # overlaps the first: does not count
    for _ in range(3):
        assert sorted(r.id for r in read_table(spark, table).collect()) == [0, 1, 2, 3]
        remove_stale(spark, table, 0)
    assert len(live_segments(spark, table)) == 2


def test_run_tables_tidied_by_two_jobs(spark, monkeypatch):
    monkeypatch.setattr(runlog, "_MAX_SEGMENTS", 2)
    log = runlog.RunLog(spark, scratch_path(spark, "runs"), "e")
    for status in ("RUNNING", "FAILED", "RUNNING", "FINISHED"):
        log.status(status)
    pack_segments(spark, log.table("runs"), live_segments(spark, log.table("runs")))
    log.tidy()
    log.status("RUNNING")
    log.status("FINISHED")
    log.tidy()
    assert read_table(spark, log.table("runs")).count() == 6


def test_stale_files_wait_for_the_retention(spark):
    table = scratch_path(spark, "stale")
    for n in (3, 2, 1):
        write_table(spark.range(n), table)
    spark.range(9).write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false"
    ).parquet(f"{table}/v=4/base")
    assert stale_files(spark, table, 168).count() == 0
    later = paths.modified_at(spark, table) + 169 * 3600
    assert len(stale_segments(spark, table, 168, at=later)) == 3
    names = {r.path.split("/")[-3] for r in stale_files(spark, table, 0).collect()}
    assert names == {"v=1", "v=2", "v=4"}
    with pytest.raises(ValueError, match="force"):
        remove_stale(spark, table, 1)
    assert remove_stale(spark, table, 1, force=True) == 0
    assert remove_stale(spark, table, 0) == 3
    assert [v for v, _ in history(spark, table)] == [3]
    assert read_table(spark, table).count() == 1


def test_maintenance_reports_per_table(spark):
    root = scratch_path(spark, "many")
    write_table(spark.range(3), f"{root}/good")
    write_table(spark.range(3).repartition(3), f"{root}/bad")
    broken = live_segments(spark, f"{root}/bad")[0]
    for file in read_table(spark, f"{root}/bad").inputFiles():
        with open(file.removeprefix("file://"), "wb") as out:
            out.write(b"not parquet")
    assert broken
    status = maintain(spark, [f"{root}/good", f"{root}/bad", f"{root}/none"], 0)
    got = {r.table: (r.status, bool(r.message)) for r in status.collect()}
    assert got == {f"{root}/good": ("SUCCESS", False), f"{root}/bad": ("FAILED", True)}
    off = maintain(spark, [f"{root}/good"], enabled=False).collect()
    assert [(r.table, r.status) for r in off] == [(None, "SKIPPED")]


def test_tables_are_packed_side_by_side(spark, monkeypatch):
    """Each packing waits for the other one; the session's settings are its own again after it."""
    tables = [scratch_path(spark, name) for name in ("left", "right")]
    for table in tables:
        write_table(spark.range(40).repartition(4), table)
    together, packed = threading.Barrier(2, timeout=60), []

    def pack(session, table, segments):
        together.wait()
        packed.append(spark.conf.get("spark.sql.files.minPartitionNum"))
        return pack_segments(session, table, segments)

    monkeypatch.setattr(upkeep, "pack_segments", pack)
    keys = [f"spark.sql.files.{name}" for name in ("maxPartitionBytes", "openCostInBytes", "minPartitionNum")]
    before = [spark.conf.get(key, None) for key in keys]
    status = maintain(spark, [*tables, f"{tables[0]}/"], 0).collect()
    assert [(r.table, r.status) for r in status] == [(t, "SUCCESS") for t in [*tables, f"{tables[0]}/"]]
    assert packed == ["1", "1"] and [spark.conf.get(key, None) for key in keys] == before
    for table in tables:
        found = read_table(spark, table)
        assert len(found.inputFiles()) == 1 and sorted(r.id for r in found.collect()) == [*range(40)]


def test_layout_follows_the_input(spark):
    partitions = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    piece = "spark.sql.files.maxPartitionBytes"
    small, middle, large = (layout_for(spark, size) for size in (1000, 2**40, 100 * 2**40))
    assert small[partitions] == spark.conf.get("spark.sql.shuffle.partitions")
    assert middle[partitions] == "8192" and large[partitions] == "50000"
    assert int(small[piece]) == int(middle[piece]) == 128 * 1024 * 1024
    assert int(large[piece]) == -(-100 * 2**40 // 100_000)


def test_quoted_values_are_read():
    stage = parse_spec({**BASE, "ml_stage": {"enabled": "false", "random_seed": "7"}}).ml_stage
    assert stage.enabled is False and stage.random_seed == 7


def test_upkeep_may_be_off(spark):
    from terrane.plans.job import _upkeep

    assert _upkeep(spark, parse_spec({**BASE, "maintenance": None})) == {"status": "SKIPPED"}


def test_training_may_be_off(spark):
    off = parse_spec({**BASE, "ml_stage": {"enabled": False}}).ml_stage
    assert run_training(spark, off, "nowhere/x") is None
    assert run_training(spark, None, "nowhere/x") is None


def test_run_tables_are_merged_now_and_then(spark, monkeypatch):
    monkeypatch.setattr(runlog, "_MAX_SEGMENTS", 2)
    log = runlog.RunLog(spark, scratch_path(spark, "runs"), "e")
    for status in ("RUNNING", "FAILED", "RUNNING", "FINISHED"):
        log.status(status)
    log.tidy()
    assert len(read_table(spark, log.table("runs")).inputFiles()) == 1
    assert read_table(spark, log.table("runs")).count() == 4


def test_scratch_needs_a_shared_folder_on_a_cluster():
    class Conf:
        def __init__(self, value):
            self.value = value

        def get(self, key, default=None):
            return self.value or default

    class Context:
        master = "yarn"

    class Session:
        sparkContext = Context()

        def __init__(self, folder):
            self.conf = Conf(folder)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_root(Session(None))
    assert shared_root(Session("hdfs:///shared/")) == "hdfs:///shared"


def test_clear_scratch(spark, monkeypatch):
    monkeypatch.setattr(session, "_scratch_root", lambda s: f"{shared_root(s)}/terrane/one-test")
    path = scratch_path(spark, "x")
    spark.range(1).write.parquet(path)
    assert paths.exists(spark, path)
    session.clear_scratch(spark)
    assert not paths.exists(spark, path)
