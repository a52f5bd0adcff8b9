from __future__ import annotations

import os
import time

import pytest

from terrane.operators.rules import Rule
from terrane.operators.upkeep import compact
from terrane.plans.layers import run_bronze
from terrane.plans.spec import BronzeSpec
from terrane.session import scratch_path
from terrane.sources.landing import read_landing, reader_options, with_lineage
from terrane.sources.tables import (
    SchemaConflict,
    batch_name,
    is_table,
    read_table,
    write_table,
)
from terrane.streaming.ingest import ingest_stream, landing_stream
from terrane.streaming.routing import route_stream


@pytest.fixture()
def landing(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    return folder


def put(folder, name, text, encoding="utf-8"):
    (folder / name).write_text(text, encoding=encoding)


def csv_spec(landing, table, **extra):
    return BronzeSpec(
        landing_path=str(landing),
        target_delta_path=table,
        file_format="csv",
        file_pattern="*.csv",
        options={"header": True, "inferSchema": True},
        **extra,
    )


def test_options_become_text():
    assert reader_options({"header": True, "sep": ";", "n": 3}) == {
        "header": "true",
        "sep": ";",
        "n": "3",
    }


def test_csv_with_mark_and_embedded_comma(spark, landing):
    put(landing, "a.csv", 'name,label\n"x, y",one\nz,two\n', "utf-8-sig")
    put(landing, "b.txt", "not,this\n1,2\n")
    df = read_landing(
        spark, str(landing), file_format="csv", file_pattern="*.csv", options={"header": True}
    )
    assert df.columns == ["name", "label"]
    assert sorted(r.name for r in df.collect()) == ["x, y", "z"]


def test_json_is_the_default_and_lineage_names_the_file(spark, landing):
    put(landing, "a.json", '{"id": 1, "deep": {"x": 2}}\n')
    put(landing, "b.json", '{"id": 2}\n')
    df = with_lineage(read_landing(spark, str(landing)))
    files = {r.id: os.path.basename(r._source_file) for r in df.collect()}
    assert files == {1: "a.json", 2: "b.json"}
    assert df.filter("_ingested_at IS NULL").count() == 0
    assert df.selectExpr("deep.x").filter("x = 2").count() == 1


def test_nothing_landed_writes_nothing(spark, landing):
    table = scratch_path(spark, "bronze")
    assert run_bronze(spark, [csv_spec(landing, table)]) == 0
    assert run_bronze(spark, [csv_spec(landing, table, archive_path=str(landing) + "-old")]) == 0
    assert run_bronze(spark, [csv_spec(landing / "absent", table)]) == 0
    assert run_bronze(spark, []) == 0
    assert not is_table(spark, table)


def test_batches_append_and_gain_columns(spark, landing):
    table = scratch_path(spark, "bronze")
    put(landing, "a.csv", "id,v\n1,2\n")
    assert run_bronze(spark, [csv_spec(landing, table)]) == 1
    put(landing, "a.csv", "id,v,extra\n2,3,x\n")
    assert run_bronze(spark, [csv_spec(landing, table)]) == 1
    got = {r.id: r.extra for r in read_table(spark, table).collect()}
    assert got == {1: None, 2: "x"}
    put(landing, "a.csv", "id,v\n3,text\n")
    with pytest.raises(SchemaConflict):
        run_bronze(spark, [csv_spec(landing, table)])
    spec = csv_spec(landing, table, write_mode="overwrite")
    assert run_bronze(spark, [spec]) == 1
    assert [r.v for r in read_table(spark, table).collect()] == ["text"]


def test_a_sweep_ingests_each_file_once_and_archives_behind_itself(spark, landing, tmp_path):
    table, archive = scratch_path(spark, "bronze"), tmp_path / "archive"
    spec = csv_spec(landing, table, archive_path=str(archive), schema="id int, v int")
    put(landing, "a.csv", "id,v\n1,2\n")
    assert run_bronze(spark, [spec]) == 1
    assert run_bronze(spark, [spec]) == 0
    put(landing, "b.csv", "id,v\n2,3\n3,4\n")
    assert run_bronze(spark, [spec]) == 2
    put(landing, "c.csv", "id,v\n4,5\n")
    assert run_bronze(spark, [spec]) == 1
    assert sorted(r.id for r in read_table(spark, table).collect()) == [1, 2, 3, 4]
    moved = {name for _, _, names in os.walk(archive) for name in names if name.endswith(".csv")}
    assert len(moved) == 3 and not os.listdir(landing)


def test_batch_and_stream_ingest_agree(spark, landing):
    for i in range(5):
        put(landing, f"{i}.csv", "id,v\n" + "".join(f"{i},{j}\n" for j in range(4)))
    batch, stream = scratch_path(spark, "batch"), scratch_path(spark, "stream")
    run_bronze(spark, [csv_spec(landing, batch)])
    written = ingest_stream(
        spark,
        str(landing),
        stream,
        file_format="csv",
        file_pattern="*.csv",
        options={"header": True, "inferSchema": True},
        max_files_per_batch=2,
    )
    assert written == 20
    batch_rows, stream_rows = (
        sorted(map(tuple, read_table(spark, t).select("id", "v").collect()))
        for t in (batch, stream)
    )
    assert batch_rows == stream_rows


def test_a_failed_batch_is_not_written_twice(spark, landing, monkeypatch):
    from terrane.streaming import ingest

    table = scratch_path(spark, "bronze")
    put(landing, "a.csv", "id\n1\n2\n")
    sweep = {
        "file_format": "csv",
        "file_pattern": "*.csv",
        "options": {"header": True},
        "schema": "id int",
    }
    real = ingest.write_table

    def dies_after_writing(*args, **kwargs):
        real(*args, **kwargs)
        raise RuntimeError("lost")

    monkeypatch.setattr(ingest, "write_table", dies_after_writing)
    with pytest.raises(Exception, match="lost"):
        ingest_stream(spark, str(landing), table, **sweep)
    monkeypatch.setattr(ingest, "write_table", real)
    assert ingest_stream(spark, str(landing), table, **sweep) == 2
    assert read_table(spark, table).count() == 2


def test_a_replayed_batch_is_known_after_packing(spark):
    table = scratch_path(spark, "bronze")
    for number in (0, 1):
        write_table(spark.range(3), table, "append", segment=batch_name("s-1", number))
    assert compact(spark, table)
    assert read_table(spark, table).count() == 6
    assert write_table(spark.range(3), table, "append", segment=batch_name("s-1", 1)) == 0
    assert write_table(spark.range(3), table, "append", segment=batch_name("s-1", 2)) == 3
    assert write_table(spark.range(3), table, "append", segment=batch_name("s-2", 0)) == 3
    assert compact(spark, table)
    assert write_table(spark.range(3), table, "append", segment=batch_name("s-1", 1)) == 0
    assert read_table(spark, table).count() == 12


def archived(spark, landing, tmp_path):
    table, archive = scratch_path(spark, "bronze"), tmp_path / "archive"
    return table, archive, csv_spec(landing, table, archive_path=str(archive), schema="id int")


def test_a_name_that_lands_again_is_ingested_again(spark, landing, tmp_path):
    table, archive, spec = archived(spark, landing, tmp_path)
    for day in range(3):
        put(landing, "orders.csv", f"id\n{day}1\n{day}2\n")
        assert run_bronze(spark, [spec]) == 2
        assert not os.listdir(landing)
        assert run_bronze(spark, [spec]) == 0
    assert sorted(r.id for r in read_table(spark, table).collect()) == [1, 2, 11, 12, 21, 22]
    assert len([name for name in os.listdir(archive) if name.endswith("-orders.csv")]) == 3


def test_a_name_overwritten_without_an_archive(spark, landing):
    table = scratch_path(spark, "bronze")
    sweep = {"file_format": "csv", "file_pattern": "*.csv", "options": {"header": True}, "schema": "id int"}
    put(landing, "a[1],{x}.csv", "id\n1\n")
    assert ingest_stream(spark, str(landing), table, **sweep) == 1
    assert ingest_stream(spark, str(landing), table, **sweep) == 0
    put(landing, "a[1],{x}.csv", "id\n2\n3\n")
    assert ingest_stream(spark, str(landing), table, **sweep) == 2
    assert read_table(spark, table).count() == 3


def test_old_files_are_not_dropped(spark, landing, tmp_path):
    table, _, spec = archived(spark, landing, tmp_path)
    put(landing, "new.csv", "id\n1\n")
    assert run_bronze(spark, [spec]) == 1
    put(landing, "old.csv", "id\n2\n")
    long_ago = time.time() - 30 * 86400
    os.utime(landing / "old.csv", (long_ago, long_ago))
    put(landing, "newer.csv", "id\n3\n")
    assert run_bronze(spark, [spec]) == 2
    assert sorted(r.id for r in read_table(spark, table).collect()) == [1, 2, 3]


def test_a_sweep_that_died_is_taken_up(spark, landing, tmp_path, monkeypatch):
    """Before the write, after it, and half-way through the archive."""
    from terrane.streaming import ingest

    table, archive, spec = archived(spark, landing, tmp_path)
    real_write = ingest.write_table

    def die(*args, **kwargs):
        raise RuntimeError("lost")

    def write_and_die(*args, **kwargs):
        real_write(*args, **kwargs)
        die()

    for number, (target, name, replaced) in enumerate(
        [
            (ingest, "write_table", die),
            (ingest, "write_table", write_and_die),
            (ingest.paths, "move_files", die),
        ]
    ):
        put(landing, "a.csv", f"id\n{number}\n")
        with monkeypatch.context() as patched:
            patched.setattr(target, name, replaced)
            with pytest.raises(RuntimeError, match="lost"):
                run_bronze(spark, [spec])
        run_bronze(spark, [spec])
        assert sorted(r.id for r in read_table(spark, table).collect()) == list(range(number + 1))
        assert not os.listdir(landing) and len(os.listdir(archive)) >= number + 1


def test_many_small_files_in_batches(spark, landing, tmp_path, monkeypatch):
    """No call of ours to the store for each file: the driver sees folders and batches only."""
    from terrane.sources import paths

    table, archive, spec = archived(spark, landing, tmp_path)
    spec.max_files_per_batch = 170
    for k in range(400):
        (landing / f"d{k % 3}").mkdir(exist_ok=True)
        put(landing / f"d{k % 3}", f"{k}.csv", f"id\n{k}\n")
    spec.file_pattern = "d*"
    asked = []
    real = paths._locate
    monkeypatch.setattr(paths, "_locate", lambda spark, path: asked.append(path) or real(spark, path))
    assert run_bronze(spark, [spec]) == 400
    assert len(asked) < 100 and not [path for path in asked if path.endswith(".csv")]
    assert sorted(r.id for r in read_table(spark, table).collect()) == list(range(400))
    assert len(os.listdir(archive)) == 400 and not [n for _, _, names in os.walk(landing) for n in names]
    assert read_table(spark, table).select("_source_file").distinct().count() == 400
    assert run_bronze(spark, [spec]) == 0


def test_a_file_that_changes_or_lands_while_a_batch_is_read(spark, landing, monkeypatch):
    from terrane.streaming import ingest

    table = scratch_path(spark, "bronze")
    sweep = {"file_format": "csv", "file_pattern": "*.csv", "options": {"header": True}, "schema": "id int"}
    put(landing, "a.csv", "id\n1\n")
    put(landing, "b c%.csv", "id\n2\n")
    real = ingest.read_files

    def changed(*args):
        put(landing, "a.csv", "id\n11\n12\n")
        put(landing, "late.csv", "id\n3\n")
        return real(*args)

    with monkeypatch.context() as patched:
        patched.setattr(ingest, "read_files", changed)
        assert ingest_stream(spark, str(landing), table, **sweep) == 1
    assert ingest_stream(spark, str(landing), table, **sweep) == 3
    assert ingest_stream(spark, str(landing), table, **sweep) == 0
    assert sorted(r.id for r in read_table(spark, table).collect()) == [2, 3, 11, 12]


def test_numbers_follow_the_order_without_gaps(spark):
    from pyspark.sql import functions as F

    from terrane.operators.numbering import numbered

    rows = spark.range(5000).selectExpr("id", "id % 7 AS k", "1 AS __rows")
    got = numbered(rows, [F.col("k").desc(), F.col("id")], "place").collect()
    expected = sorted(range(5000), key=lambda i: (-(i % 7), i))
    assert [r.id for r in sorted(got, key=lambda r: r.place)] == expected
    assert sorted(r.place for r in got) == list(range(5000))
    assert numbered(rows.limit(0), [F.col("id")], "place").count() == 0


def test_an_overwriting_sweep_holds_the_last_landing(spark, landing, tmp_path):
    table = scratch_path(spark, "bronze")
    spec = csv_spec(
        landing,
        table,
        archive_path=str(tmp_path / "archive"),
        write_mode="overwrite",
        max_files_per_batch=1,
    )
    put(landing, "a.csv", "id\n1\n")
    put(landing, "b.csv", "id\n2\n")
    assert run_bronze(spark, [spec]) == 2
    assert sorted(r.id for r in read_table(spark, table).collect()) == [1, 2]
    put(landing, "c.csv", "id\n3\n")
    assert run_bronze(spark, [spec]) == 1
    assert [r.id for r in read_table(spark, table).collect()] == [3]


def test_malformed_text_in_a_stream_is_quarantined(spark, landing):
    put(landing, "a.json", '{"id": 1, "age": "abc"}\n{"id": 2, "age": "20"}\n{"id": 3}\n')
    root = scratch_path(spark, "routed")
    stream = landing_stream(spark, str(landing), "id int, age string")
    rules = [Rule("adult", "age >= 18")]
    report = route_stream(stream, rules, f"{root}/ok", f"{root}/bad", f"{root}/checkpoint")
    assert (report["clean_count"], report["quarantine_count"]) == (1, 2)
    assert [r.id for r in read_table(spark, f"{root}/ok").collect()] == [2]
    assert sorted(r.id for r in read_table(spark, f"{root}/bad").collect()) == [1, 3]


def test_types_are_those_that_all_values_have(spark, landing):
    from terrane.sources.inference import read_inferred

    put(landing, "a.csv", "id,n,x,day,at,yes,word,none\n1,5,1,2024-01-02,2024-01-02 03:04:05,true,1d,\n", "utf-8-sig")
    put(landing, "b.csv", 'id,n,x,day,at,yes,word,none\n2,5000000000,-2.5e3,2024-1-3,2024-01-03,FALSE,"a, b",\n')
    put(landing, "c.csv", "x,id,more\nNaN,,7\n,4,\n")
    got = read_inferred(spark, str(landing), file_pattern="*.csv", lineage=True)
    kinds = dict(got.dtypes)
    assert kinds.pop("_source_file") == "string"
    assert kinds == {
        "id": "int", "n": "bigint", "x": "double", "day": "date", "at": "timestamp",
        "yes": "boolean", "word": "string", "none": "string", "more": "int",
    }
    rows = {(r.id, r.more): r for r in got.collect()}
    assert rows[(1, None)].word == "1d" and rows[(2, None)].word == "a, b" and rows[(2, None)].n == 5_000_000_000
    assert rows[(2, None)].x == -2500 and str(rows[(2, None)].day) == "2024-01-03" and rows[(2, None)].yes is False
    assert rows[(4, None)].x is None and (None, 7) in rows and len(rows) == 4
    assert read_inferred(spark, str(landing), file_pattern="*.none") is None
