from __future__ import annotations

import pytest

from terrane.session import scratch_path
from terrane.sources import paths
from terrane.sources.tables import (
    SchemaConflict,
    is_table,
    live_segments,
    read_table,
    stage,
    table_bytes,
    write_table,
)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture()
def table(spark):
    return scratch_path(spark, "table")


def test_append_overwrite_and_counts(spark, table):
    assert not is_table(spark, table)
    assert write_table(spark.range(3), table, "append") == 3
    assert write_table(spark.range(2), table, "append") == 2
    assert read_table(spark, table).count() == 5
    assert write_table(read_table(spark, table).filter("id = 0"), table, "overwrite") == 2
    assert rows(read_table(spark, table)) == [(0,), (0,)]
    assert write_table(spark.range(1), table, "append") == 1
    assert read_table(spark, table).count() == 3
    assert write_table(spark.range(5).filter("id > 9"), table, "overwrite") == 0
    assert rows(read_table(spark, table)) == []
    with pytest.raises(ValueError, match="write mode"):
        write_table(spark.range(1), table, "ignore")


def test_added_columns_merge_top_level_and_nested(spark, table):
    write_table(spark.sql("SELECT 1 AS id, named_struct('a', 1) AS s"), table, "append")
    write_table(
        spark.sql("SELECT 2 AS id, named_struct('a', 2, 'b', 'x') AS s, 'new' AS extra"),
        table,
        "append",
    )
    write_table(spark.sql("SELECT 3 AS id"), table, "append")
    got = read_table(spark, table).selectExpr("id", "s.a", "s.b", "extra")
    assert sorted(map(str, map(tuple, got.collect()))) == [
        "(1, 1, None, None)",
        "(2, 2, 'x', 'new')",
        "(3, None, None, None)",
    ]


@pytest.mark.parametrize(
    "later", ["SELECT 'x' AS id", "SELECT 2L AS ID", "SELECT 2 AS id, named_struct('a', 'x') AS s"]
)
def test_changed_types_are_refused(spark, table, later):
    write_table(spark.sql("SELECT 1 AS id, named_struct('a', 1) AS s"), table, "append")
    with pytest.raises(SchemaConflict, match="in the table but"):
        write_table(spark.sql(later), table, "append")
    assert read_table(spark, table).count() == 1


def test_overwrite_may_change_types(spark, table):
    write_table(spark.sql("SELECT 1 AS id"), table)
    write_table(spark.sql("SELECT 'x' AS id, 2 AS b"), table)
    assert read_table(spark, table).dtypes == [("id", "string"), ("b", "int")]


def test_unfinished_writes_stay_invisible(spark, table):
    write_table(spark.range(3), table)
    spark.range(9).write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false"
    ).parquet(f"{table}/v=1/append-dead")
    spark.range(9).write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false"
    ).parquet(f"{table}/v=2/base")
    assert len(live_segments(spark, table)) == 1
    assert read_table(spark, table).count() == 3
    write_table(spark.range(4), table)
    assert live_segments(spark, table)[0].endswith("v=3/base")
    assert read_table(spark, table).count() == 4


def test_a_repeated_segment_replaces_itself(spark, table):
    for _ in range(2):
        write_table(spark.range(3), table, "append", segment="batch-7")
    assert read_table(spark, table).count() == 3


def test_repeated_names_are_refused_before_anything_is_written(spark, table):
    with pytest.raises(ValueError, match="more than once"):
        write_table(spark.sql("SELECT 1 AS a, 2 AS A"), table)
    assert not paths.exists(spark, table)


def test_plain_parquet_and_catalog_tables_are_readable(spark, table):
    spark.range(4).write.parquet(table)
    assert is_table(spark, table) and read_table(spark, table).count() == 4
    with pytest.raises(ValueError, match="not a versioned table"):
        write_table(spark.range(1), table, "append")
    spark.range(2).createOrReplaceTempView("named_rows")
    assert is_table(spark, "named_rows") and read_table(spark, "named_rows").count() == 2
    assert table_bytes(spark, "named_rows") == 16 and table_bytes(spark, table) > 0
    spark.createDataFrame(spark.sparkContext.parallelize([(1,)]), "a int").createOrReplaceTempView(
        "sizeless"
    )
    assert table_bytes(spark, "sizeless") == 0


def test_versions_without_a_schema_file_are_merged_by_spark(spark, table):
    spark.sql("SELECT 1 AS a").write.parquet(f"{table}/v=1/one")
    spark.sql("SELECT 2 AS a, 3 AS b").write.parquet(f"{table}/v=1/two")
    assert rows(read_table(spark, table).selectExpr("a", "coalesce(b, 0)")) == [(1, 0), (2, 3)]


def test_staged_rows_are_read_from_the_shared_folder(spark):
    staged, path = stage(spark.range(5), "t")
    assert staged.count() == 5 and paths.exists(spark, path)
    assert "terrane" in staged.inputFiles()[0]
    paths.remove(spark, path)
    assert not paths.exists(spark, path)
