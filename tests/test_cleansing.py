from __future__ import annotations

from pyspark.sql import functions as F

from terrane.operators.cleansing import cleanse, deduplicate, drop_missing, impute
from terrane.operators.sampling import latest_per_key


def plan(df) -> str:
    return df._jdf.queryExecution().toString()


def test_impute_takes_null_and_nan_but_not_other_types(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (1, double('NaN'), 'a'), (2, NULL, NULL), (3, 5.0D, 'c') t(id, v, s)"
    )
    rows = {r.id: (r.v, r.s) for r in impute(df, {"v": -1, "s": "none"}).collect()}
    assert rows == {1: (-1.0, "a"), 2: (-1.0, "none"), 3: (5.0, "c")}
    assert impute(df, None) is df


def test_drop_missing_treats_nan_as_missing(spark):
    df = spark.sql("SELECT * FROM VALUES (1, double('NaN')), (2, NULL), (3, 5.0D) t(id, v)")
    assert [r.id for r in drop_missing(df, ["v"]).collect()] == [3]
    assert drop_missing(df, None).count() == 3


def test_null_keys_are_one_group_and_survivor_is_reproducible(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (NULL, 2), (NULL, 1), ('k', 9), ('k', 3), ('m', 4) t(k, v)"
    )
    for parts in (1, 3, 7):
        kept = deduplicate(df.repartition(parts), ["k"]).collect()
        assert {(r.k, r.v) for r in kept} == {(None, 1), ("k", 3), ("m", 4)}


def test_latest_ingest_survives(spark):
    df = spark.sql(
        "SELECT * FROM VALUES ('k', 1, timestamp'2024-01-01'), ('k', 9, timestamp'2024-02-01') "
        "t(k, v, _ingested_at)"
    )
    assert deduplicate(df, ["k"]).first().v == 9
    assert deduplicate(df, ["k"], [F.col("v").asc()]).first().v == 1


def test_maps_and_structs_can_be_deduplicated(spark):
    df = spark.sql(
        "SELECT 1 AS k, map('a', 2) AS m, named_struct('x', 1) AS s "
        "UNION ALL SELECT 1, map('a', 1), named_struct('x', 1)"
    )
    assert deduplicate(df, ["k"]).first().m == {"a": 1}
    only_keys = df.select("k")
    assert deduplicate(only_keys, ["k"]).count() == 1


def test_hot_key_is_cut_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("if(id % 3 = 0, 0, id) AS k", "id AS v")
    for frame in (
        deduplicate(df, ["k"]),
        latest_per_key(df, ["k"], "v >= 0", [F.col("v").desc()]),
    ):
        physical = plan(frame).split("== Physical Plan ==")[1]
        before = physical[physical.index("Exchange hashpartitioning") :]
        assert "WindowGroupLimit" in before and "Partial" in before


def test_order_is_impute_dedup_drop(spark):
    df = spark.sql("SELECT * FROM VALUES ('k', NULL), ('k', 5), (NULL, 1) t(k, v)")
    kept = cleanse(df, {"v": 0}, ["k"], ["k"]).collect()
    assert [(r.k, r.v) for r in kept] == [("k", 0)]
