from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from terrane.operators import joins
from terrane.operators.joins import has_hot_key, heavy_keys, join_chain, join_tables, join_type
from terrane.operators.shaping import aggregate, shape
from terrane.plans.layers import gold_frame, run_gold
from terrane.plans.spec import GoldSpec, JoinSpec
from terrane.session import scratch_path, settings
from terrane.sources.tables import read_table, write_table


@pytest.fixture()
def sides(spark):
    """A third of each side on key 0, NULL keys, keys on one side only, repeats."""
    left = spark.range(60).selectExpr(
        "CASE WHEN id < 20 THEN 0 WHEN id < 25 THEN NULL ELSE id END AS k",
        "id % 2 AS j",
        "id AS a",
        "'x' AS shared",
    )
    right = spark.range(45).selectExpr(
        "CASE WHEN id < 15 THEN 0 WHEN id < 18 THEN NULL ELSE id * 2 END AS k",
        "id % 2 AS j",
        "id AS b",
        "'y' AS shared",
    )
    return left, right


def bag(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("how", ["left", "right", "full", "outer", "left_outer"])
@pytest.mark.parametrize("keys", [["k"], ["k", "j"]])
def test_hot_form_gives_the_plain_result(sides, how, keys):
    left, right = sides
    plain = join_tables(left, right, keys, how, skew="off")
    hot = join_tables(left, right, keys, how, skew="on")
    assert hot.columns == plain.columns
    assert [f.dataType for f in hot.schema] == [f.dataType for f in plain.schema]
    assert bag(hot) == bag(plain)
    upper = join_tables(left, right, [k.upper() for k in keys], how, skew="on")
    assert bag(upper) == bag(plain)


def test_key_types_may_differ(spark):
    left = spark.sql("SELECT * FROM VALUES (1, 'a'), (2, 'b') t(k, a)")
    right = spark.sql("SELECT * FROM VALUES (2L, 'c'), (3L, 'd') t(k, b)")
    for how in ("left", "right", "full"):
        plain = join_tables(left, right, ["k"], how, skew="off")
        assert bag(join_tables(left, right, ["k"], how, skew="on")) == bag(plain)


def test_semi_and_anti(sides):
    left, right = sides
    semi = join_tables(left, right, ["k"], "left_semi")
    anti = join_tables(left, right, ["k"], "leftanti")
    assert semi.columns == left.columns
    assert bag(semi) + bag(anti) == bag(left)
    assert anti.filter("k IS NULL").count() == 5


def test_keyed_cross_is_inner_and_keys_are_required(sides):
    left, right = sides
    assert bag(join_tables(left, right, ["k"], "cross")) == bag(
        join_tables(left, right, ["k"], "inner")
    )
    with pytest.raises(ValueError, match="at least one key"):
        join_tables(left, right, [], "cross")
    with pytest.raises(ValueError, match="unknown join type"):
        join_type("sideways")


def test_hot_key_probe(spark):
    hot = spark.range(30000).selectExpr("if(id % 3 = 0, -1, id) AS k")
    assert has_hot_key(hot, ["k"], hot_rows=5000)
    assert not has_hot_key(hot, ["k"], hot_rows=50000)
    assert not has_hot_key(spark.range(30000).selectExpr("id AS k"), ["k"], hot_rows=5000)
    assert not has_hot_key(hot.filter("false"), ["k"], hot_rows=1)
    rare = spark.range(4_000_000).selectExpr("if(id % 20000 = 0, -1, id) AS k")
    assert has_hot_key(rare, ["k"], hot_rows=200)
    unknown = hot.selectExpr("nullif(k, -1) AS k")
    assert not has_hot_key(unknown, ["k"], hot_rows=5000)
    assert has_hot_key(unknown, ["k"], hot_rows=5000, with_nulls=True)


@pytest.mark.parametrize("how", ["left", "right", "full"])
def test_a_found_hot_key_changes_the_plan_not_the_rows(spark, sides, how):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        left, right = sides
        found = join_tables(left, right, ["k"], how, hot_rows=3)
        plain = join_tables(left, right, ["k"], how, hot_rows=1000)
        assert "__cell" in found._jdf.queryExecution().toString()
        assert "__cell" not in plain._jdf.queryExecution().toString()
        assert bag(found) == bag(plain)
    finally:
        spark.conf.set(key, before)


SPLITTING = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10000",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10000",
}


@pytest.mark.parametrize("how", ["inner", "left", "right", "full", "semi", "anti"])
@pytest.mark.parametrize("hot_side", ["left", "right", "nulls"])
def test_run_time_split_of_hot_keys(spark, how, hot_side):
    """Every sort-merge join that takes the hot rows splits them."""
    root = scratch_path(spark, "hot")
    hot = {"left": "if(id % 3 = 0, 7, id)", "nulls": "if(id % 3 = 0, NULL, id)"}
    spark.range(0, 60000, 1, 8).selectExpr(f"{hot.get(hot_side, 'id')} AS k", "id AS a").write.parquet(f"{root}/l")
    many = "if(id % 3 = 0, 7, id + 100)" if hot_side == "right" else "id"
    spark.range(0, 20000, 1, 8).selectExpr(f"{many} AS k", "id AS b").write.parquet(f"{root}/r")
    left, right = spark.read.parquet(f"{root}/l"), spark.read.parquet(f"{root}/r")
    plain = bag(join_tables(left, right, ["k"], how, skew="off"))
    with settings(spark, SPLITTING):
        frame = join_tables(left, right, ["k"], how, hot_rows=5000)
        assert bag(frame) == plain
        executed = frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # The side that Spark can split is split by it, the other one is dealt over cells.
    split = "SortMergeJoin(skew=true)" in executed
    if how in ("semi", "anti") and hot_side == "right":
        return  # its rows are distinct keys by then
    if hot_side == "nulls":
        assert split or how in ("inner", "right", "semi", "full")
    else:
        rigid = {"left": "right", "right": "left"}.get(how) == hot_side or how == "full"
        assert ("__cell" in executed) if rigid else split


def wide(spark, root, name, rows, keys):
    """Rows of about 20 KB, as texts that do not compress."""
    text = "concat_ws('', transform(sequence(1, 320), x -> sha2(concat(id, '-', x), 256)))"
    path = f"{root}/{name}"
    spark.range(0, rows, 1, 8).selectExpr(f"{keys} AS k", f"{text} AS {name}_text", f"id AS {name}").write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("how", ["left", "right", "full"])
def test_wide_rows_of_a_hot_key_are_spread(spark, how, monkeypatch):
    """600 rows of 20 KB are hot where 60,000 narrow ones are not; no task gets much more than others."""
    monkeypatch.setattr(joins, "HOT_BYTES", 4 << 20)
    root = scratch_path(spark, "wide")
    heavy = wide(spark, root, "heavy", 1800, "if(id % 3 = 0, 7, id)")
    spark.range(0, 60_000, 1, 8).selectExpr("if(id % 3 = 0, 9, id % 1800) AS k", "id AS n").write.parquet(f"{root}/n")
    narrow = spark.read.parquet(f"{root}/n")
    assert [r.k for r in heavy_keys(heavy, ["k"]).collect()] == [7]
    assert not has_hot_key(narrow, ["k"])
    left, right = (narrow, heavy) if how == "left" else (heavy, narrow)
    unsplit = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.enabled": "false",
    }
    with settings(spark, unsplit):
        frame = join_tables(left, right, ["k"], how)
        plain = join_tables(left, right, ["k"], how, skew="off")
        assert frame.columns == plain.columns
        assert bag(frame.drop("heavy_text")) == bag(plain.drop("heavy_text"))

        def by_task(joined):
            parts = joined.filter("heavy IS NOT NULL").groupBy(F.spark_partition_id().alias("part"))
            return sorted(r.n for r in parts.agg(F.countDistinct("heavy").alias("n")).collect())

        spread, lumped = by_task(frame), by_task(plain)
        assert max(spread) <= 2 * spread[len(spread) // 2] < max(lumped)


def test_keys_heavy_on_both_sides_and_on_one_only(spark):
    left = spark.range(600).selectExpr("if(id < 200, 1, if(id < 350, 2, if(id < 360, NULL, id))) AS k", "id AS a")
    right = spark.range(600).selectExpr("if(id < 250, 1, if(id < 400, 3, if(id < 410, NULL, id))) AS k", "id AS b")
    for how in ("left", "right", "full"):
        plain = join_tables(left, right, ["k"], how, skew="off")
        with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
            assert bag(join_tables(left, right, ["k"], how, hot_rows=100)) == bag(plain)
            assert bag(join_tables(left, right, ["k"], how, hot_rows=10)) == bag(plain)


def test_weights_are_those_of_the_rows(spark):
    rows = spark.sql(
        "SELECT * FROM VALUES (1, 'abc', binary('xy'), array('long', 'text')), (1, NULL, NULL, NULL) t(k, s, b, a)"
    )
    found = rows.toDF(*[f"c{n}" for n in range(4)]).select(joins.row_bytes(rows).alias("w")).collect()
    assert [r.w for r in found] == [32 + 3 + 2 + len('{"c3":["long","text"]}'), 32 + len("{}")]


def test_a_chain_reads_each_input_a_few_times(spark):
    root = scratch_path(spark, "chain")
    for n in range(4):
        spark.range(n, 100 + n).selectExpr("id AS k", f"id AS v{n}").write.parquet(f"{root}/{n}")
    tables = [spark.read.parquet(f"{root}/{n}") for n in range(4)]
    chain = join_chain(tables[0], [(t, ["k"], "full") for t in tables[1:]], skew="on")
    plain = join_chain(tables[0], [(t, ["k"], "full") for t in tables[1:]], skew="off")
    assert bag(chain) == bag(plain)
    scans = chain._jdf.queryExecution().optimizedPlan().toString().count("parquet")
    assert scans <= 6


def test_chain_drops_right_lineage_only(spark):
    left = spark.sql("SELECT 1 AS k, 'l' AS _source_file, current_timestamp() AS _ingested_at")
    right = spark.sql(
        "SELECT 1 AS k, 2 AS m, 'r' AS _source_file, current_timestamp() AS _ingested_at"
    )
    last = spark.sql("SELECT 2 AS m, 'deep' AS d, 's' AS _source_file")
    joined = join_chain(left, [(right, ["k"], "inner"), (last, ["m"], "left")])
    assert joined.columns == ["m", "k", "_source_file", "_ingested_at", "d"]
    assert joined.first()._source_file == "l"


def test_name_clash_is_reported_only_where_it_matters(spark, sides):
    left, right = sides
    root = scratch_path(spark, "clash")
    write_table(left, f"{root}/l")
    write_table(right, f"{root}/r")
    spec = GoldSpec(
        target_delta_path=f"{root}/gold",
        primary_table=f"{root}/l",
        joins=[JoinSpec(f"{root}/r", ["k", "j"], "inner")],
    )
    with pytest.raises(ValueError, match="shared"):
        run_gold(spark, spec)
    spec.select_expressions = ["k", "a + b AS both"]
    assert run_gold(spark, spec) == gold_frame(spark, spec).count()
    assert read_table(spark, f"{root}/gold").columns == ["k", "both"]


def test_aggregation_names(spark):
    df = spark.sql("SELECT * FROM VALUES ('a', 1, 2.0D), ('a', NULL, 4.0D) t(g, v, w)")
    row = aggregate(df, ["g"], {"v": "count", "w": "avg", "*": "count", "v + w": "max"}).first()
    assert row.asDict() == {
        "g": "a",
        "v_count": 1,
        "w_avg": 3.0,
        "all_count": 2,
        "v_w_max": 3.0,
    }


def test_projection_wins_and_nothing_passes_through(spark):
    df = spark.sql("SELECT 1 AS g, 2 AS v")
    shaped = shape(df, ["v AS only"], ["g"], {"v": "sum"})
    assert shaped.columns == ["only"]
    assert shape(df, None, ["g"], {}) is df


def test_gold_needs_a_source(spark):
    with pytest.raises(ValueError, match="primary_table"):
        run_gold(spark, GoldSpec(target_delta_path="/tmp/none/x"))


def test_a_chain_is_not_staged_where_it_is_used_once(spark, monkeypatch):
    """A left join looks for hot keys on its right only; the joined rows before it, with all
    their columns, are written only if some are found."""
    left = spark.range(60).selectExpr("id AS k", "id % 7 AS m", "'wide' AS wide")
    middle = spark.range(60).selectExpr("id AS k", "id AS a")
    right = spark.range(40).selectExpr("id % 5 AS m", "id AS b")
    staged, stage = [], joins.stage
    monkeypatch.setattr(joins, "stage", lambda df, name: staged.append(name) or stage(df, name))
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        plain = bag(join_chain(left, [(middle, ["k"], "inner"), (right, ["m"], "left")], skew="off"))
        assert not staged
        assert bag(join_chain(left, [(middle, ["k"], "inner"), (right, ["m"], "left")])) == plain
        assert "full-buckets" in staged and "join" not in staged
        monkeypatch.setattr(joins, "HOT_BYTES", 100)
        assert bag(join_chain(left, [(middle, ["k"], "inner"), (right, ["m"], "left")])) == plain
        assert "join" in staged
