from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrane.operators.cleansing import unseen
from terrane.operators.quantiles import exact_quantiles
from terrane.operators.sketches import estimates, merged, sketched


def test_quantiles_of_hot_small_and_empty_groups(spark):
    random = np.random.default_rng(2)
    rows = [("hot", float(v)) for v in random.integers(-50, 50, 3000)]
    rows += [(f"g{k % 40}", float(v)) for k, v in enumerate(random.normal(size=500))]
    rows += [(None, 1.5), (None, -2.0), ("one", 7.0), ("none", None), ("none", float("nan")), ("hot", None)]
    frame = spark.createDataFrame(rows, "g string, `v.x` double").repartition(6)
    wanted = {"least": 0.0, "low": 0.1, "middle": 0.5, "high": 0.987, "most": 1.0}
    got = {r.g: r for r in exact_quantiles(frame, ["g"], "v.x", wanted).collect()}
    groups = {}
    for g, v in rows:
        if v is not None and not np.isnan(v):
            groups.setdefault(g, []).append(v)
    assert set(got) == set(groups)
    for g, values in groups.items():
        for name, p in wanted.items():
            assert got[g][name] == pytest.approx(np.quantile(values, p))
    whole = exact_quantiles(frame, [], "v.x", {"middle": 0.5}).first().middle
    assert whole == pytest.approx(np.quantile(np.concatenate(list(groups.values())), 0.5))
    assert exact_quantiles(frame.limit(0), ["g"], "v.x", wanted).count() == 0
    with pytest.raises(ValueError, match="not within"):
        exact_quantiles(frame, ["g"], "v.x", {"x": 1.5})


def test_a_group_of_a_third_of_all_rows_is_in_many_tasks(spark):
    """Rows are sorted by range over group and value: the hot group's values fill several parts."""
    from terrane.operators.numbering import running_total

    rows = spark.range(60_000).selectExpr("if(id % 3 = 0, 'hot', concat('g', id)) AS g", "id AS v")
    order = [F.col("g"), F.col("v")]
    placed = rows.orderBy(*order).withColumn("part", F.spark_partition_id())
    spread = placed.groupBy("part").agg(F.count_if(F.col("g") == "hot").alias("hot"), F.count("*").alias("n")).collect()
    assert max(r.n for r in spread) < 2 * 60_000 / len(spread) or len(spread) == 1
    sums = running_total(rows, order, F.col("v") % 5, "before").orderBy(*order).collect()
    total = 0
    for row in sums:
        assert row.before == total
        total += row.v % 5


def test_sketches_of_parts_merge_to_that_of_the_whole(spark):
    rows = spark.range(40_000).selectExpr(
        "id % 3 AS g", "id % 5 AS batch", "if(id % 11 = 0, NULL, id % 7001) AS k", "double(id % 1000) AS v"
    )
    keep = {"distinct": ["k"], "quantiles": ["v"]}
    parts = sketched(rows, ["g", "batch"], **keep)
    one = estimates(merged(parts, ["g"], **keep), ["g"], **keep, probabilities=[0.1, 0.5]).collect()
    whole = {r.g: r for r in estimates(sketched(rows, ["g"], **keep), ["g"], **keep, probabilities=[0.1, 0.5]).collect()}
    exact = {r.g: r.n for r in rows.groupBy("g").agg(F.countDistinct("k").alias("n")).collect()}
    for row in one:
        assert row.rows == whole[row.g].rows
        for told in (row, whole[row.g]):
            assert told.k_distinct == pytest.approx(exact[row.g], rel=0.05)
            assert told.v_quantiles == pytest.approx([100, 500], abs=35)
        assert row.k_distinct == pytest.approx(whole[row.g].k_distinct, rel=0.03)
    assert sketched(rows.limit(0), ["g"], **keep).count() == 0


def test_unseen_rows_by_keys_with_nulls_and_types(spark):
    new = spark.sql("SELECT * FROM VALUES (1, 'a', 1), (1, NULL, 2), (2, 'a', 3), (NULL, NULL, 4), (3, 'b', 5) t(k, `j.x`, v)")
    old = spark.sql("SELECT * FROM VALUES (1L, 'a', 9), (NULL, NULL, 9), (7L, 'b', 9), (1L, NULL, 9) t(k, `j.x`, w)")
    assert sorted(r.v for r in unseen(new, old, ["k", "j.x"]).collect()) == [3, 5]
    assert unseen(new, old, ["k"]).columns == ["k", "j.x", "v"]
    assert unseen(new, old.limit(0), ["k"]).count() == 5 and unseen(new.limit(0), old, ["k"]).count() == 0


def test_a_profile_of_parts_is_that_of_the_whole(spark):
    from terrane.operators.increments import described, merged_profile, profile_part
    from terrane.operators.profiling import summary

    rows = spark.range(3000).selectExpr(
        "id", "if(id % 7 = 0, NULL, 1e9 + id % 50) AS a", "if(id % 9 = 0, double('NaN'), id / 3.0D) AS b", "id % 4 AS part",
        "CAST(NULL AS DOUBLE) AS none",
    )
    columns, edges = ["a", "b", "none"], {"b": [0.0, 100.0, 500.0, 900.0]}
    parts = [profile_part(rows.filter(f"part = {k}"), columns, edges) for k in range(4)]
    parts.append(profile_part(rows.limit(0), columns, edges))
    merged = merged_profile(parts[0].union(parts[1]).union(merged_profile(parts[2].union(parts[3]).union(parts[4]))))
    whole = {r.column: r for r in summary(rows, columns).select("column", "count", "mean", "std", "min", "max").collect()}
    assert {r.column: r for r in described(merged).collect()} == whole
    values = [k / 3 for k in range(3000) if k % 9]
    exact = [sum(v < 0 for v in values), sum(v < 100 for v in values), sum(100 <= v < 500 for v in values),
             sum(500 <= v <= 900 for v in values), sum(v > 900 for v in values)]
    assert {r.column: r.bins for r in merged.collect()} == {"a": [], "b": exact, "none": []}
