from __future__ import annotations

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from terrane.operators import profiling
from terrane.operators.profiling import histogram, summary
from terrane.operators.sampling import sample, split
from terrane.operators.scoring import residual_histogram, residuals


def frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "v double")


def check(spark, values):
    row = summary(frame(spark, values), ["v"], digits=9).first()
    real = np.array([v for v in values if v is not None and not math.isnan(v)])
    assert row["count"] == len(real)
    for name, q in (("p25", 25), ("p50", 50), ("p75", 75)):
        assert row[name] == pytest.approx(np.percentile(real, q), rel=1e-12, abs=1e-8)
    assert row["mean"] == pytest.approx(real.mean(), rel=1e-9, abs=1e-8)
    if len(real) > 1:
        assert row["std"] == pytest.approx(real.std(ddof=1), rel=1e-9, abs=1e-8)


SHAPES = {
    "even": lambda rng: rng.uniform(-5, 5, 4000),
    "long tail": lambda rng: rng.lognormal(0, 8, 4000),
    "third on one value": lambda rng: np.where(
        rng.random(4000) < 0.34, 7.0, rng.normal(7, 2, 4000)
    ),
    "two values": lambda rng: np.repeat([1.0, 2.0], 2000),
    "constant": lambda rng: np.full(4000, 3.0),
    "few": lambda rng: rng.integers(0, 5, 4000).astype(float),
}


@pytest.mark.parametrize("inside", [1_000_000, 50])
@pytest.mark.parametrize("shape", SHAPES)
def test_quartiles_are_exact_whether_or_not_brackets_are_narrowed(
    spark, shape, inside, monkeypatch
):
    monkeypatch.setattr(profiling, "_MAX_INSIDE", inside)
    monkeypatch.setattr(profiling, "_ACCURACY", 200)
    check(spark, SHAPES[shape](np.random.default_rng(1)).tolist())


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(-50, 50).map(float), min_size=1, max_size=60))
def test_small_inputs(spark, values):
    check(spark, values)


def test_missing_values_do_not_count(spark):
    check(spark, [1.0, None, float("nan"), 4.0, 2.0])
    row = summary(frame(spark, [None, float("nan")]), ["v"]).first()
    assert row["count"] == 0 and row["p50"] is None and row["mean"] is None


def test_several_columns_keep_their_order(spark):
    df = spark.range(101).selectExpr("id AS a", "id * 2.5D AS b")
    got = {r["column"]: (r["p25"], r["p50"], r["max"]) for r in summary(df, ["a", "b"]).collect()}
    assert got == {"a": (25.0, 50.0, 100.0), "b": (62.5, 125.0, 250.0)}


@pytest.mark.parametrize("values", [list(range(101)), [5.0] * 9, [0.0, 1.0, 1.0, 2.0, 49.99, 50.0]])
def test_histogram_matches_numpy(spark, values):
    values = [float(v) for v in values]
    got = histogram(frame(spark, [*values, None, float("nan")]), "v").orderBy("bin").collect()
    counts, edges = np.histogram(values, bins=50)
    assert [r.rows for r in got] == counts.tolist()
    assert [r.bin_start for r in got] == pytest.approx(edges[:-1].tolist())
    assert [r.bin_end for r in got] == pytest.approx(edges[1:].tolist())


def test_histogram_of_nothing_is_empty(spark):
    assert histogram(frame(spark, [None]), "v").count() == 0


def test_residuals(spark):
    df = spark.sql("SELECT * FROM VALUES (3.0D, 1.0D), (NULL, 1.0D), (1.0D, NULL) t(p, a)")
    assert [r.residual for r in residuals(df, "p", "a").collect()] == [2.0]
    assert residual_histogram(df, "p", "a", bins=4).agg({"rows": "sum"}).first()[0] == 1


def test_split_is_disjoint_complete_and_ignores_layout(spark):
    df = spark.range(2000).selectExpr("id", "id % 7 AS x")
    train, test = split(df, ["id"], 0.8, seed=42)
    a, b = {r.id for r in train.collect()}, {r.id for r in test.collect()}
    assert not a & b and len(a | b) == 2000 and 1500 < len(a) < 1700
    again, _ = split(df.repartition(13), ["id"], 0.8, seed=42)
    assert {r.id for r in again.collect()} == a
    other, _ = split(df, ["id"], 0.8, seed=43)
    assert {r.id for r in other.collect()} != a


def test_a_sample_does_not_depend_on_the_layout(spark):
    df = spark.range(20000)
    plain = [r.id for r in sample(df, ["id"], 50, seed=1).collect()]
    for parts in (1, 4, 8):
        assert [r.id for r in sample(df.repartition(parts), ["id"], 50, seed=1).collect()] == plain
    assert len(plain) == 50
    assert sample(df.limit(3), ["id"], 50, seed=1).count() == 3
