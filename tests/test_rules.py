from __future__ import annotations

import pytest

from terrane.operators.rules import (
    Rule,
    quality_metrics,
    quality_report,
    quarantined_rows,
    repeatable,
    rule_failures,
    tag_failures,
    valid_rows,
)
from terrane.plans.layers import route, run_silver
from terrane.plans.spec import RuleSpec, SilverSpec
from terrane.session import scratch_path
from terrane.sources.tables import is_table, read_table, write_table

RULES = [
    Rule("has_s", "s IS NOT NULL"),
    Rule("adult", "age >= 18 AND age <= 120"),
    Rule("known", "s IS NOT NULL AND s IN ('A', 'P')"),
]


@pytest.fixture()
def people(spark):
    return spark.sql(
        "SELECT * FROM VALUES (1, 'A', 30), (2, NULL, 30), (3, 'A', NULL), (4, 'X', 10), "
        "(5, 'P', 120), (6, NULL, NULL) t(id, s, age)"
    )


def test_three_valued_rules_partition_the_rows(people):
    valid = {r.id for r in valid_rows(people, RULES).collect()}
    rejected = {r.id: r._failed_rules for r in quarantined_rows(people, RULES).collect()}
    assert valid == {1, 5}
    assert rejected == {
        2: ["has_s", "known"],
        3: ["adult"],
        4: ["adult", "known"],
        6: ["has_s", "adult", "known"],
    }


def test_a_rule_may_contain_or(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 1), (2, 2), (3, 3) t(id, v)")
    rules = [Rule("a", "v = 1 OR v = 2"), Rule("b", "v = 2 OR v = 3")]
    assert [r.id for r in valid_rows(df, rules).collect()] == [2]


def test_malformed_text_is_quarantined_and_ansi_comes_back(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 'abc'), (2, '20'), (3, NULL) t(id, age)")
    before = spark.conf.get("spark.sql.ansi.enabled")
    rules = [Rule("adult", "age >= 18")]
    valid, rejected = valid_rows(df, rules), quarantined_rows(df, rules)
    assert spark.conf.get("spark.sql.ansi.enabled") == before
    assert [r.id for r in valid.collect()] == [2]
    assert sorted(r.id for r in rejected.collect()) == [1, 3]


def test_bad_rule_text_restores_the_mode(people, spark):
    before = spark.conf.get("spark.sql.ansi.enabled")
    with pytest.raises(Exception):
        valid_rows(people, [Rule("broken", "no_such_column > 1")])
    assert spark.conf.get("spark.sql.ansi.enabled") == before


def test_metrics_and_failures(people, spark):
    tagged = tag_failures(people, RULES)
    row = quality_metrics(tagged).first().asDict()
    assert row == quality_report(2, 4)
    assert row["pass_rate_pct"] == 33.33 and row["quarantine_ratio_pct"] == 66.67
    counts = {r.rule: r.failed_rows for r in rule_failures(tagged).collect()}
    assert counts == {"has_s": 2, "adult": 3, "known": 3}
    empty = quality_metrics(tagged.filter("false")).first().asDict()
    assert empty == quality_report(0, 0)
    assert empty["pass_rate_pct"] == 100.0 and empty["quarantine_ratio_pct"] == 0.0


def test_valid_filter_reaches_the_scan(spark):
    path = scratch_path(spark, "push")
    spark.range(10).selectExpr("id", "id AS age").write.parquet(path)
    frame = valid_rows(spark.read.parquet(path), [Rule("r", "age >= 5")])
    assert "GreaterThanOrEqual(age,5)" in frame._jdf.queryExecution().toString()


@pytest.mark.parametrize("staged", [True, False])
def test_routes_agree(people, spark, staged):
    clean, bad = scratch_path(spark, "clean"), scratch_path(spark, "bad")
    assert route(people, RULES, clean, bad, "overwrite", staged=staged) == (2, 4)
    assert sorted(r.id for r in read_table(spark, clean).collect()) == [1, 5]
    rejected = read_table(spark, bad)
    assert rejected.count() == 4
    assert rejected.filter("size(_failed_rules) = 0 OR _quarantined_at IS NULL").count() == 0
    assert "_failed_rules" not in read_table(spark, clean).columns


@pytest.mark.parametrize("staged", [True, False])
def test_nothing_failed_writes_no_quarantine(people, spark, staged):
    clean, bad = scratch_path(spark, "clean"), scratch_path(spark, "bad")
    counts = route(people, [Rule("ok", "id > 0")], clean, bad, "overwrite", staged=staged)
    assert counts == (6, 0)
    assert not is_table(spark, bad)


def test_rules_over_the_clock_are_judged_once(people, spark, monkeypatch):
    from terrane.plans import layers

    assert repeatable(people, RULES)
    clock = [Rule("past", "current_timestamp() > timestamp'2000-01-01' AND id < 4")]
    assert not repeatable(people, clock)
    assert not repeatable(people, [Rule("luck", "RAND() < 0.5")])
    assert not repeatable(people.selectExpr("*", "rand() AS r"), RULES)
    copies_made = []
    real = layers.stage
    monkeypatch.setattr(layers, "stage", lambda *a: copies_made.append(a) or real(*a))
    for rules, copies in ((clock, 1), ([Rule("luck", "rand() < 0.5")], 2), (RULES, 2)):
        clean, bad = scratch_path(spark, "clean"), scratch_path(spark, "bad")
        counts = route(people, rules, clean, bad, "overwrite")
        assert sum(counts) == 6 and len(copies_made) == copies


def silver(spark, people, **extra):
    source, root = scratch_path(spark, "in"), scratch_path(spark, "silver")
    write_table(people, source)
    spec = SilverSpec(
        source_delta_path=source,
        target_delta_path=f"{root}/clean",
        validation_rules=[RuleSpec(r.name, r.expr) for r in RULES],
        **extra,
    )
    return run_silver(spark, spec), root


def test_rules_without_quarantine_are_refused_or_ignored(people, spark):
    with pytest.raises(ValueError, match="quarantine_delta_path"):
        silver(spark, people)
    report, root = silver(spark, people, on_invalid="ignore")
    assert report["clean_count"] == 6 and report["pass_rate_pct"] == 100.0
    assert read_table(spark, f"{root}/clean").count() == 6


def test_a_second_run_replaces_clean_and_adds_to_quarantine(people, spark):
    root = scratch_path(spark, "silver")
    write_table(people, f"{root}/in")
    spec = SilverSpec(
        source_delta_path=f"{root}/in",
        target_delta_path=f"{root}/clean",
        quarantine_delta_path=f"{root}/bad",
        drop_duplicates=["id"],
        validation_rules=[RuleSpec(r.name, r.expr) for r in RULES],
    )
    for _ in range(2):
        assert run_silver(spark, spec)["total_evaluated"] == 6
    assert read_table(spark, f"{root}/clean").count() == 2
    assert read_table(spark, f"{root}/bad").count() == 8
