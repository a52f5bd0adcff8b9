"""Cleansing, rules and quarantine. The input tables have no gaps, so some are made."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrane.functions.columns import FAILED_RULES
from terrane.operators.cleansing import deduplicate, drop_missing, impute
from terrane.operators.rules import (
    Rule,
    quality_metrics,
    quarantined_rows,
    rule_failures,
    tag_failures,
    valid_rows,
)
from terrane.plans.layers import run_silver
from terrane.plans.spec import RuleSpec, SilverSpec
from terrane.queries.bronze import land
from terrane.queries.registry import query, table
from terrane.session import scratch_path
from terrane.sources.landing import read_landing, with_lineage
from terrane.sources.tables import read_table, write_table
from terrane.streaming.ingest import landing_stream
from terrane.streaming.routing import route_stream

RULES = [
    Rule("valid_status", "o_orderstatus IS NOT NULL AND o_orderstatus IN ('F', 'O')"),
    Rule("valid_price", "o_totalprice >= 5000 AND o_totalprice <= 450000"),
    Rule("not_urgent", "priority <> '1-URGENT'"),
]
# Text that is no number compared with a number must not stop the job.
TEXT_RULES = [
    Rule("small_code", "if(o_orderstatus = 'P', 'abc', substr(o_orderpriority, 1, 1)) < 4")
]

_GAPS = """
    SELECT o_orderkey, o_orderstatus, o_totalprice,
           nullif(o_orderpriority, '5-LOW') AS priority
    FROM orders"""
_CHECKED = f"""
    SELECT *, coalesce(o_orderstatus IS NOT NULL AND o_orderstatus IN ('F', 'O'), false) AS r1,
           coalesce(o_totalprice >= 5000 AND o_totalprice <= 450000, false) AS r2,
           coalesce(priority <> '1-URGENT', false) AS r3
    FROM ({_GAPS})"""
_TAGS = """concat_ws(',', CASE WHEN NOT r1 THEN 'valid_status' END,
                          CASE WHEN NOT r2 THEN 'valid_price' END,
                          CASE WHEN NOT r3 THEN 'not_urgent' END)"""


def gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "o_orderstatus",
        "o_totalprice",
        "nullif(o_orderpriority, '5-LOW') AS priority",
    )


@query(
    "silver_valid",
    f"""SELECT o_orderkey, o_orderstatus, o_totalprice, priority
        FROM ({_CHECKED}) WHERE r1 AND r2 AND r3""",
)
def silver_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return valid_rows(gaps(spark, sf_dir), RULES)


@query(
    "silver_quarantine",
    f"""SELECT o_orderkey, o_orderstatus, o_totalprice, priority, {_TAGS} AS failed
        FROM ({_CHECKED}) WHERE NOT (r1 AND r2 AND r3)""",
)
def silver_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = quarantined_rows(gaps(spark, sf_dir), RULES)
    return rejected.select(
        "o_orderkey",
        "o_orderstatus",
        "o_totalprice",
        "priority",
        F.array_join(FAILED_RULES, ",").alias("failed"),
    )


@query(
    "silver_lenient_cast",
    """SELECT o_orderkey, o_orderpriority,
              CASE WHEN o_orderstatus <> 'P' AND substr(o_orderpriority, 1, 1)::INTEGER < 4
                   THEN '' ELSE 'small_code' END AS failed
       FROM orders""",
)
def silver_lenient_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text compared with a number: what is no number fails the rule."""
    tagged = tag_failures(table(spark, sf_dir, "orders"), TEXT_RULES)
    return tagged.select(
        "o_orderkey", "o_orderpriority", F.array_join(FAILED_RULES, ",").alias("failed")
    )


@query(
    "silver_dq_metrics",
    f"""SELECT *, round(clean_count / total_evaluated * 100.0, 2) AS pass_rate_pct,
               round(quarantine_count / total_evaluated * 100.0, 2) AS quarantine_ratio_pct
        FROM (SELECT count(*) FILTER (WHERE r1 AND r2 AND r3) AS clean_count,
                     count(*) FILTER (WHERE NOT (r1 AND r2 AND r3)) AS quarantine_count,
                     count(*) AS total_evaluated
              FROM ({_CHECKED}))""",
)
def silver_dq_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_metrics(tag_failures(gaps(spark, sf_dir), RULES))


@query(
    "silver_rule_failures",
    f"""SELECT rule, failed_rows FROM (
          SELECT 'valid_status' AS rule, count(*) FILTER (WHERE NOT r1) AS failed_rows
          FROM ({_CHECKED})
          UNION ALL SELECT 'valid_price', count(*) FILTER (WHERE NOT r2) FROM ({_CHECKED})
          UNION ALL SELECT 'not_urgent', count(*) FILTER (WHERE NOT r3) FROM ({_CHECKED}))
        WHERE failed_rows > 0""",
)
def silver_rule_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_failures(tag_failures(gaps(spark, sf_dir), RULES))


def _survivors(order: str) -> str:
    return f"""
    SELECT * EXCLUDE (rn) FROM (
      SELECT *, row_number() OVER (
        PARTITION BY l_orderkey, l_linenumber ORDER BY {order}) AS rn
      FROM lineitem)
    WHERE rn = 1"""


_OTHERS = (
    "l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, "
    "l_returnflag, l_linestatus, l_shipdate"
)


@query("silver_dedup", _survivors(f"l_shipdate DESC, {_OTHERS}"))
def silver_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order line, the latest shipped."""
    lines = table(spark, sf_dir, "lineitem")
    return deduplicate(lines, ["l_orderkey", "l_linenumber"], [F.col("l_shipdate").desc()])


def measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in which clicks carry no value and views carry NaN."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "nullif(event_type, 'click') AS kind",
        "CASE WHEN event_type = 'click' THEN NULL "
        "WHEN event_type = 'view' THEN double('NaN') ELSE value END AS value",
    )


_MISSING = "event_type IN ('click', 'view')"


@query(
    "silver_fill_na",
    f"""SELECT event_id, coalesce(nullif(event_type, 'click'), 'none') AS kind,
               CASE WHEN {_MISSING} THEN -1.0 ELSE value END AS value
        FROM events""",
)
def silver_fill_na(spark: SparkSession, sf_dir: str) -> DataFrame:
    return impute(measured(spark, sf_dir), {"kind": "none", "value": -1.0})


@query(
    "silver_drop_na",
    f"SELECT event_id, event_type AS kind, value FROM events WHERE NOT {_MISSING}",
)
def silver_drop_na(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_missing(measured(spark, sf_dir), ["kind", "value"])


@query(
    "silver_layer",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_returnflag,
               concat_ws(',', CASE WHEN l_quantity < 5 THEN 'enough' END,
                              CASE WHEN l_returnflag = 'R' THEN 'kept' END) AS failed
        FROM ({_survivors(_OTHERS)})""",
)
def silver_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole layer: de-duplicate, validate, write both tables, read both back."""
    root = scratch_path(spark, "silver")
    landed = read_landing(spark, sf_dir, file_format="parquet", file_pattern="lineitem.parquet")
    write_table(with_lineage(landed), f"{root}/bronze", "append")
    run_silver(
        spark,
        SilverSpec(
            source_delta_path=f"{root}/bronze",
            target_delta_path=f"{root}/clean",
            quarantine_delta_path=f"{root}/quarantine",
            drop_duplicates=["l_orderkey", "l_linenumber"],
            validation_rules=[
                RuleSpec("enough", "l_quantity >= 5"),
                RuleSpec("kept", "l_returnflag IN ('A', 'N')"),
            ],
        ),
    )
    shown = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_returnflag"]
    clean = read_table(spark, f"{root}/clean").select(*shown, F.lit("").alias("failed"))
    rejected = read_table(spark, f"{root}/quarantine")
    return clean.unionByName(
        rejected.select(*shown, F.array_join(FAILED_RULES, ",").alias("failed"))
    )


@query(
    "silver_stream",
    f"""SELECT o_orderkey, o_orderstatus, o_totalprice, priority, {_TAGS} AS failed
        FROM ({_CHECKED})""",
)
def silver_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "silver-stream")
    source = gaps(spark, sf_dir)
    land(source, f"{root}/landing", "json")
    stream = landing_stream(
        spark, f"{root}/landing", source.schema, file_pattern="*.json", max_files_per_batch=4
    )
    route_stream(stream, RULES, f"{root}/clean", f"{root}/quarantine", f"{root}/checkpoint")
    clean = read_table(spark, f"{root}/clean").withColumn("failed", F.lit(""))
    rejected = read_table(spark, f"{root}/quarantine")
    return clean.unionByName(
        rejected.select(*source.columns, F.array_join(FAILED_RULES, ",").alias("failed"))
    )




@query(
    "silver_append_unique",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 3 < 2 THEN 'first' ELSE 'second' END AS batch
       FROM orders""",
)
def silver_append_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appended batches that share a third of the keys leave each key once."""
    root = scratch_path(spark, "unique")
    source = table(spark, sf_dir, "orders").select("o_orderkey")
    for name, part in (("first", "o_orderkey % 3 < 2"), ("second", "o_orderkey % 3 > 0")):
        write_table(source.filter(part).withColumn("batch", F.lit(name)), f"{root}/bronze")
        spec = SilverSpec(
            source_delta_path=f"{root}/bronze",
            target_delta_path=f"{root}/silver",
            write_mode="append",
            drop_duplicates=["o_orderkey"],
            unique_across_batches=True,
        )
        run_silver(spark, spec)
    return read_table(spark, f"{root}/silver")
