"""Table upkeep and the whole job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrane.operators.runlog import of_latest_run
from terrane.operators.upkeep import compact, maintain, stale_files
from terrane.plans.job import run
from terrane.queries.bronze import land
from terrane.queries.registry import query, table
from terrane.session import scratch_path, settings
from terrane.sources.tables import read_table, write_table

# Rows a file: many files, whose number follows the table.
SHORT_FILES = {"spark.sql.files.maxRecordsPerFile": "5000"}


@query("maintain_compact", "SELECT * FROM lineitem")
def maintain_compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of many small files keeps its rows when packed."""
    target = scratch_path(spark, "compact")
    with settings(spark, SHORT_FILES):
        write_table(table(spark, sf_dir, "lineitem"), target)
    compact(spark, target)
    return read_table(spark, target)


@query("maintain_stale_files", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'")
def maintain_stale_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files an overwrite left behind hold just the rows it replaced."""
    target = scratch_path(spark, "stale")
    source = table(spark, sf_dir, "orders")
    write_table(source.filter("o_orderstatus = 'F'"), target)
    write_table(source.filter("o_orderstatus <> 'F'"), target)
    # A bounded list of file names; the rows stay in Spark.
    left = [row["path"] for row in stale_files(spark, target, 0).toLocalIterator()]
    return spark.read.parquet(*left).select("o_orderkey")


@query(
    "maintenance_status",
    """SELECT 'orders' AS name, 'SUCCESS' AS status, count(*) AS rows FROM orders
       UNION ALL SELECT 'customer', 'SUCCESS', count(*) FROM customer""",
)
def maintenance_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two maintained tables report; one that does not exist is left out."""
    root = scratch_path(spark, "status")
    names = ["orders", "customer"]
    for name in names:
        with settings(spark, SHORT_FILES):
            write_table(table(spark, sf_dir, name), f"{root}/{name}")
    status = maintain(spark, [f"{root}/{n}" for n in [*names, "absent"]], 0)
    counts = [
        read_table(spark, f"{root}/{name}").agg(
            F.lit(name).alias("name"), F.count(F.lit(1)).alias("rows")
        )
        for name in names
    ]
    named = status.select(F.element_at(F.split("table", "/"), -1).alias("name"), "status")
    return named.join(counts[0].unionByName(counts[1]), "name")


_REPORT = """
    WITH kept AS (SELECT * FROM orders WHERE o_orderstatus IN ('F', 'O') AND o_totalprice >= 5000),
         n AS (SELECT (SELECT count(*) FROM orders) AS all_orders,
                      (SELECT count(DISTINCT o_orderkey) FROM orders) AS distinct_orders,
                      (SELECT count(*) FROM lineitem) AS all_lines,
                      (SELECT count(*) FROM kept) AS clean,
                      (SELECT count(*) FROM kept JOIN lineitem ON o_orderkey = l_orderkey) AS gold)
    SELECT 'bronze_record_count' AS key, (all_orders + all_lines)::DOUBLE AS value FROM n
    UNION ALL SELECT 'silver_record_count', clean FROM n
    UNION ALL SELECT 'quarantine_record_count', all_orders - clean FROM n
    UNION ALL SELECT 'dropped_record_count', all_orders - distinct_orders FROM n
    UNION ALL SELECT 'gold_record_count', gold FROM n
    UNION ALL SELECT 'dq_pass_rate_pct', round(clean / all_orders * 100.0, 2) FROM n
    UNION ALL SELECT 'dq_quarantine_ratio_pct',
                     round((all_orders - clean) / all_orders * 100.0, 2) FROM n"""


@query("run_report", _REPORT)
def run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every layer from one spec; the volume and quality metrics of its run record."""
    root = scratch_path(spark, "job")
    landings = []
    for name in ("orders", "lineitem"):
        source = table(spark, sf_dir, name)
        land(source, f"{root}/landing/{name}", "csv")
        ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in source.schema.fields)
        landings.append(
            {
                "name": name,
                "landing_path": f"{root}/landing/{name}",
                "file_format": "csv",
                "file_pattern": "*.csv",
                "target_delta_path": f"{root}/bronze/{name}",
                "options": {"header": True},
                "schema": ddl.replace("o_orderkey", "order_id").replace("l_orderkey", "order_id"),
            }
        )
    run(
        spark,
        {
            "pipeline_name": "orders_job",
            "version": "1.0",
            "bronze_tables": landings,
            "silver": {
                "source_delta_path": f"{root}/bronze/orders",
                "target_delta_path": f"{root}/silver/orders",
                "quarantine_delta_path": f"{root}/quarantine/orders",
                "drop_duplicates": ["order_id"],
                "validation_rules": [
                    {"name": "known_status", "expr": "o_orderstatus IN ('F', 'O')"},
                    {"name": "fair_price", "expr": "o_totalprice >= 5000"},
                ],
            },
            "gold": {
                "primary_table": f"{root}/silver/orders",
                "target_delta_path": f"{root}/gold/features",
                "joins": [
                    {"table": f"{root}/bronze/lineitem", "on": ["order_id"], "type": "inner"}
                ],
                "select_expressions": [
                    "order_id",
                    "l_quantity",
                    "l_extendedprice",
                    "l_returnflag",
                    "datediff(l_shipdate, o_orderdate) AS actual_delay_days",
                ],
            },
            "ml_stage": {
                "categorical_features": ["l_returnflag"],
                "numeric_features": ["l_quantity", "l_extendedprice"],
                "hyperparameters": {"maxIter": 2, "maxDepth": 2},
            },
            "mlflow": {"experiment_name": "orders"},
        },
    )
    runs, metrics = (read_table(spark, f"{root}/runs/{t}") for t in ("runs", "run_metrics"))
    found = of_latest_run(runs, metrics, "orders").select("key", "value")
    return found.filter("key LIKE '%record_count' OR key LIKE 'dq%'")
