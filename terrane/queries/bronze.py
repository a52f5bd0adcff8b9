"""Scans, landing sweeps and sinks: tables are landed as files and come back whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrane.functions.columns import INGESTED_AT, SOURCE_FILE
from terrane.operators.upkeep import compact
from terrane.plans.layers import run_bronze
from terrane.plans.spec import BronzeSpec
from terrane.queries.registry import query, table
from terrane.session import scratch_path
from terrane.sources import paths
from terrane.sources.inference import read_inferred
from terrane.sources.landing import read_landing, with_lineage
from terrane.sources.tables import batch_name, read_table, write_table
from terrane.streaming.ingest import ingest_stream

LANDED_ROWS = 1_000_000


def land(df: DataFrame, path: str, file_format: str) -> None:
    """Drop rows into a landing folder, in as many files as they fill."""
    files = df.write.mode("append").format(file_format)
    files.option("maxRecordsPerFile", LANDED_ROWS).option("header", True).save(path)


@query("scan_csv", "SELECT * FROM lineitem")
def scan_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = table(spark, sf_dir, "lineitem")
    landing = scratch_path(spark, "landing")
    land(source, landing, "csv")
    return read_landing(
        spark,
        landing,
        file_format="csv",
        file_pattern="*.csv",
        options={"header": True},
        schema=source.schema,
    )


@query("scan_json", "SELECT * FROM orders")
def scan_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = table(spark, sf_dir, "orders")
    landing = scratch_path(spark, "landing")
    land(source, landing, "json")
    return read_landing(spark, landing, schema=source.schema)


@query(
    "scan_csv_inferred",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate,
              CASE WHEN o_orderstatus = 'F' THEN o_totalprice > 100000 END AS large,
              'bigint, double, date, boolean' AS kinds
       FROM orders""",
)
def scan_csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two forms of file, with a header and no schema; one has a column the other lacks."""
    landing = scratch_path(spark, "landing")
    source = table(spark, sf_dir, "orders").select(
        (F.col("o_orderkey") + (1 << 40)).alias("o_orderkey"),
        "o_custkey",
        "o_orderstatus",
        "o_totalprice",
        F.col("o_orderdate").cast("date").alias("o_orderdate"),
    )
    finished = source.filter("o_orderstatus = 'F'").withColumn("large", F.col("o_totalprice") > 100000)
    land(finished.select(*reversed(finished.columns)), f"{landing}/f", "csv")
    land(source.filter("o_orderstatus <> 'F'"), f"{landing}/o", "csv")
    found = read_inferred(spark, landing, file_pattern="[fo]/*.csv")
    kinds = ", ".join(dict(found.dtypes)[c] for c in ("o_orderkey", "o_totalprice", "o_orderdate", "large"))
    return found.withColumns(
        {
            "o_orderkey": F.col("o_orderkey") - (1 << 40),
            "o_orderdate": F.date_format("o_orderdate", "yyyy-MM-dd"),
            "kinds": F.lit(kinds),
        }
    )


@query("scan_parquet", "SELECT * FROM customer")
def scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_landing(spark, sf_dir, file_format="parquet", file_pattern="customer.parquet")


@query("scan_glob", "SELECT * FROM orders WHERE o_orderstatus IN ('F', 'O')")
def scan_glob(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three status folders land; the pattern takes two of them."""
    source = table(spark, sf_dir, "orders")
    landing = scratch_path(spark, "landing")
    for status in ("F", "O", "P"):
        part = source.filter(F.col("o_orderstatus") == status)
        part.write.parquet(f"{landing}/orders_{status}")
    return read_landing(spark, landing, file_format="parquet", file_pattern="orders_[FO]")


@query(
    "bronze_ingest",
    """SELECT o_orderkey, o_custkey, o_totalprice,
              'orders.parquet' AS source_name, true AS has_ingest_time
       FROM orders""",
)
def bronze_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = read_landing(spark, sf_dir, file_format="parquet", file_pattern="orders.parquet")
    return with_lineage(landed).select(
        "o_orderkey",
        "o_custkey",
        "o_totalprice",
        F.element_at(F.split(SOURCE_FILE, "/"), -1).alias("source_name"),
        F.col(INGESTED_AT).isNotNull().alias("has_ingest_time"),
    )


@query(
    "bronze_multi",
    """SELECT 'orders' AS source, o_orderkey AS row_key FROM orders
       UNION ALL SELECT 'customer', c_custkey FROM customer
       UNION ALL SELECT 'supplier', s_suppkey FROM supplier""",
)
def bronze_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three landings in three formats, ingested from one list."""
    root = scratch_path(spark, "bronze")
    formats = {"orders": "csv", "customer": "json", "supplier": "parquet"}
    landings = []
    for name, file_format in formats.items():
        source = table(spark, sf_dir, name)
        land(source, f"{root}/landing/{name}", file_format)
        landings.append(
            BronzeSpec(
                landing_path=f"{root}/landing/{name}",
                target_delta_path=f"{root}/{name}",
                name=name,
                file_format=file_format,
                options={"header": True},
                schema=source.schema,
            )
        )
    run_bronze(spark, landings)
    keys = {"orders": "o_orderkey", "customer": "c_custkey", "supplier": "s_suppkey"}
    read_back = [
        read_table(spark, f"{root}/{name}").select(
            F.lit(name).alias("source"), F.col(key).alias("row_key")
        )
        for name, key in keys.items()
    ]
    return read_back[0].unionByName(read_back[1]).unionByName(read_back[2])


@query(
    "bronze_stream",
    """SELECT 'table' AS part, o_orderkey AS key FROM orders
       UNION ALL SELECT 'table', o_orderkey + 1000000000 FROM orders WHERE o_orderstatus = 'F'
       UNION ALL SELECT 'table', o_orderkey + 2000000000 FROM orders WHERE o_orderstatus = 'F'
       UNION ALL SELECT 'archived rows',
                        (SELECT count(*) FROM orders)
                        + 2 * (SELECT count(*) FROM orders WHERE o_orderstatus = 'F')
       UNION ALL SELECT 'left in the landing', 0""",
)
def bronze_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sweeps with an archive: new files, then one file name twice with different rows.

    The archive holds every row that was landed, and nothing stays behind.
    """
    source = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("long"), "o_orderstatus")
    root = scratch_path(spark, "stream")
    landing, bronze, archive = f"{root}/landing", f"{root}/bronze", f"{root}/archive"
    csv = {"file_format": "csv", "options": {"header": True}, "schema": source.schema}
    sweep = {**csv, "file_pattern": "*", "archive_path": archive, "max_files_per_batch": 8}
    early = F.col("o_orderkey") % 3 == 0
    finished = source.filter("o_orderstatus = 'F'")
    for shift, name, rows in (
        (0, "day1", source.filter(early)),
        (0, "day2", source.filter(~early)),
        (1_000_000_000, "export", finished),
        (2_000_000_000, "export", finished),
    ):
        shifted = rows.withColumn("o_orderkey", F.col("o_orderkey") + shift)
        land(shifted, f"{landing}/{name}", "csv")
        ingest_stream(spark, landing, bronze, **sweep)
    archived = spark.read.schema(source.schema).csv(archive, header=True)
    left = paths.matching_files(spark, f"{landing}/*")
    rows = read_table(spark, bronze).select(F.lit("table").alias("part"), F.col("o_orderkey").alias("key"))
    counted = archived.agg(F.lit("archived rows").alias("part"), F.count(F.lit(1)).alias("key"))
    behind = spark.range(1).select(F.lit("left in the landing").alias("part"), F.lit(len(left)).alias("key"))
    return rows.unionByName(counted).unionByName(behind)


@query(
    "sink_append_compact",
    "SELECT o_orderkey, o_totalprice FROM orders",
)
def sink_append_compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Appends, a packing, a further append, and a repeated batch: every row once."""
    source = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    target = scratch_path(spark, "append-compact")
    part = F.pmod(F.xxhash64("o_orderkey"), F.lit(4))
    batch = batch_name("stream", 0)
    write_table(source.filter(part == 0), target, "append", segment=batch)
    write_table(source.filter(part == 1), target, "append")
    write_table(source.filter(part == 2), target, "append")
    compact(spark, target)
    write_table(source.filter(part == 3), target, "append")
    write_table(source.filter(part == 0), target, "append", segment=batch)
    return read_table(spark, target)


@query("sink_append", "SELECT * FROM lineitem")
def sink_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = table(spark, sf_dir, "lineitem")
    target = scratch_path(spark, "append")
    returned = F.col("l_returnflag") == "R"
    write_table(source.filter(returned), target, "append")
    write_table(source.filter(~returned), target, "append")
    return read_table(spark, target)


@query(
    "sink_overwrite",
    """SELECT o_orderkey, o_totalprice, o_orderstatus = 'F' AS finished
       FROM orders WHERE o_totalprice >= 1000""",
)
def sink_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table replaced, schema included, by a query over itself."""
    target = scratch_path(spark, "overwrite")
    write_table(table(spark, sf_dir, "orders"), target, "overwrite")
    narrowed = read_table(spark, target).filter("o_totalprice >= 1000")
    replaced = narrowed.selectExpr(
        "o_orderkey", "o_totalprice", "o_orderstatus = 'F' AS finished"
    )
    write_table(replaced, target, "overwrite")
    return read_table(spark, target)


@query(
    "sink_merge_schema",
    """SELECT c_custkey, c_name,
              CASE WHEN c_mktsegment <> 'BUILDING' THEN c_acctbal END AS c_acctbal
       FROM customer""",
)
def sink_merge_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second append brings a column the first did not have."""
    source = table(spark, sf_dir, "customer")
    target = scratch_path(spark, "merge")
    building = F.col("c_mktsegment") == "BUILDING"
    write_table(source.filter(building).select("c_custkey", "c_name"), target, "append")
    later = source.filter(~building).select("c_custkey", "c_name", "c_acctbal")
    write_table(later, target, "append")
    return read_table(spark, target)
