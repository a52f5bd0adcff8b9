"""Registration of queries and shared access to the input tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from terrane.session import prepare

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without SQL only its rows can be looked at."""

    def register(build: Query) -> Query:
        @wraps(build)
        def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")  # as the checking SQL runs
            return build(prepare(spark), sf_dir)

        QUERIES[name] = prepared
        if sql is not None:
            ORACLES[name] = sql
        return prepared

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the key names the joins share."""
    return table(spark, sf_dir, "orders").withColumnsRenamed(
        {"o_orderkey": "order_id", "o_custkey": "customer_id"}
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").withColumnsRenamed(
        {"l_orderkey": "order_id", "l_partkey": "product_id", "l_suppkey": "seller_id"}
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "customer_id")


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").withColumnRenamed("p_partkey", "product_id")
