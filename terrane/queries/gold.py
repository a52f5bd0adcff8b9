"""Join chains, projections and group-by aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrane.operators.joins import join_chain, join_tables
from terrane.operators.quantiles import exact_quantiles
from terrane.operators.shaping import aggregate, project, shape
from terrane.operators.sketches import estimates, merged, sketched
from terrane.queries.registry import customers, items, orders, products, query, table
from terrane.session import scratch_path
from terrane.sources.tables import read_table, write_table

FEATURES = [
    "order_id",
    "customer_id",
    "c_mktsegment",
    "c_nationkey",
    "l_extendedprice",
    "l_quantity",
    "p_retailprice",
    "p_brand",
    "o_orderdate",
    "l_shipdate",
    "datediff(l_shipdate, o_orderdate) AS actual_delay_days",
]

FEATURES_SQL = """
    SELECT o_orderkey AS order_id, o_custkey AS customer_id, c_mktsegment, c_nationkey,
           l_extendedprice, l_quantity, p_retailprice, p_brand, o_orderdate, l_shipdate,
           date_diff('day', o_orderdate, l_shipdate) AS actual_delay_days
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey
    LEFT JOIN customer ON o_custkey = c_custkey
    LEFT JOIN part ON l_partkey = p_partkey"""


def joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_chain(
        orders(spark, sf_dir),
        [
            (items(spark, sf_dir), ["order_id"], "inner"),
            (customers(spark, sf_dir), ["customer_id"], "left"),
            (products(spark, sf_dir), ["product_id"], "left"),
        ],
    )


@query("gold_features", FEATURES_SQL)
def gold_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(joined(spark, sf_dir), FEATURES)


FAR = 1_000_000_000_000  # no key of the tables comes near it


def wealthy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers; those in debt under a key that no order has."""
    found = customers(spark, sf_dir).select("customer_id", "c_name", "c_acctbal")
    return found.withColumn("customer_id", F.expr(f"customer_id + if(c_acctbal <= 0, {FAR}L, 0L)"))


def finished(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders; those not finished under a key that no customer has."""
    found = orders(spark, sf_dir).select("customer_id", "order_id", "o_totalprice", "o_orderstatus")
    shifted = F.expr(f"customer_id + if(o_orderstatus <> 'F', {2 * FAR}L, 0L)")
    return found.withColumn("customer_id", shifted).drop("o_orderstatus")


_SIDES = f"""
    WITH f AS (SELECT o_custkey + CASE WHEN o_orderstatus <> 'F' THEN {2 * FAR} ELSE 0 END
                      AS customer_id, o_orderkey AS order_id, o_totalprice FROM orders),
         w AS (SELECT c_custkey + CASE WHEN c_acctbal <= 0 THEN {FAR} ELSE 0 END AS customer_id,
                      c_name, c_acctbal FROM customer)"""
# Outer joins leave gaps in the order id; as a double it has one spelling of "absent".
_ALL = "customer_id, order_id::DOUBLE AS order_id, o_totalprice, c_name, c_acctbal"


def _variant(how: str, skew: str = "auto"):
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        left, right = finished(spark, sf_dir), wealthy(spark, sf_dir)
        rows = join_tables(left, right, ["customer_id"], how, skew=skew)
        return rows.withColumn("order_id", F.col("order_id").cast("double"))

    return build


for _how in ("left", "right", "full"):
    _sql = f"{_SIDES} SELECT {_ALL} FROM f {_how} JOIN w USING (customer_id)"
    query(f"gold_join_{_how}", _sql)(_variant(_how))
    # The hot-key form of the same join must give the same rows.
    query(f"gold_join_{_how}_hot", _sql)(_variant(_how, skew="on"))
# A keyed "cross" is what the key list makes it: an inner equi-join.
query("gold_join_cross", f"{_SIDES} SELECT {_ALL} FROM f JOIN w USING (customer_id)")(
    _variant("cross")
)
for _how in ("semi", "anti"):
    query(
        f"gold_join_{_how}",
        f"""{_SIDES} SELECT customer_id, order_id::DOUBLE AS order_id, o_totalprice
            FROM f {_how} JOIN w USING (customer_id)""",
    )(_variant(f"left_{_how}"))


@query(
    "gold_join_inner",
    """SELECT o_orderkey AS order_id, o_totalprice, l_linenumber, l_extendedprice
       FROM orders JOIN lineitem ON o_orderkey = l_orderkey""",
)
def gold_join_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = join_tables(orders(spark, sf_dir), items(spark, sf_dir), ["order_id"], "inner")
    return both.select("order_id", "o_totalprice", "l_linenumber", "l_extendedprice")


@query(
    "gold_join_multikey",
    """SELECT a.l_orderkey AS order_id, a.l_linenumber, a.l_quantity,
              coalesce(b.lines, 0) AS lines, b.total_quantity
       FROM lineitem a LEFT JOIN (
         SELECT l_orderkey, l_linenumber, count(*) AS lines, sum(l_quantity) AS total_quantity
         FROM lineitem WHERE l_returnflag <> 'R' GROUP BY ALL) b
       ON a.l_orderkey = b.l_orderkey AND a.l_linenumber = b.l_linenumber""",
)
def gold_join_multikey(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = items(spark, sf_dir)
    kept = lines.filter("l_returnflag <> 'R'").groupBy("order_id", "l_linenumber")
    sums = kept.agg(
        F.count(F.lit(1)).alias("lines"), F.sum("l_quantity").alias("total_quantity")
    )
    both = join_tables(lines, sums, ["order_id", "l_linenumber"], "left")
    return both.select(
        "order_id",
        "l_linenumber",
        "l_quantity",
        F.coalesce("lines", F.lit(0)).alias("lines"),
        "total_quantity",
    )


@query(
    "gold_passthrough",
    """SELECT o_custkey AS customer_id, o_orderkey AS order_id, o_orderstatus, o_totalprice,
              o_orderdate, o_orderpriority, c_name, c_nationkey, c_acctbal, c_mktsegment
       FROM orders LEFT JOIN customer ON o_custkey = c_custkey""",
)
def gold_passthrough(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = join_chain(
        orders(spark, sf_dir), [(customers(spark, sf_dir), ["customer_id"], "left")]
    )
    return shape(both)


@query(
    "gold_group_agg",
    """SELECT o_orderstatus, count(o_custkey) AS o_custkey_count
       FROM orders GROUP BY o_orderstatus""",
)
def gold_group_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape(
        table(spark, sf_dir, "orders"),
        group_by=["o_orderstatus"],
        aggregations={"o_custkey": "count"},
    )


@query(
    "gold_agg_functions",
    """SELECT l_returnflag, l_linestatus, sum(l_quantity) AS l_quantity_sum,
              min(l_extendedprice) AS l_extendedprice_min, max(l_shipdate) AS l_shipdate_max,
              round(avg(l_tax), 8) AS l_tax_avg, round(stddev(l_discount), 8) AS l_discount_stddev,
              count(*) AS all_count
       FROM lineitem GROUP BY l_returnflag, l_linestatus""",
)
def gold_agg_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = aggregate(
        table(spark, sf_dir, "lineitem"),
        ["l_returnflag", "l_linestatus"],
        {
            "l_quantity": "sum",
            "l_extendedprice": "min",
            "l_shipdate": "max",
            "l_tax": "avg",
            "l_discount": "stddev",
            "*": "count",
        },
    )
    return measured.withColumns(
        {name: F.round(name, 8) for name in ("l_tax_avg", "l_discount_stddev")}
    )


@query(
    "gold_join_agg",
    """SELECT c_mktsegment, p_brand, count(l_linenumber) AS l_linenumber_count,
              sum(l_quantity) AS l_quantity_sum
       FROM orders JOIN lineitem ON o_orderkey = l_orderkey
       LEFT JOIN customer ON o_custkey = c_custkey
       LEFT JOIN part ON l_partkey = p_partkey
       GROUP BY c_mktsegment, p_brand""",
)
def gold_join_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape(
        joined(spark, sf_dir),
        group_by=["c_mktsegment", "p_brand"],
        aggregations={"l_linenumber": "count", "l_quantity": "sum"},
    )


@query(
    "gold_sql_functions",
    """SELECT event_id, upper(event_type) AS kind, length(props) AS props_length,
              json_extract_string(props, '$.k') AS k,
              year(ts) * 100 + month(ts) AS year_month, dayofyear(ts) AS day_of_year,
              CASE WHEN value > 50 THEN 'high' ELSE 'low' END AS level,
              round(sqrt(abs(value)), 6) AS root, greatest(value, 10.0) AS at_least_ten,
              len(string_split(event_type, 'c')) AS pieces,
              coalesce(nullif(event_type, 'view'), 'seen') AS renamed
       FROM events""",
)
def gold_sql_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """String, JSON, date, conditional, math and array functions as pass-through text."""
    return project(
        table(spark, sf_dir, "events"),
        [
            "event_id",
            "upper(event_type) AS kind",
            "length(props) AS props_length",
            "get_json_object(props, '$.k') AS k",
            "year(ts) * 100 + month(ts) AS year_month",
            "dayofyear(ts) AS day_of_year",
            "CASE WHEN value > 50 THEN 'high' ELSE 'low' END AS level",
            "round(sqrt(abs(value)), 6) AS root",
            "greatest(value, 10.0D) AS at_least_ten",
            "size(split(event_type, 'c')) AS pieces",
            "coalesce(nullif(event_type, 'view'), 'seen') AS renamed",
        ],
    )


@query(
    "gold_quantiles",
    """SELECT l_returnflag, l_linestatus, round(quantile_cont(l_extendedprice, 0.25), 6) AS low,
              round(quantile_cont(l_extendedprice, 0.5), 6) AS middle,
              round(quantile_cont(l_extendedprice, 0.999), 6) AS high
       FROM lineitem GROUP BY ALL""",
)
def gold_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact quantiles of groups that hold a third of all rows and more."""
    found = exact_quantiles(
        table(spark, sf_dir, "lineitem"),
        ["l_returnflag", "l_linestatus"],
        "l_extendedprice",
        {"low": 0.25, "middle": 0.5, "high": 0.999},
    )
    return found.select("l_returnflag", "l_linestatus", *[F.round(c, 6).alias(c) for c in ("low", "middle", "high")])


@query(
    "gold_agg_sketch",
    """SELECT o_orderstatus, count(*) AS rows, true AS distinct_within_five_percent,
              true AS ranks_within_three_percent FROM orders GROUP BY o_orderstatus""",
)
def gold_agg_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches appended for two batches, merged, and held against exact counts and ranks."""
    source, target = table(spark, sf_dir, "orders"), scratch_path(spark, "sketches")
    early = F.col("o_orderdate") < F.lit("1995-01-01")
    group, distinct, quantiles = ["o_orderstatus"], ["o_custkey"], ["o_totalprice"]
    for batch in (source.filter(early), source.filter(~early)):
        write_table(sketched(batch, group, distinct, quantiles), target, "append")
    told = estimates(
        merged(read_table(spark, target), group, distinct, quantiles), group, distinct, quantiles, [0.25, 0.5, 0.9]
    )
    exact = source.groupBy(*group).agg(F.countDistinct("o_custkey").alias("customers"))
    ranks = source.join(told, group).groupBy(*group).agg(
        *[F.avg((F.col("o_totalprice") <= F.col("o_totalprice_quantiles")[k]).cast("double")).alias(f"rank{k}") for k in range(3)]
    )
    close = [F.abs(F.col(f"rank{k}") - p) <= 0.03 for k, p in enumerate((0.25, 0.5, 0.9))]
    return told.join(exact, group).join(ranks, group).select(
        *group,
        "rows",
        (F.abs(F.col("o_custkey_distinct") / F.col("customers") - 1) <= 0.05).alias("distinct_within_five_percent"),
        (close[0] & close[1] & close[2]).alias("ranks_within_three_percent"),
    )
