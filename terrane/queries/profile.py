"""Summaries, histograms, samples and latest-row picks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrane.operators.increments import described, merged_profile, profile_part
from terrane.operators.profiling import histogram, summary
from terrane.operators.sampling import latest, latest_per_key, sample
from terrane.operators.scoring import residual_histogram, residuals
from terrane.queries.gold import FEATURES_SQL, gold_features
from terrane.queries.registry import query, table
from terrane.session import scratch_path
from terrane.sources.tables import read_table, write_table

_NUMERIC = [
    "l_extendedprice",
    "l_quantity",
    "p_retailprice",
    "actual_delay_days",
]

_SUMMARY = " UNION ALL ".join(
    f"""SELECT '{c}' AS column, count({c}) AS count, round(avg({c}), 3) AS mean,
               round(stddev_samp({c}), 3) AS std, round(min({c})::DOUBLE, 3) AS min,
               round(quantile_cont({c}::DOUBLE, 0.25), 3) AS p25,
               round(quantile_cont({c}::DOUBLE, 0.5), 3) AS p50,
               round(quantile_cont({c}::DOUBLE, 0.75), 3) AS p75,
               round(max({c})::DOUBLE, 3) AS max
        FROM g"""
    for c in _NUMERIC
)


def gold_table(spark: SparkSession, sf_dir: str, columns: list[str]) -> DataFrame:
    """The profiled columns as a written table: a profile takes several passes."""
    gold = scratch_path(spark, "gold")
    write_table(gold_features(spark, sf_dir).select(*columns), gold)
    return read_table(spark, gold)


@query("eda_summary", f"WITH g AS ({FEATURES_SQL}) {_SUMMARY}")
def eda_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary(gold_table(spark, sf_dir, _NUMERIC), _NUMERIC)


_MOMENTS = " UNION ALL ".join(
    f"""SELECT '{c}' AS column, count({c}) AS count, round(avg({c}), 3) AS mean,
               round(stddev_samp({c}), 3) AS std, round(min({c})::DOUBLE, 3) AS min,
               round(max({c})::DOUBLE, 3) AS max FROM lineitem"""
    for c in ("l_extendedprice", "l_quantity")
)


@query("eda_summary_merged", _MOMENTS)
def eda_summary_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches leave their moments in a table; the summary is merged from these alone."""
    source, parts = table(spark, sf_dir, "lineitem"), scratch_path(spark, "moments")
    for flag in ("l_returnflag = 'R'", "l_returnflag = 'A'", "l_returnflag NOT IN ('A', 'R')"):
        batch = source.filter(flag)
        write_table(profile_part(batch, ["l_extendedprice", "l_quantity"]), parts, "append")
    return described(merged_profile(read_table(spark, parts)))


def _bins(values: str) -> str:
    """Equal-width counts over 50 bins of the one column ``x`` of a subquery."""
    low, width = "(SELECT lo FROM b)", "(SELECT w FROM b)"
    return f"""
    WITH v AS ({values}),
         b AS (SELECT min(x) AS lo, (max(x) - min(x)) / 50 AS w FROM v),
         c AS (SELECT least(floor((x - {low}) / {width}), 49)::INTEGER AS bin, count(*) AS rows
               FROM v GROUP BY 1)
    SELECT r.bin::INTEGER AS bin, round({low} + {width} * r.bin, 6) AS bin_start,
           round({low} + {width} * (r.bin + 1), 6) AS bin_end, coalesce(c.rows, 0) AS rows
    FROM range(50) r(bin) LEFT JOIN c ON c.bin = r.bin"""


def _rounded(bins: DataFrame) -> DataFrame:
    return bins.withColumns({c: F.round(c, 6) for c in ("bin_start", "bin_end")})


@query("eda_histogram", _bins(f"SELECT actual_delay_days::DOUBLE AS x FROM ({FEATURES_SQL})"))
def eda_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = "actual_delay_days"
    return _rounded(histogram(gold_table(spark, sf_dir, [name]), name))


@query(
    "eda_sample",
    """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
       ORDER BY substr(md5('42:' || o_orderkey), 1, 8), o_orderkey LIMIT 5000""",
)
def eda_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    picked = sample(table(spark, sf_dir, "orders"), ["o_orderkey"], 5000, seed=42)
    return picked.select("o_orderkey", "o_custkey", "o_totalprice")


def predicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fixed linear guess at the line price, absent for returned lines."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey",
        "l_linenumber",
        "l_extendedprice AS actual",
        "CASE WHEN l_returnflag <> 'R' THEN l_quantity * 1500 + 10 END AS guess",
    )


_RESIDUALS = """
    SELECT l_orderkey, l_linenumber, l_extendedprice AS actual, l_quantity * 1500 + 10 AS guess,
           l_quantity * 1500 + 10 - l_extendedprice AS residual
    FROM lineitem WHERE l_returnflag <> 'R'"""


@query("score_residuals", _RESIDUALS)
def score_residuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return residuals(predicted(spark, sf_dir), "guess", "actual")


@query("score_residual_hist", _bins(f"SELECT residual AS x FROM ({_RESIDUALS})"))
def score_residual_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(residual_histogram(predicted(spark, sf_dir), "guess", "actual"))


def _newest_first():
    return [F.col("ts").desc(), F.col("event_id")]


@query(
    "latest_run",
    """SELECT event_id, ts, user_id, value FROM events
       WHERE event_type = 'purchase' ORDER BY ts DESC, event_id LIMIT 1""",
)
def latest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events stand in for a run log, purchases for finished runs."""
    log = table(spark, sf_dir, "events")
    newest = latest(log, "event_type = 'purchase'", _newest_first())
    return newest.select("event_id", "ts", "user_id", "value")


@query(
    "latest_per_key",
    """SELECT event_id, ts, user_id, value FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS rn
         FROM events WHERE event_type = 'purchase')
       WHERE rn = 1""",
)
def latest_of_each(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = table(spark, sf_dir, "events")
    newest = latest_per_key(log, ["user_id"], "event_type = 'purchase'", _newest_first())
    return newest.select("event_id", "ts", "user_id", "value")
