"""Exact quantiles of any number of groups, however large a group is."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrane.functions.columns import column
from terrane.operators.numbering import running_total


def exact_quantiles(
    df: DataFrame, group_by: Sequence[str], measure: str, probabilities: Mapping[str, float]
) -> DataFrame:
    """The group columns and, by name, quantiles of a numeric column, interpolated linearly.

    Values are counted by group, sorted by range over (group, value) and given the number of
    rows before them, so a group with a third of all rows is spread over as many tasks as its
    values fill. The values around each position then meet in one map-side aggregate. NULL and
    NaN do not count; a group without other values is left out. NULL is a group of its own.
    """
    for name, p in probabilities.items():
        if not 0 <= p <= 1:
            raise ValueError(f"probability {name!r} is {p}, not within 0 and 1")
    groups = [f"g{k}" for k in range(len(group_by))]
    values = df.select(*[column(c).alias(g) for c, g in zip(group_by, groups)], column(measure).cast("double").alias("value"))
    counts = values.dropna(subset=["value"]).groupBy(*groups, "value").agg(F.count(F.lit(1)).alias("rows"))
    placed = running_total(counts, [F.col(c) for c in (*groups, "value")], F.col("rows"), "before")
    spans = placed.groupBy(*groups).agg(F.min("before").alias("first"), F.sum("rows").alias("n"))
    spans = spans.toDF(*[f"s{g}" for g in groups], "first", "n")
    same = reduce(and_, [F.col(g).eqNullSafe(F.col(f"s{g}")) for g in groups], F.lit(True))
    inside = placed.join(spans, same).withColumn("start", F.col("before") - F.col("first"))

    def at(index):
        return F.max(F.when((F.col("start") <= index) & (index < F.col("start") + F.col("rows")), F.col("value")))

    found, results = [], []
    for k, (name, p) in enumerate(probabilities.items()):
        position = F.lit(float(p)) * (F.col("n") - 1)
        found += [at(F.floor(position)).alias(f"low{k}"), at(F.ceil(position)).alias(f"high{k}")]
        found.append(F.max(position - F.floor(position)).alias(f"part{k}"))
        between = F.col(f"low{k}") + (F.col(f"high{k}") - F.col(f"low{k}")) * F.col(f"part{k}")
        results.append(between.alias(name))
    named = [F.col(g).alias(c) for c, g in zip(group_by, groups)]
    return inside.groupBy(*groups).agg(*found).select(*named, *results)
