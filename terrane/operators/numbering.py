"""Places and running totals under a total order, with no task that sees all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrane.sources.tables import stage

_PART, _START, _WEIGHT = "__part", "__start", "__weight"


def running_total(df: DataFrame, order: Sequence[Column], weight: Column, name: str) -> DataFrame:
    """Add `name`: the sum of `weight`, a whole number, over the rows before each row.

    Rows are sorted by range partition and staged with the number of their partition; each
    partition is summed by itself and starts where those before it end, a prefix sum over a
    row per partition. The order has to be total for the totals to be repeatable.
    """
    weighed = df.withColumn(_WEIGHT, weight.cast("long"))
    placed, _ = stage(weighed.orderBy(*order).withColumn(_PART, F.spark_partition_id()), "running-total")
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    sums = placed.groupBy(_PART).agg(F.sum(_WEIGHT).alias("__sum"))
    starts = sums.select(_PART, F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias(_START))
    inside = Window.partitionBy(_PART).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    total = F.col(_START) + F.coalesce(F.sum(_WEIGHT).over(inside), F.lit(0))
    return placed.join(starts, _PART).withColumn(name, total).drop(_PART, _START, _WEIGHT)


def numbered(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Add `name`, the place of each row from 0."""
    return running_total(df, order, F.lit(1), name)
