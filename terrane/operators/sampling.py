"""Splits, samples and latest-row picks that do not depend on partition layout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrane.functions.columns import column, hash_position, within_share

_POSITION = "__position"
_RANK = "__rank"


def split(
    df: DataFrame, keys: Sequence[str], train_share: float, seed: int
) -> tuple[DataFrame, DataFrame]:
    """Disjoint, complete train and test parts; membership depends only on seed and keys."""
    placed = df.withColumn(_POSITION, hash_position(seed, keys))
    inside = within_share(F.col(_POSITION), train_share)
    return placed.filter(inside).drop(_POSITION), placed.filter(~inside).drop(_POSITION)


def sample(df: DataFrame, keys: Sequence[str], rows: int, seed: int) -> DataFrame:
    """At most ``rows`` rows, the first in salted-hash order.

    One pass: each task keeps its first ``rows``, and one task merges these, so it is meant
    for samples that a person or a plot looks at.
    """
    placed = df.withColumn(_POSITION, hash_position(seed, keys))
    order = [F.col(_POSITION), *[column(k) for k in keys]]
    return placed.orderBy(*order).limit(rows).drop(_POSITION)


def latest(df: DataFrame, condition: str, order_by: Sequence[Column]) -> DataFrame:
    """The single newest row that meets the condition."""
    return df.filter(condition).orderBy(*order_by).limit(1)


def latest_per_key(
    df: DataFrame, keys: Sequence[str], condition: str, order_by: Sequence[Column]
) -> DataFrame:
    """The newest qualifying row of every key, cut to one per key before the shuffle."""
    window = Window.partitionBy(*[column(k) for k in keys]).orderBy(*order_by)
    ranked = df.filter(condition).withColumn(_RANK, F.row_number().over(window))
    return ranked.filter(F.col(_RANK) == 1).drop(_RANK)
