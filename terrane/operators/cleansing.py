"""Impute, de-duplicate and drop incomplete rows, in that order."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrane.functions.columns import INGESTED_AT, column, ordered, quoted, type_of
from terrane.sources.tables import stage

_RANK = "__rank"


def impute(df: DataFrame, constants: Mapping[str, Any] | None) -> DataFrame:
    """Replace NULL and NaN per column by a constant of the column's type."""
    return df.fillna(dict(constants)) if constants else df


def deduplicate(
    df: DataFrame, keys: Sequence[str] | None, order_by: Sequence[Column] | None = None
) -> DataFrame:
    """Keep one row per key; equal NULL keys form one group.

    The survivor is the first under ``order_by`` (latest ingest first when the lineage
    column is there), with every other column as tie-break, so a retried task keeps the
    same row. Spark runs ``row_number() = 1`` as a group limit *before* the shuffle: a
    key holding a third of the table sends at most one row per map task.
    """
    if not keys:
        return df
    order = list(order_by or ())
    if order_by is None and INGESTED_AT in df.columns:
        order.append(F.col(INGESTED_AT).desc())
    order += [ordered(c, type_of(df, c)) for c in df.columns if c not in keys]
    if not order:
        return df.dropDuplicates(list(keys))
    window = Window.partitionBy(*[column(k) for k in keys]).orderBy(*order)
    ranked = df.withColumn(_RANK, F.row_number().over(window))
    return ranked.filter(F.col(_RANK) == 1).drop(_RANK)


def unseen(df: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys no known row has; equal NULL keys count as equal.

    Only the known rows' key columns are read, and of these only keys that the new rows have
    are kept, distinct and staged: where the new keys are few, Spark sends them to the known
    rows and shuffles none of those. The rows themselves then meet that short list.
    """
    names = [f"k{n}" for n in range(len(keys))]
    new = df.select(*[column(k).alias(f"n{n}") for n, k in enumerate(keys)]).distinct()
    old = known.select(*[column(k).alias(name) for name, k in zip(names, keys)])
    shared = old.join(new, _same(names, [f"n{n}" for n in range(len(keys))]), "left_semi").distinct()
    shared, _ = stage(shared, "shared-keys")
    own = [df[quoted(k)] for k in keys]
    return df.join(shared, reduce(and_, [a.eqNullSafe(F.col(b)) for a, b in zip(own, names)]), "left_anti")


def _same(left: Sequence[str], right: Sequence[str]) -> Column:
    return reduce(and_, [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right)])


def drop_missing(df: DataFrame, columns: Sequence[str] | None) -> DataFrame:
    """Drop rows with NULL or NaN in any listed column."""
    return df.dropna(subset=list(columns)) if columns else df


def cleanse(
    df: DataFrame,
    fill_na: Mapping[str, Any] | None = None,
    drop_duplicates: Sequence[str] | None = None,
    drop_na_cols: Sequence[str] | None = None,
) -> DataFrame:
    return drop_missing(deduplicate(impute(df, fill_na), drop_duplicates), drop_na_cols)
