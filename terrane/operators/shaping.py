"""What happens after the joins: projection, group-by, column naming."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrane.functions.columns import aggregate_alias


def project(df: DataFrame, expressions: Sequence[str]) -> DataFrame:
    """Any SQL select items."""
    return df.selectExpr(*expressions)


def aggregate(df: DataFrame, group_by: Sequence[str], aggregations: Mapping[str, str]) -> DataFrame:
    """``{column: function}`` per group, named ``<column>_<function>``."""
    measures = [
        F.expr(f"{function}({text})").alias(aggregate_alias(text, function))
        for text, function in aggregations.items()
    ]
    return df.groupBy(*group_by).agg(*measures)


def shape(
    df: DataFrame,
    select_expressions: Sequence[str] | None = None,
    group_by: Sequence[str] | None = None,
    aggregations: Mapping[str, str] | None = None,
) -> DataFrame:
    """Projection wins over aggregation; with neither, rows pass through."""
    if select_expressions:
        return project(df, select_expressions)
    if group_by and aggregations:
        return aggregate(df, group_by, aggregations)
    return df
