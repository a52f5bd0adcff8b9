"""Profiles that grow with their table: moments and bin counts by batch, merged without the rows.

Each appended batch leaves a row a column; the profile of the whole table is a merge of those
rows, so a grown table is not read again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrane.functions.columns import column, missing, type_of

PART = "column string, count bigint, mean double, m2 double, low double, high double, bins array<bigint>"


def _binned(value: Column, edges: Sequence[float]) -> Column:
    """Counts between fixed edges; the last bin has both its edges, and what lies outside
    comes first (below) and last (above)."""
    within = [(value >= low) & (value < high) for low, high in zip(edges, edges[1:])]
    if within:
        within[-1] = (value >= edges[-2]) & (value <= edges[-1])
        within = [value < edges[0], *within, value > edges[-1]]
    return F.array(*[F.count_if(one) for one in within]) if within else F.array().cast("array<bigint>")


def profile_part(
    df: DataFrame, columns: Sequence[str], edges: Mapping[str, Sequence[float]] | None = None
) -> DataFrame:
    """A row a numeric column of one batch, in one pass. NULL and NaN are missing."""
    values = {
        name: F.when(~missing(name, type_of(df, name)), column(name).cast("double")) for name in columns
    }
    rows = [
        F.struct(
            F.lit(name).alias("column"),
            F.count(value).alias("count"),
            F.avg(value).alias("mean"),
            (F.var_pop(value) * F.count(value)).alias("m2"),
            F.min(value).alias("low"),
            F.max(value).alias("high"),
            _binned(value, (edges or {}).get(name, ())).alias("bins"),
        )
        for name, value in values.items()
    ]
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def merged_profile(parts: DataFrame) -> DataFrame:
    """The parts' rows of each column as one, as if the batches had been one.

    Squares about the common mean are those about each part's own mean and the part's rows
    times its mean's squared distance, so no large sums are subtracted from each other. Parts
    of a column need the same edges.
    """
    some = parts.filter("count > 0")
    weight = F.sum("count").cast("double")
    whole = some.groupBy("column").agg((F.sum(F.col("mean") * F.col("count")) / weight).alias("center"))
    beside = F.col("m2") + F.col("count") * (F.col("mean") - F.col("center")) ** 2
    about = some.join(whole, "column").groupBy("column").agg(F.first("center").alias("mean"), F.sum(beside).alias("m2"))
    places = parts.select("column", F.posexplode_outer("bins").alias("bin", "rows"))
    bins = places.groupBy("column", "bin").agg(F.sum("rows").alias("rows"))
    listed = F.array_sort(F.collect_list(F.when(F.col("bin").isNotNull(), F.struct("bin", "rows"))))
    counts = bins.groupBy("column").agg(F.transform(listed, lambda one: one["rows"]).alias("bins"))
    ends = parts.groupBy("column").agg(
        F.sum("count").alias("count"), F.min("low").alias("low"), F.max("high").alias("high")
    )
    merged = ends.join(about, "column", "left").join(counts, "column")
    return merged.select("column", "count", "mean", "m2", "low", "high", "bins")


def described(profile: DataFrame, digits: int = 3) -> DataFrame:
    """column, count, mean, std, min and max, rounded."""
    spread = F.when(F.col("count") > 1, F.sqrt(F.col("m2") / (F.col("count") - 1)))
    measures = {"mean": F.col("mean"), "std": spread, "min": F.col("low"), "max": F.col("high")}
    return profile.select("column", "count", *[F.round(m, digits).alias(name) for name, m in measures.items()])
