"""Numeric summaries and histograms over whole tables."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terrane.functions.columns import bin_index, column, missing, type_of
from terrane.sources.tables import small_frame

# The quartiles a summary reports.
QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}

# Of each quantile sketch: one per task reaches the merge, so it is kept small.
_ACCURACY = 1_000
_SLACK = 4.0
# Rows that may lie strictly inside a bracket when its values are ranked in one task.
_MAX_INSIDE = 1_000_000


@dataclass
class _Bracket:
    """A closed value interval of a column and the wanted 0-based ranks looked for in it."""

    column: str
    low: float
    high: float
    ranks: list[int]
    below: int = 0  # rows under the interval
    at_low: int = 0
    inside: int = 0  # rows strictly between the edges
    at_high: int = 0
    accuracy: int = field(default_factory=lambda: _ACCURACY)

    def settle(self, found: dict[tuple[str, int], float]) -> None:
        """Ranks that fall on an edge are answered by the counts alone."""
        first_inside = self.below + self.at_low
        first_high = first_inside + self.inside
        for rank in self.ranks:
            if rank < first_inside:
                found[self.column, rank] = self.low
            elif rank >= first_high:
                found[self.column, rank] = self.high
        self.ranks = [r for r in self.ranks if first_inside <= r < first_high]

    def holds_all(self) -> bool:
        rows = self.at_low + self.inside + self.at_high
        return all(0 <= rank - self.below < rows for rank in self.ranks)


def _numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns as doubles, NaN turned into NULL: both are missing here."""
    return df.select(
        *[
            F.when(~missing(c, type_of(df, c)), column(c).cast("double")).alias(f"c{i}")
            for i, c in enumerate(columns)
        ]
    )


def summary(df: DataFrame, columns: Sequence[str], digits: int = 3) -> DataFrame:
    """count, mean, std, min, quartiles and max per column, with exact quartiles."""
    numbers = _numbers(df, columns)
    row = numbers.agg(
        *[
            measure
            for name in numbers.columns
            for measure in (
                F.count(name).alias(f"{name}_count"),
                F.avg(name).alias(f"{name}_mean"),
                F.stddev_samp(name).alias(f"{name}_std"),
                F.min(name).alias(f"{name}_min"),
                F.max(name).alias(f"{name}_max"),
            )
        ]
    ).first()
    brackets = []
    for name in numbers.columns:
        if total := row[f"{name}_count"]:
            at = [(total - 1) * share for share in QUARTILES.values()]
            ranks = sorted({f(position) for position in at for f in (math.floor, math.ceil)})
            edges = row[f"{name}_min"], row[f"{name}_max"]
            brackets.append(_Bracket(name, *edges, ranks, inside=total))
    found = _values_at(numbers, brackets)
    lines = []
    for source, name in zip(columns, numbers.columns):
        total = row[f"{name}_count"]
        measures = [row[f"{name}_mean"], row[f"{name}_std"], row[f"{name}_min"]]
        measures += [_interpolate(found, name, (total - 1) * q) for q in QUARTILES.values()]
        measures.append(row[f"{name}_max"])
        lines.append((source, total, *measures))
    return _summary_frame(df.sparkSession, lines, digits)


def _summary_frame(spark: SparkSession, lines: list[tuple], digits: int) -> DataFrame:
    measures = ["mean", "std", "min", *QUARTILES, "max"]
    schema = "column string, count bigint, " + ", ".join(f"{m} double" for m in measures)
    frame = small_frame(spark, lines, schema)
    return frame.withColumns({m: F.round(m, digits) for m in measures})


def _interpolate(
    found: dict[tuple[str, int], float], name: str, position: float
) -> float | None:
    if position < 0:
        return None
    lower, upper = found[name, math.floor(position)], found[name, math.ceil(position)]
    return lower + (upper - lower) * (position - math.floor(position))


def _values_at(
    numbers: DataFrame, brackets: list[_Bracket]
) -> dict[tuple[str, int], float]:
    """Exact values at the wanted ranks, without sorting or gathering a column.

    While a bracket strictly holds many rows, a quantile sketch of those rows alone
    proposes narrower ones and a counting pass confirms them; each round cuts the rows
    inside by about the sketch accuracy. A very common value ends up on an edge, where
    the counts alone give the answer. What is left is small enough to rank exactly.
    """
    found: dict[tuple[str, int], float] = {}
    narrow = [b for b in brackets if b.inside <= _MAX_INSIDE]
    wide = _counted(numbers, [b for b in brackets if b.inside > _MAX_INSIDE])
    while wide:
        for bracket in wide:
            bracket.settle(found)
        narrow += [b for b in wide if b.ranks and b.inside <= _MAX_INSIDE]
        wide = [b for b in wide if b.ranks and b.inside > _MAX_INSIDE]
        proposals = _proposed(numbers, wide) if wide else []
        _counted(numbers, [new for _, new in proposals])
        wide = [
            new if new.holds_all() else replace(old, ranks=new.ranks, accuracy=old.accuracy * 4)
            for old, new in proposals
        ]
    return found | _ranked(numbers, narrow)


def _counted(numbers: DataFrame, brackets: list[_Bracket]) -> list[_Bracket]:
    """Fill in how many rows lie below, on and between the edges: one pass for all."""
    if not brackets:
        return brackets
    measures = []
    for i, b in enumerate(brackets):
        value = F.col(b.column)
        measures += [
            F.count_if(value < b.low).alias(f"below{i}"),
            F.count_if(value == b.low).alias(f"low{i}"),
            F.count_if((value > b.low) & (value < b.high)).alias(f"inside{i}"),
            F.count_if((value == b.high) & (value > b.low)).alias(f"high{i}"),
        ]
    row = numbers.agg(*measures).first()
    for i, b in enumerate(brackets):
        b.below, b.at_low = row[f"below{i}"], row[f"low{i}"]
        b.inside, b.at_high = row[f"inside{i}"], row[f"high{i}"]
    return brackets


def _proposed(
    numbers: DataFrame, brackets: list[_Bracket]
) -> list[tuple[_Bracket, _Bracket]]:
    """Narrower brackets, one per run of neighbouring ranks, from a sketch of the inside."""
    jobs, sketches = [], []
    for i, b in enumerate(brackets):
        runs: list[list[int]] = []
        for rank in b.ranks:
            if runs and rank - runs[-1][-1] <= 1:
                runs[-1].append(rank)
            else:
                runs.append([rank])
        slack, first = _SLACK / b.accuracy, b.below + b.at_low
        near = []
        for run in runs:
            near.append(max(0.0, (run[0] - first) / b.inside - slack))
            near.append(min(1.0, (run[-1] - first) / b.inside + slack))
        inner = F.when((F.col(b.column) > b.low) & (F.col(b.column) < b.high), F.col(b.column))
        sketches.append(F.percentile_approx(inner, near, b.accuracy).alias(f"near{i}"))
        jobs.append((b, runs))
    row = numbers.agg(*sketches).first()
    return [
        (b, replace(b, ranks=run, low=row[f"near{i}"][2 * j], high=row[f"near{i}"][2 * j + 1]))
        for i, (b, runs) in enumerate(jobs)
        for j, run in enumerate(runs)
    ]


def _ranked(numbers: DataFrame, brackets: list[_Bracket]) -> dict[tuple[str, int], float]:
    """Count the distinct values left in each bracket and pick the ones at the ranks.

    A bracket has at most ``_MAX_INSIDE`` rows besides its edges, and repeats combine
    before the shuffle, so each window below is small whatever the table's size.
    """
    if not brackets:
        return {}
    hits = [
        item
        for i, b in enumerate(brackets)
        for item in (
            F.lit(i),
            F.when(F.col(b.column).between(b.low, b.high), F.col(b.column)),
        )
    ]
    counted = (
        numbers.select(F.stack(F.lit(len(brackets)), *hits).alias("bracket", "value"))
        .filter(F.col("value").isNotNull())
        .groupBy("bracket", "value")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    upto = F.sum("rows").over(Window.partitionBy("bracket").orderBy("value"))
    wanted = F.create_map(
        *[
            item
            for i, b in enumerate(brackets)
            for item in (F.lit(i), F.array(*[F.lit(r - b.below) for r in b.ranks]))
        ]
    )
    at = (
        counted.withColumn("upto", upto)
        .withColumn("position", F.explode(wanted[F.col("bracket")]))
        .filter(F.col("position").between(F.col("upto") - F.col("rows"), F.col("upto") - 1))
    )
    return {  # one row per wanted rank
        (brackets[r["bracket"]].column, r["position"] + brackets[r["bracket"]].below): r["value"]
        for r in at.collect()
    }


def histogram(df: DataFrame, name: str, bins: int = 50) -> DataFrame:
    """Equal-width counts between the column's minimum and maximum, empty bins included.

    Takes two passes: one row of bounds, then counts that combine map-side, so nothing
    larger than ``bins`` rows is shuffled.
    """
    present = df.filter(~missing(name, type_of(df, name)))
    values = present.select(column(name).cast("double").alias("value"))
    low, high = values.agg(F.min("value"), F.max("value")).first()
    every = df.sparkSession.range(0 if low is None else bins)
    if low is None:
        low = high = 0.0
    if low == high:
        low, high = low - 0.5, high + 0.5
    counted = values.groupBy(
        bin_index(F.col("value"), F.lit(low), F.lit(high), bins).alias("bin")
    ).agg(F.count(F.lit(1)).alias("rows"))
    edge, width = F.col("bin").cast("double"), (high - low) / bins
    return (
        every.select(F.col("id").cast("int").alias("bin"))
        .join(counted, "bin", "left")
        .select(
            "bin",
            (F.lit(low) + F.lit(width) * edge).alias("bin_start"),
            (F.lit(low) + F.lit(width) * (edge + 1)).alias("bin_end"),
            F.coalesce("rows", F.lit(0)).alias("rows"),
        )
    )
