"""Categories of any number: labels as a joined table, and target statistics in their place.

Nothing here brings labels to the driver. Ranks come from a sort by range with prefix sums,
encodings from joins on the label, which Spark makes broadcasts where the table is small and
splits at run time where a label is hot.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrane.functions.columns import column, type_of
from terrane.operators.numbering import numbered
from terrane.sources.tables import stage

# Sums of targets are exact, so that they do not depend on the order of rows.
_EXACT = "decimal(38,9)"
_SMALL = (T.ByteType, T.ShortType, T.IntegerType)
_LABEL = "__label"


def _pairs(columns: Sequence[str]) -> list[Column]:
    """A row for each of the columns: its name, and its value as text."""
    pairs = [[F.lit(c).alias("feature"), column(c).cast("string").alias("label")] for c in columns]
    return pairs[0] if len(pairs) == 1 else [F.inline(F.array(*[F.struct(*pair) for pair in pairs]))]


def label_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, label, index, labels) of every value that is not NULL.

    Indexes count from 0 by falling frequency, ties in the order of the text; `labels` is how
    many the feature has.
    """
    counted = df.select(*_pairs(columns)).dropna().groupBy("feature", "label")
    placed = numbered(
        counted.agg(F.count(F.lit(1)).alias("rows")), [F.col("feature"), F.col("rows").desc(), F.col("label")], "place"
    )
    placed, _ = stage(placed, "labels")
    spans = placed.groupBy("feature").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("labels"))
    # A row a feature.
    joined = placed.join(F.broadcast(spans), "feature")
    return joined.select("feature", "label", (F.col("place") - F.col("first")).alias("index"), "labels")


def with_indexes(df: DataFrame, labels: DataFrame, columns: Sequence[str], suffix: str = "_indexed") -> DataFrame:
    """Add `<column>_indexed` as double; values that are NULL or unknown share the index behind
    the last label."""
    sizes = dict(labels.groupBy("feature").agg(F.max("labels")).collect())  # a row a feature
    for name in columns:
        known = labels.filter(F.col("feature") == name).select(F.col("label").alias(_LABEL), F.col("index").alias(name + suffix))
        keyed = df.withColumn(_LABEL, column(name).cast("string"))
        index = F.coalesce(column(name + suffix), F.lit(sizes.get(name, 0))).cast("double")
        df = keyed.join(known, _LABEL, "left").withColumn(name + suffix, index).drop(_LABEL)
    return df


def statistics_name(name: str) -> str:
    return f"{name}_target"


def _smoothed(total: Column, rows: Column, mean: Column, prior: float) -> Column:
    return (total.cast("double") + F.lit(float(prior)) * mean) / (rows + F.lit(float(prior)))


def fold_sums(df: DataFrame, columns: Sequence[str], target: str, fold: Column) -> DataFrame:
    """(feature, label, fold, rows, total) of the rows that have a target; staged."""
    # No number of rows adds up small whole numbers beyond a long, which is faster than a decimal.
    exact = "bigint" if isinstance(type_of(df, target), _SMALL) else _EXACT
    known = df.filter(column(target).isNotNull()).select(
        fold.alias("fold"), column(target).cast(exact).alias("value"), *_pairs(columns)
    )
    sums = known.groupBy("feature", "label", "fold")
    total = F.sum("value").cast(_EXACT).alias("total")
    return stage(sums.agg(F.count(F.lit(1)).alias("rows"), total), "fold-sums")[0]


def out_of_fold(
    df: DataFrame, sums: DataFrame, columns: Sequence[str], fold: Column, *, prior: float = 20.0
) -> DataFrame:
    """Add `<column>_target`: the mean target of the label in the other folds.

    It leans to the other folds' mean over all labels as if `prior` more rows had that; NULL
    is a label without rows. So no row's own target is in its features.
    """
    everything = sums.filter(F.col("feature") == columns[0])  # each row is in each feature once
    by_fold = everything.groupBy("fold").agg(F.sum("rows").alias("n"), F.sum("total").alias("s")).collect()
    n, s = sum(row["n"] for row in by_fold), sum(row["s"] for row in by_fold)
    means = [(row["fold"], float(s - row["s"]) / (n - row["n"])) for row in by_fold if n > row["n"]]
    mean = F.coalesce(*[F.when(F.col("__fold") == k, F.lit(value)) for k, value in means], F.lit(0.0))
    whole = sums.groupBy("feature", "label").agg(F.sum("rows").alias("n"), F.sum("total").alias("s"))
    others = sums.join(whole, ["feature", "label"]).select(
        "feature",
        F.col("label").alias(_LABEL),
        F.col("fold").alias("__fold"),
        (F.col("n") - F.col("rows")).alias("__rows"),
        (F.col("s") - F.col("total")).alias("__total"),
    )
    others, _ = stage(others, "out-of-fold")
    df = df.withColumn("__fold", fold)
    for name in columns:
        known = others.filter(F.col("feature") == name).drop("feature")
        keyed = df.withColumn(_LABEL, column(name).cast("string")).join(known, [_LABEL, "__fold"], "left")
        rows, total = F.coalesce("__rows", F.lit(0)), F.coalesce("__total", F.lit(0))
        df = keyed.withColumn(statistics_name(name), _smoothed(total, rows, mean, prior)).drop(_LABEL, "__rows", "__total")
    return df.drop("__fold")


def target_statistics(sums: DataFrame, columns: Sequence[str], *, prior: float = 20.0) -> TargetStatistics:
    """The encoding of new rows: label means over all folds; NULL and unknown get the mean."""
    everything = sums.filter(F.col("feature") == columns[0])
    n, s = everything.agg(F.sum("rows"), F.sum("total")).first()
    mean = float(s) / n if n else 0.0
    known = sums.filter("label IS NOT NULL").groupBy("feature", "label").agg(F.sum("rows").alias("n"), F.sum("total").alias("s"))
    table = known.select("feature", "label", _smoothed(F.col("s"), F.col("n"), F.lit(mean), prior).alias("value"))
    fitted = TargetStatistics(inputCols=list(columns), mean=mean)
    fitted.table, _ = stage(table, "target-statistics")
    return fitted


class _Writer(DefaultParamsWriter):
    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        self.instance.table.write.parquet(f"{path}/labels")


class _Reader(DefaultParamsReader):
    def load(self, path: str) -> TargetStatistics:
        loaded = super().load(path)
        loaded.table = self.sparkSession.read.parquet(f"{path}/labels")
        return loaded


class TargetStatistics(Transformer, MLReadable, MLWritable):
    """Pipeline stage that joins `<column>_target` to rows from a table of label means, which is
    saved beside its parameters."""

    inputCols = Param(Params._dummy(), "inputCols", "columns to encode", TypeConverters.toListString)
    mean = Param(Params._dummy(), "mean", "value of unknown labels", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None, mean: float | None = None):
        super().__init__()
        self.table: DataFrame | None = None
        self._set(**self._input_kwargs)

    def getOutputCols(self) -> list[str]:
        return [statistics_name(name) for name in self.getOrDefault(self.inputCols)]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        for name in self.getOrDefault(self.inputCols):
            known = self.table.filter(F.col("feature") == name).select(
                F.col("label").alias(_LABEL), F.col("value").alias(statistics_name(name))
            )
            keyed = dataset.withColumn(_LABEL, column(name).cast("string")).join(known, _LABEL, "left")
            value = F.coalesce(column(statistics_name(name)), F.lit(self.getOrDefault(self.mean)))
            dataset = keyed.withColumn(statistics_name(name), value).drop(_LABEL)
        return dataset

    def write(self) -> _Writer:
        return _Writer(self)

    @classmethod
    def read(cls) -> _Reader:
        return _Reader(cls)
