"""Column types of delimited text, from all values, found while the text is read once."""

from __future__ import annotations

import csv
from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrane.functions.columns import SOURCE_FILE, column
from terrane.session import scratch_path
from terrane.sources.landing import read_landing
from terrane.sources.tables import stage

# The types from the narrowest on, each with the form its texts must have.
# A column has the first type that fits all its values, else it stays text.
LATTICE = {
    "int": r"^\s*[+-]?\d+\s*$",
    "bigint": r"^\s*[+-]?\d+\s*$",
    "double": r"^\s*([+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|NaN|[+-]?Inf(inity)?)\s*$",
    "date": r"^\d{4}-\d{1,2}-\d{1,2}$",
    "timestamp": r"^\d{4}-\d{1,2}-\d{1,2}([ T].*)?$",
    "boolean": r"^(?i)(true|false)$",
}


def _misfits(name: str, kind: str, form: str) -> Column:
    text = column(name)
    fits = text.rlike(form) & text.try_cast(kind).isNotNull()
    return F.count_if(text.isNotNull() & ~fits)


def lattice_counts(columns: list[str]) -> list[Column]:
    """Aggregates that tell for each column how many values it has, and how many do not fit
    each type; sums, so they merge over tasks, files and batches."""
    found = []
    for k, name in enumerate(columns):
        found.append(F.count(column(name)).alias(f"c{k}"))
        found += [_misfits(name, kind, form).alias(f"c{k}_{kind}") for kind, form in LATTICE.items()]
    return found


def types_of(columns: list[str], counts: Mapping[str, int]) -> dict[str, str]:
    """The narrowest type of each column; one without values is text."""
    chosen = {}
    for k, name in enumerate(columns):
        fitting = [kind for kind in LATTICE if counts[f"c{k}"] and not counts[f"c{k}_{kind}"]]
        chosen[name] = fitting[0] if fitting else "string"
    return chosen


def read_inferred(
    spark: SparkSession,
    landing_path: str,
    *,
    file_pattern: str = "*",
    options: Mapping[str, Any] | None = None,
    lineage: bool = False,
) -> DataFrame | None:
    """Rows of landed CSV files under the types that all their values have, or None without files.

    The files are read once, as text, into a staged copy, and the same pass counts what each
    type does not fit; the copy is then read as the types found. Files may have different
    columns: each is read under its own header, and columns that a file lacks are NULL.
    """
    settings = {**(options or {}), "header": True, "inferSchema": False}
    files = _headers(spark, landing_path, file_pattern, settings)
    if files is None:
        return None
    whole = None
    for row in files.select("header").distinct().collect():  # a row a form of file
        names = next(csv.reader([row["header"]], delimiter=str(settings.get("sep", settings.get("delimiter", ",")))))
        schema = T.StructType([T.StructField(name.strip("\ufeff"), T.StringType()) for name in names])
        rows = read_landing(
            spark, landing_path, file_format="csv", file_pattern=file_pattern, options=settings, schema=schema
        )
        own = files.filter(F.col("header") == row["header"]).select(SOURCE_FILE)
        rows = rows.withColumn(SOURCE_FILE, F.col("_metadata.file_path")).join(own, SOURCE_FILE, "left_semi")
        whole = rows if whole is None else whole.unionByName(rows, allowMissingColumns=True)
    columns = [name for name in whole.columns if name != SOURCE_FILE]
    seen, path = Observation(), scratch_path(spark, "inferred")
    whole.observe(seen, *lattice_counts(columns)).write.parquet(path)
    types = types_of(columns, seen.get)
    staged = spark.read.schema(whole.schema).parquet(path)
    typed = [F.trim(column(c)).cast(kind).alias(c) if kind != "string" else column(c) for c, kind in types.items()]
    return staged.select(*typed, *([SOURCE_FILE] if lineage else []))


def _headers(
    spark: SparkSession, landing_path: str, file_pattern: str, options: Mapping[str, Any]
) -> DataFrame | None:
    """(_source_file, header): the first line of each file that has one."""
    lines = read_landing(spark, landing_path, file_format="text", file_pattern=file_pattern)
    if lines is None:
        return None
    first = lines.select(F.col("_metadata.file_path").alias(SOURCE_FILE), "value").filter(
        F.col("_metadata.file_block_start") == 0
    )
    # A file's first block is one task's, and its lines come in order.
    place = first.withColumn("__place", F.monotonically_increasing_id())
    best = place.groupBy(SOURCE_FILE).agg(F.min_by("value", "__place").alias("header"))
    return stage(best, "headers")[0]
