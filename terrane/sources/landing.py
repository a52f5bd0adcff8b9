"""Landed files: format, glob and reader options come from the spec."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrane.functions.columns import INGESTED_AT, SOURCE_FILE
from terrane.sources import paths


def reader_options(options: Mapping[str, Any] | None) -> dict[str, str]:
    """Spark takes option text; YAML gives booleans and numbers too."""
    return {
        str(key): str(value).lower() if isinstance(value, bool) else str(value)
        for key, value in (options or {}).items()
    }


def read_landing(
    spark: SparkSession,
    landing_path: str,
    *,
    file_format: str = "json",
    file_pattern: str = "*",
    options: Mapping[str, Any] | None = None,
    schema: T.StructType | str | None = None,
) -> DataFrame | None:
    """Files of one landing folder that match the pattern, or None when there are none.

    Without a schema the reader infers one, which costs a pass over text files; give a
    schema (or a ``samplingRatio`` option) for large batches.
    """
    pattern = f"{landing_path.rstrip('/')}/{file_pattern}"
    if not paths.matches_any(spark, pattern):
        return None
    reader = spark.read.format(file_format).options(**reader_options(options))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(pattern)


def lineage() -> dict[str, Column]:
    """When each row was ingested, and from which file."""
    return {INGESTED_AT: F.current_timestamp(), SOURCE_FILE: F.col("_metadata.file_path")}


def with_lineage(df: DataFrame) -> DataFrame:
    return df.withColumns(lineage())
