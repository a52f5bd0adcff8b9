"""Column builders that stay inside Spark's own expressions."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

INGESTED_AT = "_ingested_at"
SOURCE_FILE = "_source_file"
FAILED_RULES = "_failed_rules"
QUARANTINED_AT = "_quarantined_at"
PREDICTED_AT = "_predicted_at"
MODEL_RUN_ID = "_model_run_id"
PREDICTION = "predicted_delay_days"
LINEAGE = (INGESTED_AT, SOURCE_FILE)

_HASH_RANGE = 2**32


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def column(name: str) -> Column:
    """A column by its exact name, dots and spaces included."""
    return F.col(quoted(name))


def missing(name: str, dtype: T.DataType) -> Column:
    """NULL, or NaN where the type has one."""
    absent = column(name).isNull()
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        absent = absent | F.isnan(column(name))
    return absent


def holds(condition: Column) -> Column:
    """Two-valued truth: a NULL condition counts as not met."""
    return F.coalesce(condition, F.lit(False))


def hash_position(seed: int, keys: Sequence[str]) -> Column:
    """A stable number in [0, 2**32) drawn from a salted MD5 of the key columns.

    The same row gets the same number on any cluster, layout or retry.
    """
    text = F.concat_ws(":", F.lit(str(seed)), *[column(k).cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def within_share(position: Column, share: float) -> Column:
    return position < F.lit(int(round(share * _HASH_RANGE)))


def fold_of(position: Column, folds: int) -> Column:
    return F.pmod(position, F.lit(folds)).cast("int")


def ordered(name: str, dtype: T.DataType) -> Column:
    """A sortable form of the column, for use as a tie-break."""
    if sortable(dtype):
        return column(name)
    return F.to_json(F.struct(column(name)))


def sortable(dtype: T.DataType) -> bool:
    if isinstance(dtype, (T.MapType, T.VariantType, T.UserDefinedType)):
        return False
    if isinstance(dtype, T.ArrayType):
        return sortable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(sortable(f.dataType) for f in dtype.fields)
    return True


def aggregate_alias(expression: str, function: str) -> str:
    """``<column>_<function>``, with text that is no plain name made into one."""
    if expression.strip() == "*":
        return f"all_{function}"
    plain = re.sub(r"\W+", "_", expression).strip("_")
    return f"{plain}_{function}"


def bin_index(value: Column, low: Column, high: Column, bins: int) -> Column:
    """Equal-width bin of ``value``; the upper edge belongs to the last bin."""
    width = (high - low) / F.lit(bins)
    return F.least(F.floor((value - low) / width), F.lit(bins - 1)).cast("int")


def residual(predicted: str, actual: str) -> Column:
    return column(predicted) - column(actual)


def type_of(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType
