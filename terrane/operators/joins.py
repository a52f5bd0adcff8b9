"""Equi-joins on same-named keys, chained left-deep, safe under hot keys.

Spark splits a hot partition at run time only on a side whose unmatched rows it need not
track: either side of an inner join, the left of a left/semi/anti join, the right of a
right join. The sides it cannot split are handled here:

* semi/anti: a right side with a hot key is reduced to its distinct keys in a written stage;
* outer joins: keys whose rows weigh more than a task should hold are found by the bytes of
  their rows. The rows of such a key are dealt over cells on the side that can't be split,
  and the other side's rows of it go to each cell; all other keys stay in one cell. It is one
  join, on the keys and the cell. A row that went to several cells is dropped where it finds
  no partner: its key has rows on the dealt side, so it finds them in some cell.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrane.functions.columns import LINEAGE, column
from terrane.session import estimated_bytes
from terrane.sources.tables import stage

# The join type spellings a spec may use.
JOIN_TYPES = {
    "inner": "inner",
    "cross": "inner",
    "left": "left",
    "leftouter": "left",
    "right": "right",
    "rightouter": "right",
    "full": "full",
    "outer": "full",
    "fullouter": "full",
    "semi": "left_semi",
    "leftsemi": "left_semi",
    "anti": "left_anti",
    "leftanti": "left_anti",
}

# A key is hot when its rows would overload one task, by the bytes that they really have.
HOT_BYTES = 1 << 30
# A hot key is cut into cells of this share of what makes it hot.
_CELLS_PER_LIMIT = 8
# Bytes are summed in so many buckets by hash; only keys of full buckets are looked at one by one.
_BUCKETS = 1 << 20
# A join that is told to expect hot keys takes so many of the heaviest.
_EXPECTED = 1_000
# Rows without a key match nothing: they are dealt over so many cells in any case.
_NULL_CELLS = 10_000
_PLAN_BYTES = 64 << 20
_CELL, _CELLS, _DEALT, _MET = "__cell", "__cells", "__dealt", "__met"


def join_type(text: str) -> str:
    kind = JOIN_TYPES.get(text.lower().replace("_", ""))
    if kind is None:
        raise ValueError(f"unknown join type {text!r}")
    return kind


def _broadcastable(df: DataFrame) -> bool:
    """Spark will broadcast a side this small itself, so no key of it reaches a shuffle."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return estimated_bytes(df) <= limit


def row_bytes(df: DataFrame) -> Column:
    """What the values of a row take; nested ones count as their JSON text."""
    total = F.lit(8 * len(df.columns))
    for k, field in enumerate(df.schema.fields):
        value = F.col(f"c{k}")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            total = total + F.coalesce(F.octet_length(value), F.lit(0))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            total = total + F.coalesce(F.octet_length(F.to_json(F.struct(value))), F.lit(0))
    return total.cast("long")


def heavy_keys(
    df: DataFrame, keys: Sequence[str], limit: int | None = None, *, rows: bool = False, top: int | None = None
) -> DataFrame:
    """Keys (without NULLs) whose rows weigh at least `limit`, in bytes or `rows`, with `weight`.

    One pass sums weights by hash bucket, map-side first. Exact keys are summed in buckets that
    reach the limit only, so what meets in a task is small, and there are at most total weight
    / limit of them. With `top`, the heaviest so many keys, whatever they weigh.
    """
    limit = limit or HOT_BYTES
    names = [f"c{k}" for k in range(len(df.columns))]  # chained joins may repeat other names
    at = [names[k] for k in _positions(df, keys)]
    weight = F.lit(1).cast("long") if rows else row_bytes(df)
    weighed = df.toDF(*names).dropna(subset=at).select(*at, weight.alias("weight")).toDF(*keys, "weight")
    bucket = F.pmod(F.xxhash64(*[column(k) for k in keys]), F.lit(_BUCKETS))
    full = weighed
    if top is None:
        sums = weighed.groupBy(bucket.alias("__bucket")).agg(F.sum("weight").alias("__sum"))
        found = stage(sums.filter(F.col("__sum") >= limit).select("__bucket"), "full-buckets")[0]
        if not found.take(1):
            return weighed.limit(0)
        full = weighed.withColumn("__bucket", bucket).join(found, "__bucket", "left_semi").drop("__bucket")
    by_key = full.groupBy(*map(column, keys)).agg(F.sum("weight").alias("weight"))
    heavy = by_key.filter(F.col("weight") >= limit) if top is None else by_key.orderBy(F.desc("weight")).limit(top)
    return stage(heavy, "heavy-keys")[0]


def has_hot_key(
    df: DataFrame, keys: Sequence[str], hot_rows: int | None = None, *, with_nulls: bool = False
) -> bool:
    """Whether some key's rows weigh too much for a task. Rows with a NULL key only weigh on a
    join that keeps them."""
    found = heavy_keys(df, keys, hot_rows, rows=hot_rows is not None).take(1)
    return bool(found) or (with_nulls and _keyless(df, keys, hot_rows) >= (hot_rows or HOT_BYTES))


def _keyless(df: DataFrame, keys: Sequence[str], hot_rows: int | None) -> int:
    """What the rows with a NULL key weigh."""
    names = [f"c{k}" for k in range(len(df.columns))]
    unknown = reduce(or_, [F.col(names[k]).isNull() for k in _positions(df, keys)])
    weight = F.lit(1) if hot_rows is not None else row_bytes(df)
    return df.toDF(*names).filter(unknown).agg(F.sum(weight)).first()[0] or 0


def join_tables(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    *,
    skew: str = "auto",
    hot_rows: int | None = None,
    derived: bool = False,
) -> DataFrame:
    """USING-join with one copy of each key; the right side's lineage columns are dropped.

    ``skew``: ``auto`` looks for hot keys on the sides Spark cannot split, ``on`` assumes
    them, ``off`` leaves the join as it is. The result is the same either way. A ``derived``
    left side is dear to make: it is staged, with all its columns, before it is used more than
    once, or dealt over cells by the places of its rows.
    """
    keys = list(keys)
    if not keys:
        raise ValueError("a join needs at least one key column")
    kind = join_type(how)
    right = right.drop(*[c for c in LINEAGE if c not in keys])

    def hot(side: DataFrame) -> bool:
        if skew != "auto":
            return skew == "on"
        return not _broadcastable(side) and has_hot_key(side, keys, hot_rows)

    if kind in ("left_semi", "left_anti"):
        seen = right.select(*map(column, keys))
        return left.join(_distinct(seen) if hot(right) else seen, keys, kind)
    rigid = {"left": "r", "right": "l", "full": "lr"}.get(kind, "")
    sides = {"l": left, "r": right}
    measured = [name for name in rigid if skew == "on" or (skew == "auto" and not _broadcastable(sides[name]))]
    if derived and "l" in measured:
        sides["l"], _ = stage(left, "join")
    limit, top = hot_rows or HOT_BYTES, _EXPECTED if skew == "on" else None
    heavy = [
        heavy_keys(sides[name], keys, hot_rows, rows=hot_rows is not None, top=top).withColumn(_DEALT, F.lit(name))
        for name in measured
    ]
    keyless = kind == "full" and any(_keyless(sides[name], keys, hot_rows) >= limit for name in measured)
    if keyless or any(found.take(1) for found in heavy):
        if derived and "l" not in measured:
            sides["l"], _ = stage(left, "join")
        return _join_in_cells(sides["l"], sides["r"], keys, kind, reduce(DataFrame.unionByName, heavy), limit)
    return sides["l"].join(sides["r"], keys, kind)


def _distinct(keys: DataFrame) -> DataFrame:
    """Distinct keys as a written stage: a plain scan, so its exchange can stay under a sort."""
    return stage(keys.distinct(), "keys")[0]


def _positions(df: DataFrame, keys: Sequence[str]) -> list[int]:
    lowered = [c.lower() for c in df.columns]
    return [lowered.index(k.lower()) for k in keys]


def _join_in_cells(
    left: DataFrame, right: DataFrame, keys: list[str], kind: str, heavy: DataFrame, limit: int
) -> DataFrame:
    """An outer join whose heavy keys (with the side that is dealt) are spread over cells."""
    heaviest = F.max_by(F.struct("weight", _DEALT), F.struct("weight", _DEALT)).alias("top")
    cells = F.greatest(F.ceil(F.col("top.weight") * _CELLS_PER_LIMIT / F.lit(limit)), F.lit(2)).cast("int")
    top = heavy.groupBy(*map(column, keys)).agg(heaviest)
    dealt = F.col(f"top.{_DEALT}").alias(_DEALT)
    plan, _ = stage(top.select(*map(column, keys), cells.alias(_CELLS), dealt), "cells")
    if estimated_bytes(plan) <= _PLAN_BYTES:  # its rows are few, as each weighs the limit
        plan = F.broadcast(plan)

    def placed(side: DataFrame, name: str) -> DataFrame:
        """The rows with their cell, or once with each cell, and whether it is each."""
        marked = side.join(plan, keys, "left")
        unknown = reduce(or_, [column(k).isNull() for k in keys])
        one = F.pmod(F.monotonically_increasing_id(), F.when(unknown, F.lit(_NULL_CELLS)).otherwise(F.col(_CELLS)))
        each = F.sequence(F.lit(0), F.col(_CELLS) - 1).cast("array<long>")
        met = F.col(_DEALT).isNotNull() & (F.col(_DEALT) != name)
        chosen = F.when(met, each).otherwise(F.array(F.coalesce(one, F.lit(0).cast("long"))))
        marked = marked.withColumn(_MET + name, F.coalesce(met, F.lit(False))).withColumn("__all", chosen)
        return marked.withColumn(_CELL, F.explode("__all")).drop("__all", _CELLS, _DEALT)

    joined = placed(left, "l").join(placed(right, "r"), [*keys, _CELL], kind)
    lone_left = F.col(f"{_MET}l") & F.col(f"{_MET}r").isNull()
    lone_right = F.col(f"{_MET}r") & F.col(f"{_MET}l").isNull()
    kept = joined.filter(~(F.coalesce(lone_left, F.lit(False)) | F.coalesce(lone_right, F.lit(False))))
    return kept.drop(_CELL, f"{_MET}l", f"{_MET}r")


def join_chain(
    primary: DataFrame,
    joins: Sequence[tuple[DataFrame, Sequence[str], str]],
    *,
    skew: str = "auto",
) -> DataFrame:
    """Fold the joins in listed order."""
    joined = primary
    for right, keys, how in joins:
        derived = joined is not primary
        joined = join_tables(joined, right, keys, how, skew=skew, derived=derived)
    return joined
