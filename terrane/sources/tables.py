"""Path-addressed Parquet tables.

Layout: ``<table>/v=<n>/<segment>/part-*.parquet``. An overwrite writes version ``n+1``
as one new segment; an append adds a segment to the newest version. Spark's own
``_SUCCESS`` marker makes a segment visible, so a job that dies half-way leaves nothing
readable, and re-running a named segment replaces it. ``v=<n>/_schema.json`` holds the
columns of the version, so neither a read nor an append has to look into file footers.

Packing writes segments of small files as one new segment; ``v=<n>/_packs/<segment>.json``
names the segments it stands for, which count no more once it is visible. Of two packings that
overlap only the first counts, so each row is read once whoever else packs or appends. An
append that finds itself behind an overwrite moves its segment into the newer version.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrane.session import estimated_bytes, scratch_path
from terrane.sources import paths

BATCH = "batch-"
PACKED = "packed-"
# Catalyst's stand-in for "no idea" is the largest long; no real table comes near this.
_UNKNOWN_BYTES = 2**60
_VERSION = re.compile(r"^v=(\d+)$")


class SchemaConflict(ValueError):
    """An append would change the type of an existing column."""


def _versions(spark: SparkSession, table: str) -> list[int]:
    found = (_VERSION.match(name) for name in paths.child_folders(spark, table))
    return sorted(int(m.group(1)) for m in found if m)


def complete_segments(spark: SparkSession, table: str, version: int) -> list[str]:
    root = f"{table}/v={version}"
    return [
        f"{root}/{name}"
        for name in paths.child_folders(spark, root)
        if paths.exists(spark, f"{root}/{name}/_SUCCESS")
    ]


def history(spark: SparkSession, table: str) -> list[tuple[int, list[str]]]:
    """Versions that hold data, oldest first, each with its complete segments."""
    listed = ((v, complete_segments(spark, table, v)) for v in _versions(spark, table))
    return [(v, segments) for v, segments in listed if segments]


def live_segments(spark: SparkSession, table: str) -> list[str]:
    for version in reversed(_versions(spark, table)):
        segments = complete_segments(spark, table, version)
        if segments:
            return unpacked(segments, packs(spark, segments))[0]
    return []


def packs(spark: SparkSession, segments: Sequence[str]) -> dict[str, dict]:
    """What each visible packed segment of a version stands for."""
    packed = [segment for segment in segments if segment.rpartition("/")[2].startswith(PACKED)]
    return {segment: json.loads(paths.read_text(spark, _record(segment)) or "{}") for segment in packed}


def _record(segment: str) -> str:
    root, _, name = segment.rpartition("/")
    return f"{root}/_packs/{name}.json"


def unpacked(segments: Sequence[str], known: dict[str, dict]) -> tuple[list[str], list[str]]:
    """The segments that hold each row once, and the packed ones that count.

    A packing counts if all it stands for is there and no earlier one stands for any of it;
    one that does not count is left out, as its rows are in others. Names sort a packing
    behind those it has read. Once removal has settled a packing it counts in any case.
    """
    names = {segment.rpartition("/")[2]: segment for segment in segments}
    gone: set[str] = set()
    counted = []
    for segment in sorted(known, key=lambda one: (not known[one].get("settled"), one)):
        members, name = set(known[segment].get("segments", ())), segment.rpartition("/")[2]
        if known[segment].get("settled") or name in gone or (members <= set(names) and not members & gone):
            gone |= members
            counted.append(segment)
        else:
            gone.add(name)
    return [segment for name, segment in names.items() if name not in gone], counted


def settle(spark: SparkSession, segment: str) -> None:
    """Make a packing count for good, before what it stands for is removed."""
    record = json.loads(paths.read_text(spark, _record(segment)) or "{}")
    paths.write_text(spark, _record(segment), json.dumps({**record, "settled": True}))


def is_table(spark: SparkSession, table: str) -> bool:
    if "/" not in table and spark.catalog.tableExists(table):
        return True
    return bool(live_segments(spark, table)) or (
        not _versions(spark, table) and paths.matches_any(spark, f"{table}/*")
    )


def read_table(spark: SparkSession, table: str) -> DataFrame:
    """Newest complete version of a table, a catalog table, or a plain Parquet path."""
    if "/" not in table and spark.catalog.tableExists(table):
        return spark.table(table)
    live = live_segments(spark, table)
    if live:
        return _read_paths(spark, live, _version_of(live[0]))
    if paths.exists(spark, f"{table}/_delta_log"):
        return spark.read.format("delta").load(table)
    return spark.read.parquet(table)


def _recorded_schema(spark: SparkSession, version: str) -> T.StructType | None:
    text = paths.read_text(spark, f"{version}/_schema.json")
    return None if text is None else T.StructType.fromJson(json.loads(text))


def _read_paths(spark: SparkSession, live: Sequence[str], version: str) -> DataFrame:
    schema = _recorded_schema(spark, version)
    if schema is None:
        return spark.read.option("mergeSchema", "true").parquet(*live)
    return spark.read.schema(schema).parquet(*live)


def table_bytes(spark: SparkSession, table: str) -> int:
    """Bytes at rest; 0 for a catalog table or view of unknown size."""
    if "/" not in table and spark.catalog.tableExists(table):
        estimate = estimated_bytes(spark.table(table))
        return estimate if estimate < _UNKNOWN_BYTES else 0
    return sum(paths.total_bytes(spark, path) for path in live_segments(spark, table) or [table])


def merge_schemas(existing: T.StructType, incoming: T.StructType) -> T.StructType:
    """Columns (and nested fields) may be added; a changed type is refused, both named."""
    return _merge(existing, incoming, "")


def _merge(old: T.DataType, new: T.DataType, where: str) -> T.DataType:
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        known = {f.name.lower(): f for f in old.fields}
        merged = {
            key: T.StructField(field.name, field.dataType, True) for key, field in known.items()
        }
        for field in new.fields:
            key, name = field.name.lower(), f"{where}{field.name}"
            before = known.get(key)
            kind = _merge(before.dataType, field.dataType, f"{name}.") if before else field.dataType
            merged[key] = T.StructField(before.name if before else field.name, kind, True)
        return T.StructType(list(merged.values()))
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return T.ArrayType(_merge(old.elementType, new.elementType, f"{where}[]."))
    if isinstance(old, T.MapType) and isinstance(new, T.MapType):
        keys = _merge(old.keyType, new.keyType, f"{where}key.")
        return T.MapType(keys, _merge(old.valueType, new.valueType, f"{where}value."))
    if old != new:
        raise SchemaConflict(
            f"column {where.rstrip('.')!r} is {old.simpleString()} in the table "
            f"but {new.simpleString()} in the new rows"
        )
    return old


def check_unique_names(names: Sequence[str]) -> None:
    lowered = [n.lower() for n in names]
    repeated = sorted({n for n in lowered if lowered.count(n) > 1})
    if repeated:
        raise ValueError(
            f"columns {repeated} occur more than once; select or rename them before the write"
        )


def write_table(
    df: DataFrame,
    table: str,
    mode: str = "overwrite",
    *,
    segment: str | None = None,
) -> int:
    """Write and return the row count, taken from the same single pass.

    A named segment makes the write repeatable: a second attempt replaces the first, also
    when a rewrite of the table has merged the first attempt's rows in between.
    """
    if mode not in ("append", "overwrite"):
        raise ValueError(f"write mode must be append or overwrite, not {mode!r}")
    check_unique_names(df.columns)
    spark = df.sparkSession
    schema = df.schema
    root = _next_version(spark, table)
    if mode == "append":
        live = live_segments(spark, table)
        if live:
            root = _version_of(live[0])
            schema = merge_schemas(_known_schema(spark, table, root), schema)
            if segment and _merged(spark, live).get(_stem(segment), "") >= segment:
                return 0
        elif not _versions(spark, table) and paths.matches_any(spark, f"{table}/*"):
            raise ValueError(f"{table} already holds files that are not a versioned table")
        segment = segment or f"append-{uuid.uuid4().hex}"
    # Before the rows: a column nobody has filled yet is harmless, a hidden one is not.
    paths.write_text(spark, f"{root}/_schema.json", schema.json())
    written = write_counted(df, f"{root}/{segment or 'base'}")
    if mode == "append":
        _keep_up(spark, table, root, segment, schema)
    return written


def _known_schema(spark: SparkSession, table: str, version: str) -> T.StructType:
    known = _recorded_schema(spark, version)
    return known or _read_paths(spark, live_segments(spark, table), version).schema


def _keep_up(
    spark: SparkSession, table: str, root: str, segment: str, schema: T.StructType
) -> None:
    """Move a finished append into the newest version, if an overwrite was published meanwhile.

    Whoever finds the segment behind the newest version after it became visible moves it, so
    rows that were reported as written are never left behind.
    """
    while True:
        newest = _version_of(live_segments(spark, table)[0])
        if newest == root:
            return
        merged = merge_schemas(_known_schema(spark, table, newest), schema)
        paths.write_text(spark, f"{newest}/_schema.json", merged.json())
        paths.rename(spark, f"{root}/{segment}", f"{newest}/{segment}")
        root = newest


def pack_segments(spark: SparkSession, table: str, segments: Sequence[str]) -> int:
    """Write the rows of the given live segments as one new segment that stands for them."""
    root = _version_of(segments[0])
    names = sorted(segment.rpartition("/")[2] for segment in segments)
    merged = _merged(spark, segments)
    for name in names:
        if name.startswith(BATCH):
            merged[_stem(name)] = max(name, merged.get(_stem(name), ""))
    taken = (int(name.split("-")[1]) for name in paths.data_files(spark, f"{root}/_packs"))
    packed = f"{root}/{PACKED}{max(taken, default=0) + 1:09d}-{uuid.uuid4().hex}"
    paths.write_text(spark, _record(packed), json.dumps({"segments": names, "merged": merged}))
    return write_counted(_read_paths(spark, segments, root), packed)


def _next_version(spark: SparkSession, table: str) -> str:
    return f"{table}/v={max(_versions(spark, table), default=0) + 1}"


def _version_of(segment: str) -> str:
    return segment.rsplit("/", 1)[0]


def batch_name(stream: str, number: int) -> str:
    """Segment name of one micro-batch; names of a stream sort by batch number."""
    return f"{BATCH}{stream}-{number:012d}"


def _stem(segment: str) -> str:
    return segment.rpartition("-")[0]


def _merged(spark: SparkSession, segments: Sequence[str]) -> dict[str, str]:
    """Newest batch of each stream of which packing has taken files."""
    newest: dict[str, str] = {}
    for pack in packs(spark, segments).values():
        for stem, name in pack.get("merged", {}).items():
            newest[stem] = max(name, newest.get(stem, ""))
    return newest


def write_counted(df: DataFrame, path: str) -> int:
    counter = Observation()
    df.observe(counter, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    return counter.get["rows"]


def small_frame(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A few literal rows (run records, statuses) as a plan without Python workers."""
    types = T.StructType.fromDDL(schema)
    if not rows:
        return spark.createDataFrame([], types)
    lines = [
        F.struct(
            *[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, types.fields)]
        )
        for row in rows
    ]
    return spark.range(1, numPartitions=1).select(F.inline(F.array(*lines)))


def stage(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Materialise a shared intermediate once, durably; returns it with its path.

    The copy lives in the shared folder, so a lost executor costs no recomputation of
    what came before it. The caller removes the path when its readers are done.
    """
    path = scratch_path(df.sparkSession, f"stage-{name}")
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path
