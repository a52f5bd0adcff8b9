"""Incremental landing sweep: each landed file reaches the bronze table exactly once."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Mapping
from typing import Any
from urllib.parse import unquote, urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrane.operators.numbering import numbered
from terrane.sources import paths
from terrane.sources.landing import lineage, reader_options
from terrane.sources.tables import batch_name, write_counted, write_table

ANY_AGE = "36500d"
# What identifies a landed file, and the names these have beside the rows that are read.
_FILE = {"__path": "file_path", "__modified": "file_modification_time", "__size": "file_size"}
_BATCHES = 1_000_000  # of one sweep, at most


def landing_stream(
    spark: SparkSession,
    landing_path: str,
    schema: T.StructType | str,
    *,
    file_format: str = "json",
    file_pattern: str = "*",
    options: Mapping[str, Any] | None = None,
    archive_path: str | None = None,
    max_files_per_batch: int | None = None,
) -> DataFrame:
    """New files of a landing folder as a stream; consumed ones move to the archive.

    A file is archived, under its own path, once a *later* batch completes. Spark's file
    source knows a file by its path alone: one that lands again under a known path is not
    read. ``ingest_stream`` has no such limit.
    """
    reader = spark.readStream.format(file_format).schema(schema).options(**reader_options(options))
    reader = reader.option("maxFileAge", ANY_AGE)  # else files a week older than the newest are lost
    if archive_path:
        reader = reader.option("cleanSource", "archive")
        reader = reader.option("sourceArchiveDir", paths.qualified(spark, archive_path))
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_batch))
    return reader.load(f"{landing_path.rstrip('/')}/{file_pattern}")


def run_available(
    stream: DataFrame, checkpoint: str, handle: Callable[[DataFrame, str], None]
) -> None:
    """Process what has landed, then stop. ``handle`` gets each batch and a stable name.

    The name joins the checkpoint's own id and the batch number: a batch that is retried
    after a failure writes over its first attempt, and a new checkpoint never does.
    """
    spark = stream.sparkSession

    def each(batch: DataFrame, number: int) -> None:
        identity = spark.read.text(f"{checkpoint}/metadata", wholetext=True).first()[0]
        handle(batch, batch_name(json.loads(identity)["id"], number))

    query = (
        stream.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def ingest_stream(
    spark: SparkSession,
    landing_path: str,
    table: str,
    *,
    checkpoint: str | None = None,
    file_format: str = "json",
    file_pattern: str = "*",
    options: Mapping[str, Any] | None = None,
    schema: T.StructType | str | None = None,
    archive_path: str | None = None,
    max_files_per_batch: int | None = None,
    write_mode: str = "append",
) -> int:
    """Write all files not ingested before; returns the rows written.

    A file is known by path, modification time and length, so one that lands again under an
    old name, or with an old date, is ingested like any other. New files are those of a
    listing that an anti join does not find in the file table; they join it before they are
    read, a sweep at a time, with the number of their batch. A sweep that finds a batch undone
    repeats just that batch, whose segment replaces the first attempt.

    With an archive, a batch's files move there, in tasks, once it is done, under names that
    begin with the time. In ``overwrite`` mode a sweep replaces the table, so it is one batch.
    Without a schema the files of a batch are opened by name to infer one, which takes a pass.
    """
    files = FileTable(spark, checkpoint or f"{table}/_ingest")
    pattern = f"{landing_path.rstrip('/')}/{file_pattern}"
    if archive_path:
        files.archive(archive_path)
    if paths.matches_any(spark, pattern):
        files.plan(pattern, max_files_per_batch if write_mode == "append" else None)
    written = 0
    for batch in files.undone():
        mode = "append" if written else write_mode
        rows = read_files(files.of(batch), pattern, file_format, options, schema)
        written += write_table(rows, table, mode, segment=files.segment(batch))
        files.mark(batch, "done")
        if archive_path:
            files.archive(archive_path)
    return written


class FileTable:
    """The files that sweeps have taken: `files/sweep=<k>` holds their path, time, length and
    batch. Empty files in `state` say that a sweep is planned, a batch done or archived."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        if not paths.exists(spark, f"{root}/id"):
            paths.write_text(spark, f"{root}/id", uuid.uuid4().hex)
        self.identity = paths.read_text(spark, f"{root}/id")
        self.state = set(paths.data_files(spark, f"{root}/state"))

    def mark(self, batch: tuple[int, int], state: str) -> None:
        name = f"{batch[0]}-{batch[1]}.{state}"
        paths.write_text(self.spark, f"{self.root}/state/{name}", "")
        self.state.add(name)

    def marked(self, state: str) -> set[tuple[int, int]]:
        names = (name.removesuffix(f".{state}") for name in self.state if name.endswith(f".{state}"))
        return {tuple(map(int, name.split("-"))) for name in names}

    def undone(self) -> list[tuple[int, int]]:
        batches = {(sweep, batch) for sweep, size in self.marked("planned") for batch in range(size)}
        return sorted(batches - self.marked("done"))

    def segment(self, batch: tuple[int, int]) -> str:
        return batch_name(self.identity, batch[0] * _BATCHES + batch[1])

    def of(self, batch: tuple[int, int]) -> DataFrame:
        """The files of one batch."""
        sweep = self.spark.read.parquet(f"{self.root}/files/sweep={batch[0]}")
        return sweep.filter(F.col("batch") == batch[1]).drop("batch")

    def known(self) -> DataFrame | None:
        """All files of earlier sweeps that may still be in the landing."""
        planned = sorted(sweep for sweep, _ in self.marked("planned"))
        archived = self.marked("archived")
        sizes = dict(self.marked("planned"))
        gone = {sweep for sweep in planned if all((sweep, b) in archived for b in range(sizes[sweep]))}
        left = [sweep for sweep in planned if sweep not in gone]
        if not left:
            return None
        table = self.spark.read.parquet(f"{self.root}/files").drop("batch")
        return table.filter(F.col("sweep").between(left[0], left[-1])).drop("sweep")

    def plan(self, pattern: str, most: int | None) -> None:
        """Record the landed files that are new, dealt to batches in order of age."""
        names = [F.col(f"_metadata.{source}").alias(name) for name, source in _FILE.items()]
        listing = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(pattern)
        new, known = listing.select(*names), self.known()
        if known is not None:
            new = new.join(known, list(_FILE), "left_anti")
        batch = F.lit(0)
        if most:
            new = numbered(new, [F.col("__modified"), F.col("__path")], "batch")
            batch = F.floor(F.col("batch") / most)
        sweep = max((sweep for sweep, _ in self.marked("planned")), default=-1) + 1
        found = write_counted(new.withColumn("batch", batch.cast("int")), f"{self.root}/files/sweep={sweep}")
        if found:
            batches = -(-found // most) if most else 1
            if batches > _BATCHES:
                raise ValueError(f"{found} files make more than {_BATCHES} batches of {most}")
            self.mark((sweep, batches), "planned")

    def archive(self, folder: str) -> None:
        """Move the files of finished batches, where they are still as they were read."""
        for batch in sorted(self.marked("done") - self.marked("archived")):
            stamp = time.strftime("%Y%m%dT%H%M%S", time.gmtime())
            prefix = f"{stamp}-{batch[0]:06d}-{batch[1]:06d}"
            files = self.of(batch).select("__path", F.unix_millis("__modified").alias("__modified"), "__size")
            paths.move_files(files, folder, prefix)
            self.mark(batch, "archived")


def read_files(
    files: DataFrame,
    pattern: str,
    file_format: str,
    options: Mapping[str, Any] | None,
    schema: T.StructType | str | None,
) -> DataFrame:
    """The rows of the given files, with lineage.

    The landing is read by its pattern. A range of modification times prunes other files from
    the scan, a semi join by path, time and length leaves just the rows of these.
    """
    spark = files.sparkSession
    reader = spark.read.format(file_format).options(**reader_options(options))
    if schema is None:
        named = (row[0] for row in files.select("__path").toLocalIterator())
        schema = reader.load([paths.escaped(_plain(name)) for name in named]).schema
    landed = reader.schema(schema).option("recursiveFileLookup", "true").load(pattern)
    first, last = files.agg(F.min("__modified"), F.max("__modified")).first()
    aged = landed.filter(F.col("_metadata.file_modification_time").between(F.lit(first), F.lit(last)))
    marked = aged.withColumns({**lineage(), **{name: F.col(f"_metadata.{source}") for name, source in _FILE.items()}})
    return marked.join(files, list(_FILE), "left_semi").drop(*_FILE)


def _plain(url: str) -> str:
    """The path a file url stands for, as readers take it."""
    parts = urlsplit(url)
    return f"{parts.scheme}://{parts.netloc}{unquote(parts.path)}"
