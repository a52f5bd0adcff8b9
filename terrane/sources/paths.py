"""Directory metadata through Hadoop's file-system API (local, HDFS or object store)."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession


def _locate(spark: SparkSession, path: str):
    handle = spark._jvm.org.apache.hadoop.fs.Path(path)
    return handle.getFileSystem(spark._jsc.hadoopConfiguration()), handle


def exists(spark: SparkSession, path: str) -> bool:
    fs, handle = _locate(spark, path)
    return fs.exists(handle)


def child_folders(spark: SparkSession, path: str) -> list[str]:
    fs, handle = _locate(spark, path)
    if not fs.exists(handle):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(handle) if s.isDirectory())


def data_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files right inside a folder, without hidden ones and markers."""
    fs, handle = _locate(spark, path)
    if not fs.exists(handle):
        return []
    listed = (s.getPath().getName() for s in fs.listStatus(handle) if s.isFile())
    return sorted(name for name in listed if not name.startswith((".", "_")))


def matching_files(spark: SparkSession, pattern: str) -> list[tuple[str, int, int]]:
    """(path, modification time in ms, length) of visible files that match, or lie in a
    folder that matches."""
    fs, handle = _locate(spark, pattern)
    found = []

    def visible(path) -> bool:
        return not path.getName().startswith((".", "_"))

    for status in fs.globStatus(handle) or ():
        if not visible(status.getPath()):
            continue
        inside = fs.listFiles(status.getPath(), True)
        while inside.hasNext():
            file = inside.next()
            if visible(file.getPath()):
                found.append((file.getPath().toString(), file.getModificationTime(), file.getLen()))
    return sorted(found)


def rename(spark: SparkSession, path: str, target: str) -> None:
    """Move within one store; the target's folder is made, an existing target is an error."""
    fs, handle = _locate(spark, path)
    _, goal = _locate(spark, target)
    fs.mkdirs(goal.getParent())
    if fs.exists(goal) or not fs.rename(handle, goal):
        raise OSError(f"cannot move {path} to {target}")


def move_files(files: DataFrame, folder: str, prefix: str) -> None:
    """Move files (url, modification time in ms, length) that are still as listed into a folder.

    Tasks move them, through Arrow's file systems, to `<prefix>-<hash of the url>-<name>`; one
    that has moved already, in a first attempt, is left alone. Stores that Arrow cannot open
    are worked on from the driver instead, file by file.
    """
    spark = files.sparkSession
    target = qualified(spark, folder)
    _, handle = _locate(spark, folder)
    handle.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(handle)

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib
        from urllib.parse import unquote

        import pyarrow
        from pyarrow.fs import FileSystem

        for batch in batches:
            moved = 0
            for url, modified, length in zip(*(column.to_pylist() for column in batch.columns)):
                store, path = FileSystem.from_uri(url)
                _, goal = FileSystem.from_uri(target)
                found = store.get_file_info(path)
                if found.is_file and found.size == length and found.mtime_ns // 1_000_000 == modified:
                    digest = hashlib.md5(url.encode()).hexdigest()[:8]
                    store.move(path, f"{goal}/{prefix}-{digest}-{unquote(url.rsplit('/', 1)[1])}")
                    moved += 1
            yield pyarrow.RecordBatch.from_pydict({"moved": [moved]})

    try:
        arrow_fs.FileSystem.from_uri(target)
    except (OSError, ValueError, NotImplementedError):
        for url, modified, length in files.toLocalIterator():
            path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(url)).toString()
            if (path, modified, length) in matching_files(spark, escaped(path)):
                digest = hashlib.md5(url.encode()).hexdigest()[:8]
                rename(spark, path, f"{target}/{prefix}-{digest}-{path.rsplit('/', 1)[1]}")
    else:
        files.mapInArrow(move, "moved long").agg({"moved": "sum"}).collect()


def escaped(path: str) -> str:
    """A path as a pattern that only it matches."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def matches_any(spark: SparkSession, pattern: str) -> bool:
    fs, handle = _locate(spark, pattern)
    found = fs.globStatus(handle)
    if found is None:
        return False
    return any(not s.getPath().getName().startswith((".", "_")) for s in found)


def modified_at(spark: SparkSession, path: str) -> float:
    fs, handle = _locate(spark, path)
    return fs.getFileStatus(handle).getModificationTime() / 1000.0


def newest_file(spark: SparkSession, path: str) -> float:
    """Latest change among all files below; 0 without any.

    Object stores keep no dependable time on folders, so files are asked.
    """
    fs, handle = _locate(spark, path)
    files, newest = fs.listFiles(handle, True), 0.0
    while files.hasNext():
        newest = max(newest, files.next().getModificationTime() / 1000.0)
    return newest


def total_bytes(spark: SparkSession, path: str) -> int:
    fs, handle = _locate(spark, path)
    return fs.getContentSummary(handle).getLength() if fs.exists(handle) else 0


def qualified(spark: SparkSession, path: str) -> str:
    fs, handle = _locate(spark, path)
    return fs.makeQualified(handle).toString()


def remove(spark: SparkSession, path: str) -> None:
    fs, handle = _locate(spark, path)
    fs.delete(handle, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, handle = _locate(spark, path)
    stream = fs.create(handle, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, handle = _locate(spark, path)
    if not fs.exists(handle):
        return None
    stream = fs.open(handle)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()
