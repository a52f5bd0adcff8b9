"""Session-level helpers: SQL settings, scratch space, shuffle sizing."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Bytes a scan task and a shuffle partition should take, until their numbers reach the
# limits below; past those the pieces grow instead, to keep map x reduce blocks in check.
PIECE_BYTES = 128 * 1024 * 1024
MAX_SCAN_TASKS = 100_000
MAX_SHUFFLE_PARTITIONS = 50_000

_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even when that costs the next operator a shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

_PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

_local_scratch: str | None = None


def prepare(spark: SparkSession) -> SparkSession:
    """Set the run-time planning the joins rely on, for frames that are executed later.

    The layer jobs set it themselves, around their own work only.
    """
    for key, value in _SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def lenient_sql(spark: SparkSession) -> Iterator[None]:
    """Analyse the plans built inside with ANSI off, so a malformed cast yields NULL.

    The mode is fixed while a DataFrame is *built*, so both the expression and the
    ``filter``/``withColumn`` that uses it belong inside the block.
    """
    with settings(spark, {"spark.sql.ansi.enabled": "false"}):
        yield


def importable(spark: SparkSession) -> None:
    """Let Python workers of a local session import this package from its folder.

    On a cluster the package is installed on the machines like any other.
    """
    path = spark.sparkContext.environment.setdefault("PYTHONPATH", "")
    if _PACKAGE_ROOT not in path.split(os.pathsep):
        joined = os.pathsep.join(filter(None, [path, _PACKAGE_ROOT]))
        spark.sparkContext.environment["PYTHONPATH"] = joined


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``."""
    global _local_scratch
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(
            "set spark.checkpoint.dir to a folder shared by all executors; "
            "scratch tables are never written to one machine's disk"
        )
    if _local_scratch is None:
        _local_scratch = tempfile.mkdtemp(prefix="terrane-")
        atexit.register(shutil.rmtree, _local_scratch, ignore_errors=True)
    return _local_scratch


def _scratch_root(spark: SparkSession) -> str:
    return f"{shared_root(spark)}/terrane/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder, grouped by application."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Remove everything this application left in the shared folder."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Give iterative fits a place to cut their lineage, unless the session has one."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(f"{shared_root(spark)}/terrane/checkpoints")


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's own size estimate: file sizes, carried through the plan. Runs nothing."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def layout_for(spark: SparkSession, input_bytes: int) -> dict[str, str]:
    """Settings for one layer job: run-time planning, and sizing that follows the input.

    Never below ``spark.sql.shuffle.partitions`` or ``spark.sql.files.maxPartitionBytes``,
    so small inputs are unaffected; AQE merges the shuffle partitions that stay small.
    """
    shuffle_floor = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pieces = -(-input_bytes // PIECE_BYTES)
    scan_floor = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return {
        **_SETTINGS,
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(
            max(shuffle_floor, min(pieces, MAX_SHUFFLE_PARTITIONS))
        ),
        "spark.sql.files.maxPartitionBytes": str(
            max(scan_floor, -(-input_bytes // MAX_SCAN_TASKS))
        ),
    }


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Run one job under changed SQL settings."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
