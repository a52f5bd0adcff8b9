"""Centroid clustering with heap-ordered bounds, in whole numbers and so exact.

Vectors lie in blocks, a row of a table that is bucketed by block. In each block every cluster
keeps a heap of its vectors, ordered by gap: the distance to the second nearest centroid less
that to the nearest, as it was at the vector's last scan, plus the drift that the cluster had
accumulated by then. A round adds to a cluster's accumulated drift how far its own centroid and
the furthest-moved other one went. A vector whose entry is still above it can't have changed
its cluster; only entries at or below it are popped, scanned against all centroids and pushed
anew. Heaps are small beside the vectors: a round joins them to the blocks by bucket, so only
they are shuffled and written, and sends the driver no more than sums by cluster.
"""

from __future__ import annotations

import heapq
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrane.llm.common import map_arrow, staged
from terrane.session import prepare, scratch_path, settings
from terrane.sources import paths
from terrane.sources.tables import small_frame

SCALE = 1024.0
# Components beyond this, as whole numbers, have squared distances that need not fit in a long.
MOST = 1 << 27
_BLOCK = 1024
_BUCKET_BYTES = 64 << 20
_MAX_BUCKETS = 50_000
_BLOCK_ROWS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "32",
    "spark.sql.parquet.columnarReaderBatchSize": "32",
}
_STATE = "block long, owner binary, heap_rows binary, heap_keys binary, heap_sizes binary"
_TOTALS = "sums array<long>, counts array<long>, scanned long"
_PLACED = "vec_id long, cluster int, distance long"


@dataclass
class Clustering:
    """`vectors`: vec_id, cluster and distance (squared) of each kept row; the final centroids;
    and how many vectors each round scanned."""

    vectors: DataFrame
    centroids: list[list[int]]
    scanned: list[int] = field(default_factory=list)

    def described(self) -> DataFrame:
        """The vectors with cluster_inertia, inertia and the cluster's centroid."""
        # A row for each cluster: small, and sent to every task.
        sums = self.vectors.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")))
        inertia = dict(sums.collect())
        rows = [
            (k, int(inertia.get(k, 0)), int(sum(inertia.values())), ",".join(map(str, centroid)))
            for k, centroid in enumerate(self.centroids)
        ]
        named = small_frame(
            self.vectors.sparkSession, rows, "cluster int, cluster_inertia long, inertia long, parts string"
        )
        centroid = F.split("parts", ",").cast(T.ArrayType(T.LongType())).alias("centroid")
        return self.vectors.join(F.broadcast(named), "cluster").select(
            "vec_id", "cluster", "distance", "cluster_inertia", "inertia", centroid
        )


def cluster_vectors(
    vectors: DataFrame, *, clusters: int = 8, dimensions: int = 64, rounds: int = 10, seed: int = 3
) -> Clustering:
    """Rounds of nearest centroids and floored means over (vec_id, embedding).

    Kept are vectors of exactly `dimensions` components, none null or not finite; a component x
    counts as floor(1024 x). Centroids start as the kept rows with the smallest sha256 of
    `<seed>:<vec_id>` (a null id counts as empty; of rows with one id, the smaller components
    first), as many as there are if fewer. Ties go to the smaller number, empty clusters stay
    where they are. Repeated rows count each. No kept vector gives no rows. Components beyond
    2^27 after scaling are an error, as their distances would not fit in a long.
    """
    spark = prepare(vectors.sparkSession)
    kept = _kept(vectors, dimensions)
    centroids = _first(kept, clusters, seed)
    if not len(centroids):
        return Clustering(small_frame(spark, [], _PLACED), [])
    sums = [[0] * dimensions for _ in centroids]
    counts = [0] * len(centroids)
    drift = np.zeros(len(centroids))
    scanned, state, old = [], None, None
    with settings(spark, _BLOCK_ROWS):
        blocks, name, buckets = _bucketed(staged(_blocks(kept, dimensions), "centroids-blocks"))
    with settings(spark, {**_BLOCK_ROWS, "spark.sql.shuffle.partitions": str(buckets)}):
        for _ in range(rounds):
            state, path = _advanced(blocks, state, _Step(centroids, drift))
            if old is not None:
                paths.remove(spark, old)
            old = path
            scanned.append(_add_totals(state, sums, counts))
            moved = _means(centroids, sums, counts)
            if (moved == centroids).all():
                break  # no later round can differ
            drift, centroids = _drifted(drift, centroids, moved), moved
        last = _Step(centroids, drift).place
        placed, _ = _written(map_arrow(_joined(blocks, state), last, _PLACED), "centroids-placed")
    spark.sql(f"DROP TABLE {name}")
    return Clustering(placed, centroids.tolist(), scanned)


def _kept(vectors: DataFrame, dimensions: int) -> DataFrame:
    numbers = vectors.select(
        F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("embedding")
    )
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return numbers.filter((F.size("embedding") == dimensions) & finite)


def _first(kept: DataFrame, clusters: int, seed: int) -> np.ndarray:
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    rows = kept.orderBy(F.sha2(name, 256), "embedding").limit(clusters).select("embedding").collect()
    return _whole(np.array([row.embedding for row in rows], float)) if rows else np.empty(0)


def _whole(numbers: np.ndarray) -> np.ndarray:
    floors = np.floor(SCALE * numbers)
    if (np.abs(floors) > MOST).any():
        raise ValueError(f"a component is beyond {MOST / SCALE:g}: squared distances would not fit in a long")
    return floors.astype(np.int64)


def _blocks(kept: DataFrame, dimensions: int) -> DataFrame:
    """(block, ids, width, points): up to 1,024 vectors a row, in as few bytes as they need."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, _BLOCK):
                piece = batch.slice(start, _BLOCK)
                numbers = piece.column(1).flatten().to_numpy(zero_copy_only=False)
                points = _whole(numbers.reshape(-1, dimensions))
                width = 2 if len(points) and np.abs(points).max() < 1 << 15 else 4
                ids = pa.ListArray.from_arrays(pa.array([0, len(points)], pa.int32()), piece.column(0))
                packed = points.astype(f"<i{width}").tobytes()
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array([width], pa.int32()), pa.array([packed], pa.binary())], ["ids", "width", "points"]
                )

    blocks = map_arrow(kept, run, "ids array<long>, width int, points binary")
    return blocks.withColumn("block", F.monotonically_increasing_id())  # fixed once it is written


def _bucketed(blocks: DataFrame) -> tuple[DataFrame, str, int]:
    """The blocks as a bucketed table in the shared folder, its name and number of buckets."""
    spark = blocks.sparkSession
    total, held = blocks.agg(F.count(F.lit(1)), F.sum(F.octet_length("points"))).first()
    wanted = max(spark.sparkContext.defaultParallelism, -(-(held or 0) // _BUCKET_BYTES))
    buckets = max(1, min(wanted, total, _MAX_BUCKETS))
    name = f"centroid_blocks_{uuid.uuid4().hex}"
    writer = blocks.repartition(buckets, "block").write.bucketBy(buckets, "block").sortBy("block")
    writer.option("path", scratch_path(spark, "centroids-buckets")).format("parquet").saveAsTable(name)
    return spark.table(name), name, buckets


def _joined(blocks: DataFrame, state: DataFrame | None) -> DataFrame:
    return blocks if state is None else blocks.join(state.drop("sums", "counts", "scanned"), "block")


def _written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def _advanced(blocks: DataFrame, state: DataFrame | None, step: _Step) -> tuple[DataFrame, str]:
    """The heaps after a round, written; each task adds a row of totals, whose block is null."""
    after = map_arrow(_joined(blocks, state), step.advance, f"{_STATE}, {_TOTALS}")
    return _written(after, "centroids-state")


def _add_totals(state: DataFrame, sums: list[list[int]], counts: list[int]) -> int:
    """Add to the sums and counts what the round moved; clusters x dimensions values in all."""
    totals = state.filter("block IS NULL").select("sums", "counts", "scanned")
    each = totals.select(F.posexplode(F.concat("sums", "counts", F.array("scanned"))).alias("place", "value"))
    added = dict(each.groupBy("place").agg(F.sum(F.col("value").cast("decimal(38,0)"))).collect())
    size = len(sums[0])
    for place, value in added.items():
        if place < size * len(sums):
            sums[place // size][place % size] += int(value)
        elif place < size * len(sums) + len(counts):
            counts[place - size * len(sums)] += int(value)
    return int(added.get(size * len(sums) + len(counts), 0))


def _means(centroids: np.ndarray, sums: list[list[int]], counts: list[int]) -> np.ndarray:
    rows = [[s // n for s in row] if n else old for row, n, old in zip(sums, counts, centroids.tolist())]
    return np.array(rows, np.int64)


def _drifted(drift: np.ndarray, before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Each cluster's drift and the largest of the others', added up; rounded up."""
    gone = np.sqrt(((after - before) ** 2).sum(axis=1).astype(float))
    order = np.argsort(gone)
    other = np.full(len(gone), gone[order[-1]])
    other[order[-1]] = gone[order[-2]] if len(gone) > 1 else 0.0
    return drift + (gone + other) * (1 + 1e-12)


class _Step:
    """One pass over the blocks under given centroids and accumulated drifts."""

    def __init__(self, centroids: np.ndarray, drift: np.ndarray):
        self.centroids, self.drift = centroids, drift

    def distances(self, points: np.ndarray) -> np.ndarray:
        return np.stack([((points - c) ** 2).sum(axis=1) for c in self.centroids], axis=1)

    def expired(self, heaps: list[list[tuple[float, int]]]) -> np.ndarray:
        rows = []
        for heap, drift in zip(heaps, self.drift.tolist()):
            while heap and heap[0][0] <= drift:
                rows.append(heapq.heappop(heap)[1])
        return np.array(sorted(rows), np.int64)

    def rescan(self, points: np.ndarray, rows: np.ndarray, heaps: list[list[tuple[float, int]]]) -> np.ndarray:
        """Scan rows against all centroids and push them onto the heaps; their clusters."""
        squares = self.distances(points[rows])
        own = squares.argmin(axis=1)  # the first, so the smaller number, of ties
        at = np.arange(len(rows))
        near = np.sqrt(squares[at, own].astype(float))
        if len(heaps) > 1:
            squares[at, own] = np.iinfo(np.int64).max
            far = np.sqrt(squares.min(axis=1).astype(float))
        else:
            far = np.full(len(rows), np.inf)
        drift = self.drift[own]
        # Rounded down by far more than floating point can err.
        keys = far - near + drift - 1e-12 * (far + near + drift + 1)
        for cluster in range(len(heaps)):
            new = np.flatnonzero(own == cluster)
            entries = list(zip(keys[new].tolist(), rows[new].tolist()))
            if len(entries) > len(heaps[cluster]):
                heaps[cluster] += entries
                heapq.heapify(heaps[cluster])
            else:
                for entry in entries:
                    heapq.heappush(heaps[cluster], entry)
        return own

    def work(self, batch: pa.RecordBatch) -> Iterator[tuple]:
        """For each block: the batch's row, points, owners before and after, heaps, rescanned rows."""
        k = len(self.centroids)
        for row in batch.select([n for n in batch.schema.names if n != "ids"]).to_pylist():
            points = np.frombuffer(row["points"], f"<i{row['width']}").astype(np.int64)
            points = points.reshape(-1, self.centroids.shape[1])
            if row.get("owner") is None:
                before, heaps = np.full(len(points), -1, np.int32), [[] for _ in range(k)]
                rows = np.arange(len(points))
            else:
                before, heaps = np.frombuffer(row["owner"], "<i4"), _heaps(row)
                rows = self.expired(heaps)
            after = before.copy()
            if len(rows):
                after[rows] = self.rescan(points, rows, heaps)
            yield row["block"], points, before, after, heaps, rows

    def advance(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("block", pa.int64())]
            + [(name, pa.binary()) for name in ("owner", "heap_rows", "heap_keys", "heap_sizes")]
            + [("sums", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())), ("scanned", pa.int64())]
        )
        sums, counts, scanned = np.zeros_like(self.centroids), np.zeros(len(self.centroids), np.int64), 0
        for batch in batches:
            out = []
            for block, points, before, after, heaps, rows in self.work(batch):
                scanned += len(rows)
                changed = rows[before[rows] != after[rows]]
                np.add.at(sums, after[changed], points[changed])
                np.add.at(counts, after[changed], 1)
                known = changed[before[changed] >= 0]
                np.subtract.at(sums, before[known], points[known])
                np.subtract.at(counts, before[known], 1)
                out.append({"block": block, "owner": after.astype("<i4").tobytes(), **_packed(heaps)})
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
        total = {"sums": sums.reshape(-1).tolist(), "counts": counts.tolist(), "scanned": scanned}
        yield pa.RecordBatch.from_pylist([total], schema)

    def place(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The rows of the vectors, each with the exact distance to its centroid."""
        for batch in batches:
            for ids, (_, points, _, after, _, _) in zip(batch.column("ids"), self.work(batch)):
                distance = ((points - self.centroids[after]) ** 2).sum(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [ids.values, pa.array(after, pa.int32()), pa.array(distance)], ["vec_id", "cluster", "distance"]
                )


def _packed(heaps: list[list[tuple[float, int]]]) -> dict[str, bytes]:
    entries = [entry for heap in heaps for entry in heap]
    return {
        "heap_rows": np.array([row for _, row in entries], "<i4").tobytes(),
        "heap_keys": np.array([key for key, _ in entries], "<f8").tobytes(),
        "heap_sizes": np.array([len(heap) for heap in heaps], "<i4").tobytes(),
    }


def _heaps(row: dict) -> list[list[tuple[float, int]]]:
    rows = np.frombuffer(row["heap_rows"], "<i4").tolist()
    keys = np.frombuffer(row["heap_keys"], "<f8").tolist()
    entries, heaps, start = list(zip(keys, rows)), [], 0
    for size in np.frombuffer(row["heap_sizes"], "<i4").tolist():
        heaps.append(entries[start : start + size])
        start += size
    return heaps
