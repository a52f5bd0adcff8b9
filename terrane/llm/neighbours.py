"""Approximate nearest neighbours: a graph built by NN-descent, searched greedily."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrane.llm.common import map_arrow, run_starts, runs, staged

BROADCAST_BYTES = 64 << 20


@dataclass(frozen=True)
class Graph:
    """Parameters of the graph and of the search.

    Each node keeps its `degree` nearest known. The graph starts from `trees` random
    partitions into leaves of about `leaf` nodes; each of at most `rounds` rounds, which end
    when less than `settled` of the edges are new, joins every node's neighbours, forward and
    at most `degree` of the backward ones, with one another. A search keeps the `beam` nearest
    nodes found and goes on from those not yet expanded, first from its start and `entries`
    nodes drawn by hash, for at most `steps` steps.
    """

    degree: int = 32
    trees: int = 4
    leaf: int = 400
    rounds: int = 6
    settled: float = 0.02
    beam: int = 200
    entries: int = 4
    steps: int = 10
    seed: int = 1


def usable(vectors: DataFrame, key: str, column: str) -> DataFrame:
    """(vec_id, vector): rows with a vector that is not null, empty or zero, and whose components
    are all finite numbers; as doubles."""
    vector = F.col(column).cast("array<double>")
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), vector.alias("vector"))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull())
    vector = F.col("vector")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter(F.coalesce(finite, F.lit(False))).filter(F.exists(vector, lambda x: x != 0))


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one size as rows."""
    return column.flatten().to_numpy().reshape(len(column), -1)


_EDGES = "node long, other long, distance double"
_PACKED = "node long, packed binary"


def _packed(nodes: DataFrame) -> DataFrame:
    """(node, packed): vectors in single precision, for the choice of the graph only; results
    are measured on the vectors themselves.

    All are scaled by one power of two, which single precision bears without loss, so that
    the median vector's largest component is about one: few rows far off change nothing.
    """
    largest = F.array_max(F.transform("vector", F.abs))
    middle = nodes.agg(F.percentile_approx(largest, 0.5, 1000)).first()[0]
    shift = -int(np.frexp(middle)[1])
    most = float(np.finfo(np.float32).max)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                with np.errstate(over="ignore"):
                    scaled = np.ldexp(_matrix(batch.column("vector")), shift)
                single = np.clip(scaled, -most, most).astype(np.float32)
                packed = pa.array([row.tobytes() for row in single], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column("node"), packed], ["node", "packed"])

    return staged(map_arrow(nodes, run, _PACKED), "packed")


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
    """Batches as numpy columns, packed vectors as the rows of a matrix."""
    for batch in batches:
        if not batch.num_rows:
            continue
        chunk = {}
        for name in batch.schema.names:
            column = batch.column(name)
            if name == "packed":
                raw = b"".join(column.to_pylist())
                chunk[name] = np.frombuffer(raw, np.float32).reshape(len(column), -1)
            else:
                chunk[name] = column.to_numpy(zero_copy_only=False)
        yield chunk


def _squares(vectors: np.ndarray) -> np.ndarray:
    """Squared distances among rows; from a row to itself it is infinite. In double precision,
    which neither overflows nor loses small gaps beside large norms."""
    wide = vectors.astype(np.float64)
    norms = (wide**2).sum(axis=1)
    squares = np.maximum(norms[:, None] + norms[None, :] - 2 * wide @ wide.T, 0)
    np.fill_diagonal(squares, np.inf)
    return squares


def _edges_of(found: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    if found:
        node, other, distance = (np.concatenate(part) for part in zip(*found))
        yield pa.RecordBatch.from_arrays(
            [pa.array(node), pa.array(other), pa.array(distance.astype(np.float64))], ["node", "other", "distance"]
        )


def _leaf_edges(packed: DataFrame, count: int, dimensions: int, graph: Graph) -> DataFrame:
    """The first edges: nearest nodes in the leaves of `trees` random partitions.

    Each tree deals the nodes by the signs of random products. A leaf that stays large is
    dealt on by a hash, so none grows with its part of the data.
    """
    bits = max(0, int(np.ceil(np.log2(max(1, count / graph.leaf)))))
    planes = np.random.default_rng(graph.seed).standard_normal((graph.trees, dimensions, max(bits, 1)))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, chunk in ((batch, next(_chunks([batch]))) for batch in batches if batch.num_rows):
            for tree in range(graph.trees):
                signs = chunk["packed"].astype(np.float64) @ planes[tree] > 0
                cell = (signs[:, :bits] * (1 << np.arange(bits))).sum(axis=1).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(cell), tree, np.int32)), pa.array(cell), *batch.columns],
                    ["tree", "cell", *batch.schema.names],
                )

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs(_chunks(batches), ["tree", "cell", "part"]):
            starts = run_starts(rows["tree"], rows["cell"], rows["part"]).tolist()
            found = []
            for start, end in zip(starts, [*starts[1:], len(rows["node"])]):
                most = min(graph.degree, end - start - 1)
                if most < 1:
                    continue
                names, squares = rows["node"][start:end], _squares(rows["packed"][start:end])
                near = np.argpartition(squares, most - 1, axis=1)[:, :most]
                distance = np.sqrt(np.take_along_axis(squares, near, axis=1)).ravel()
                found.append((np.repeat(names, most), names[near].ravel(), distance))
            yield from _edges_of(found)

    dealt = map_arrow(packed, deal, f"tree int, cell long, {_PACKED}")
    sizes = dealt.groupBy("tree", "cell").agg(F.ceil(F.count(F.lit(1)) / (2 * graph.leaf)).alias("parts"))
    part = F.pmod(F.xxhash64("node", "tree"), F.col("parts"))
    by = ["tree", "cell", "part"]
    leaves = dealt.join(sizes, ["tree", "cell"]).withColumn("part", part).drop("parts")
    return map_arrow(leaves.repartition(*by).sortWithinPartitions(*by), join, _EDGES)


def _best(edges: DataFrame, degree: int) -> DataFrame:
    """Each node's nearest edges; an edge counts once, and as fresh only if it is new."""
    once = edges.groupBy("node", "other").agg(F.min("distance").alias("distance"), F.min("fresh").alias("fresh"))
    line = Window.partitionBy("node").orderBy("distance", "other")
    return once.withColumn("rank", F.row_number().over(line)).filter(F.col("rank") <= degree).drop("rank")


def _joined(edges: DataFrame, packed: DataFrame, graph: Graph) -> DataFrame:
    """Edges proposed by a round: each node's neighbours, forward and backward, meet.

    Pairs of which neither was new in the round before have met already. A proposal has to
    be nearer than the farthest edge its node keeps.
    """
    backward = edges.select(F.col("other").alias("node"), F.col("node").alias("other"), "distance", "fresh")
    around = edges.unionByName(_best(backward, graph.degree))
    around = around.groupBy("node", "other").agg(F.max("fresh").alias("fresh"))
    kept = edges.groupBy("node").agg(F.count(F.lit(1)).alias("kept"), F.max("distance").alias("farthest"))
    reach = F.when(F.col("kept") >= graph.degree, F.col("farthest")).otherwise(float("inf"))
    others = packed.join(kept.select("node", reach.alias("reach")), "node", "left").select(
        F.col("node").alias("other"), F.coalesce("reach", F.lit(float("inf"))).alias("reach"), "packed"
    )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs(_chunks(batches), ["node"]):
            starts = run_starts(rows["node"]).tolist()
            found = []
            for start, end in zip(starts, [*starts[1:], len(rows["node"])]):
                fresh = rows["fresh"][start:end].astype(bool)
                if end - start < 2 or not fresh.any():
                    continue
                squares = _squares(rows["packed"][start:end])
                squares[np.ix_(~fresh, ~fresh)] = np.inf
                distance = np.sqrt(squares)
                left, right = np.nonzero(distance < rows["reach"][start:end, None])
                names = rows["other"][start:end]
                found.append((names[left], names[right], distance[left, right]))
            yield from _edges_of(found)

    together = around.join(others, "other").repartition("node").sortWithinPartitions("node")
    return map_arrow(together, meet, _EDGES)


def build_graph(nodes: DataFrame, graph: Graph) -> DataFrame:
    """Edges (node, other, distance, fresh) by NN-descent over distinct vectors (node, vector).

    Rounds go on until one changes less than `settled` of the edges, or `rounds` are done.
    """
    count, dimensions = nodes.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    if not count:
        return nodes.sparkSession.createDataFrame([], f"{_EDGES}, fresh boolean")
    packed = _packed(nodes)
    first = _leaf_edges(packed, count, dimensions, graph).withColumn("fresh", F.lit(True))
    edges = staged(_best(first, graph.degree), "graph")
    for _ in range(graph.rounds):
        proposed = _joined(edges, packed, graph).withColumn("fresh", F.lit(True))
        edges = staged(
            _best(edges.withColumn("fresh", F.lit(False)).unionByName(proposed), graph.degree), "graph"
        )
        changed = edges.agg(F.coalesce(F.avg(F.col("fresh").cast("int")), F.lit(0.0))).first()[0]
        if changed < graph.settled:
            break
    return edges


def search(queries: DataFrame, nodes: DataFrame, edges: DataFrame, most: int, graph: Graph) -> DataFrame:
    """Greedy search for many queries at once: (query, node, distance) of each one's nearest.

    `queries` has query, start (the node to go from) and vector. A step joins the unexpanded
    nodes of all beams with the graph and the vectors they lead to, and keeps each query's
    `beam` nearest; it ends when no beam has an unexpanded node.
    """
    backward = edges.select(F.col("other").alias("node"), F.col("node").alias("other"))
    links = staged(edges.select("node", "other").unionByName(backward).distinct(), "links")
    wanted = queries.select("query", F.col("vector").alias("wanted"))
    numbers, size = queries.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    if numbers * (8 * (size or 0) + 64) <= BROADCAST_BYTES:
        wanted = F.broadcast(wanted)  # else both sides are shuffled

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                gap = _matrix(batch.column("vector")) - _matrix(batch.column("wanted"))
                distance = pa.array(np.sqrt((gap**2).sum(axis=1)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("query"), batch.column("node"), distance], ["query", "node", "distance"]
                )

    def measured(pairs: DataFrame) -> DataFrame:
        both = pairs.join(nodes, "node").join(wanted, "query")
        return map_arrow(both, measure, "query long, node long, distance double")

    by_hash = F.xxhash64(F.lit(graph.seed), "node")
    spread = [row.node for row in nodes.select("node").orderBy(by_hash).limit(graph.entries).collect()]
    starts = F.explode(F.array("start", *map(F.lit, spread)))
    begin = queries.select("query", starts.alias("node")).distinct()
    beam = staged(measured(begin).withColumn("expanded", F.lit(False)), "beam")
    line = Window.partitionBy("query").orderBy("distance", "node")
    for _ in range(graph.steps):
        fresh = beam.filter("NOT expanded").select("query", "node")
        if not fresh.take(1):
            break
        reached = fresh.join(links, "node").select("query", F.col("other").alias("node")).distinct()
        reached = reached.join(beam.select("query", "node"), ["query", "node"], "left_anti")
        known = beam.withColumn("expanded", F.lit(True))
        together = known.unionByName(measured(reached).withColumn("expanded", F.lit(False)))
        ranked = together.withColumn("rank", F.row_number().over(line))
        beam = staged(ranked.filter(F.col("rank") <= max(graph.beam, most)).drop("rank"), "beam")
    return beam.drop("expanded")


def nearest_neighbours(
    vectors: DataFrame,
    wanted: DataFrame,
    most: int = 10,
    *,
    key: str = "vec_id",
    column: str = "embedding",
    graph: Graph = Graph(),
) -> DataFrame:
    """The `most` nearest rows of each wanted row: query_id, rank, vec_id, score.

    `wanted` (a column vec_id) names rows of `vectors` by their id. Score is the Euclidean
    distance in double precision; ties go to the smaller vec_id. Equal vectors are one node of
    the graph; a node's members come back in order of vec_id, as many as can matter, so copies
    never crowd others out of the graph. Rows without a usable vector take no part; repeated
    ids are rows of their own, all of which are left out of their query's results. Vectors of
    another number of components than most have take no part either.
    """
    rows = staged(usable(vectors, key, column), "vectors")
    sizes = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), F.desc("size"))
    common = sizes.first()
    rows = rows.filter(F.size("vector") == (common["size"] if common else 0))
    nodes = staged(
        rows.groupBy("vector").agg(F.min("vec_id").alias("node")).select("node", "vector"), "nodes"
    )
    members = rows.join(nodes, "vector").select("node", "vec_id")
    asked = wanted.select(F.col("vec_id").cast("long")).distinct()
    queries = rows.join(asked, "vec_id").dropDuplicates(["vec_id"]).join(nodes, "vector").select(
        F.col("vec_id").alias("query"), F.col("node").alias("start"), "vector"
    )
    queries = staged(queries, "queries")
    found = search(queries, nodes, build_graph(nodes, graph), most + 1, graph)
    # Of a node's members only the first most + 1 can be among the nearest of a query.
    place = Window.partitionBy("node").orderBy("vec_id")
    first = members.withColumn("place", F.row_number().over(place)).filter(F.col("place") <= most + 1)
    pairs = found.join(first, "node").filter(F.col("query") != F.col("vec_id"))
    line = Window.partitionBy("query").orderBy("distance", "vec_id")
    ranked = pairs.withColumn("rank", F.row_number().over(line)).filter(F.col("rank") <= most)
    return ranked.select(F.col("query").alias("query_id"), "rank", "vec_id", F.col("distance").alias("score"))
